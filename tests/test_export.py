import csv
import hashlib
import json
import os

import pytest
from pyspark.sql import functions as F

from lotline.operators import export


def tables(spark):
    units = spark.createDataFrame([("u2", "2", "B", "B", "d", "d"), ("u1", "1", None, "A", "d", "d")], "unit_id string, bbl string, unit_label string, normalized_unit string, first_seen string, last_seen string")
    matches = spark.createDataFrame([("o1", "unit", "u1", "resolved", 1.0, "m", "t"), ("o2", "unit", None, "unresolved", 0.0, "m", "t"), ("o1", "building", "1", "resolved", 1.0, "m", "t")], "observation_id string, entity_type string, entity_id string, status string, confidence double, method string, matched_at string")
    obs = spark.createDataFrame([("o1", "s", "r", "2026", "k", "5 \"Main\", St", "A", 1.0, None, None, "open", "source_document"), ("o2", "s", "r2", "2026", "k", None, None, None, None, None, None, "legacy_snapshot")], "observation_id string, source string, source_ref string, observed_at string, observation_kind string, address string, unit_label string, bedrooms double, bathrooms double, price double, status string, evidence_grade string")
    sources = spark.createDataFrame([("s", "k", "m", "d", "d")], "source string, source_kind string, methodology string, first_seen string, last_seen string")
    return units, matches, obs, sources


def test_release(spark, tmp_path):
    units, matches, obs, sources = tables(spark)
    out = str(tmp_path / "r1")
    m = export.release(out, units, export.unit_observations(matches, obs), sources, "now")
    assert m["release_id"] == "r1" and {k: v["rows"] for k, v in m["files"].items()} == {"units.csv": 2, "unit_observations.csv": 1, "sources.csv": 1}
    with open(os.path.join(out, "units.csv"), newline="") as f:
        rows = list(csv.reader(f))
    assert rows == [export.UNITS, ["u1", "1", "", "A", "d", "d"], ["u2", "2", "B", "B", "d", "d"]]
    with open(os.path.join(out, "manifest.json")) as f:
        assert json.load(f) == m
    assert all(export.sha256_of(os.path.join(out, k)) == v["sha256"] for k, v in m["files"].items())
    with pytest.raises(FileExistsError):
        export.release(out, units, export.unit_observations(matches, obs), sources, "now")
    assert os.listdir(tmp_path) == ["r1"]


def test_nothing_is_left_of_a_failed_release(spark, tmp_path):
    units, matches, obs, sources = tables(spark)
    with pytest.raises(Exception):
        export.release(str(tmp_path / "r2"), units.drop("bbl"), export.unit_observations(matches, obs), sources, "now")
    assert os.listdir(tmp_path) == []


def test_report(spark):
    units, matches, obs, sources = tables(spark)
    r = export.quality_report({"units": units, "observations": obs, "entity_matches": matches, "sources": sources}, "r", "abc")
    assert r["counts"] == {"units": 2, "observations": 2, "entity_matches": 3, "sources": 1, "unit_resolution_rate": 0.5}
    assert r["open_gaps"] == ["1 unit claims are unresolved"] and r["evidence_grades"] == {"legacy_snapshot": 1, "source_document": 1}


def of_parts(out, name, manifest):
    """The file that a release's parts make, each part's digest checked."""
    whole = b""
    for p in manifest["files"][name]["parts"]:
        with open(os.path.join(out, name, p["name"]), "rb") as f:
            data = f.read()
        assert len(data) == p["bytes"] and hashlib.sha256(data).hexdigest() == p["sha256"]
        whole += data
    return whole


def many(spark):
    units, matches, obs, sources = tables(spark)
    more = spark.range(5000).selectExpr("concat('u', id) AS unit_id", "CASE WHEN id % 7 > 0 THEN cast(id * 31 % 4096 AS string) END AS bbl", "concat('L \"', id, '\", x') AS unit_label", "cast(id AS string) AS normalized_unit", "'d' AS first_seen", "CASE WHEN id % 3 > 0 THEN 'é\n' END AS last_seen")
    return {"units.csv": units.unionByName(more), "unit_observations.csv": export.unit_observations(matches, obs), "sources.csv": sources}


def test_release_by_tasks(spark, tmp_path):
    out, d = str(tmp_path / "r1"), many(spark)
    m = export.release_parts(out, d, "now", parts=7)
    with open(os.path.join(out, "manifest.json")) as f:
        assert json.load(f) == m
    assert m["release_id"] == "r1" and {k: v["rows"] for k, v in m["files"].items()} == {"units.csv": 5002, "unit_observations.csv": 1, "sources.csv": 1}
    assert len(m["files"]["units.csv"]["parts"]) > 3 and os.listdir(tmp_path) == ["r1"]
    for name, (columns, order) in export.FILES.items():
        one = str(tmp_path / "one.csv")
        export.write_csv(d[name], one, columns, order)
        with open(one, "rb") as f:
            assert f.read() == of_parts(out, name, m)
        os.remove(one)
    assert sorted(os.listdir(out)) == ["manifest.json", "sources.csv", "unit_observations.csv", "units.csv"]
    with pytest.raises(FileExistsError):
        export.release_parts(out, d, "now")
    os.makedirs(tmp_path / "r2")
    assert export.release_parts("file://" + str(tmp_path / "r2"), d, "now", "named")["release_id"] == "named"


def test_a_failed_task_leaves_no_release(spark, tmp_path):
    d = many(spark)
    bad = F.when(F.col("unit_id") == "u4000", F.raise_error(F.lit("no such unit"))).otherwise(F.col("unit_label"))
    with pytest.raises(Exception, match="no such unit"):
        export.release_parts(str(tmp_path / "r3"), d | {"units.csv": d["units.csv"].withColumn("unit_label", bad)}, "now", parts=4)
    assert os.listdir(tmp_path) == []
