"""Payloads in one form, and reports by one scan."""

import json

import pytest
from pyspark.sql import functions as F

from lotline.functions.documents import canonical_payload
from lotline.operators import coverage, export

VALUES = [
    {"b": 1, "a": {"d": [1, {"z": None, "y": True, "é": False}], "c": ""}, "é": "ü😀"},
    {"quote": 'say "a, b: c" \\ / done', "colon:": "x,y:z", "controls": "\x00\x01\x1f\x7f\n\t\r\b\f", "tricky": "\\u001F \\\\u", "private": "￿퟿"},
    {"n": [0, -5, 12345678901234567890, 1.0, -2.5, 100.0, 40.7123456789, 0.25, 1000.5], "t": ["1.50", "a1.0", "2026-01-01"]},
    [], {}, "plain, text: here", None, True, 7, 2.5, [[[]], {"x": {}}], {"": {"": []}}, {"k" * 50: "v" * 50_000, "q": '"' * 20_000, "e": "é" * 5_000},
]


def test_payloads_are_those_of_the_stated_form(spark):
    rows = []
    for i, v in enumerate(VALUES):
        want = json.dumps(v, sort_keys=True)
        rows += [(i, json.dumps(v), want), (i, json.dumps(v, ensure_ascii=False, separators=(",", ":")), want), (i, json.dumps(v, indent=2), want)]
    df = spark.createDataFrame(rows, "i int, raw string, want string").select("i", "want", canonical_payload(F.col("raw")).alias("got"))
    for r in df.collect():
        assert r["got"] == r["want"], r["i"]
    odd = spark.createDataFrame([("bad{",), (None,), ('{"a":1,"a":2}',), ("",), ('{"a": 1.50, "b": 1e3}',)], "raw string").select(canonical_payload(F.col("raw")).alias("got"))
    assert [r["got"] for r in odd.collect()] == [None, None, None, None, '{"a": 1.5, "b": 1000.0}']


def jobs(spark, f):
    spark.sparkContext.setJobGroup("counted", "counted")
    try:
        f()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup("counted"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_all_distributions_by_one_scan(spark):
    d = spark.createDataFrame([("a", "x", 1), ("a", None, 2), (None, "x", 3), ("b", "y", 4)], "source string, grade string, n int")
    got = {(r["key"], r["value"]): r["n"] for r in coverage.all_distributions(d, ["source", "grade"]).collect()}
    want = {(k, r[0]): r[1] for k in ("source", "grade") for r in coverage.distribution(d, k).collect()}
    assert got == want | {(None, None): 4}
    assert coverage.all_distributions(d, ["source", "grade"])._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == 1


def test_a_report_is_a_job_a_table(spark):
    obs = spark.createDataFrame([("a", "x"), ("b", None)], "source string, evidence_grade string")
    m = spark.createDataFrame([("unit", "resolved"), ("building", "resolved"), ("unit", "ambiguous"), ("unit", None)], "entity_type string, status string")
    tables = {"observations": obs, "entity_matches": m, "units": obs}
    r = export.quality_report(tables, "r")
    assert r["counts"] == {"observations": 2, "entity_matches": 4, "units": 2, "unit_resolution_rate": 0.333333}
    assert r["sources"] == {"a": 1, "b": 1} and r["evidence_grades"] == {None: 1, "x": 1} and r["unit_status"] == {"": 1, "ambiguous": 1, "resolved": 1}


def test_coverage_runs(spark, tmp_path):
    at = str(tmp_path / "coverage")
    one = spark.createDataFrame([("1", "x", 2), ("2", "y", 3), ("3", "z", None)], "bbl string, membership_status string, units_res int")
    two = spark.createDataFrame([("1", "x", 2), ("2", "y", 4), ("3", "z", None), ("4", "w", 1)], "bbl string, membership_status string, units_res int").where("bbl <> '3'")
    coverage.store_run(one, at, "2026-01")
    with pytest.raises(Exception, match="exists"):
        coverage.store_run(two, at, "2026-01")
    with pytest.raises(ValueError):
        coverage.store_run(two, at, "../x")
    coverage.store_run(two, at, "2026-02")
    a, b = (coverage.stored_run(spark, at, r) for r in ("2026-01", "2026-02"))
    assert a.count() == 3 and spark.read.parquet(at).groupBy("run").count().count() == 2
    got = sorted((r["bbl"], r["change"], r["units_res_before"], r["units_res_after"]) for r in coverage.run_difference(a, b, "bbl", ["membership_status", "units_res"]).collect())
    assert got == [("2", "changed", 3, 4), ("3", "left", None, None), ("4", "entered", None, 1)]
    assert coverage.run_difference(a, a, "bbl", ["membership_status", "units_res"]).count() == 0
    assert [r["bbl"] for r in coverage.newly_resolved(a, b, ["bbl"]).collect()] == ["4"]
