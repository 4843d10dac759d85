import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lotline.llm import exact_dedup as E

from .helpers import documents, rows

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def digest(t):
    return hashlib.sha256((t or "").translate(LOWER).encode()).hexdigest()


@settings(max_examples=30, deadline=None)
@given(st.sets(st.integers(0, 2**63 - 1), max_size=400))
def test_filter_has_no_false_negatives(keys):
    k = np.array(sorted(keys), np.uint64)
    assert E.BinaryFuse.build(k).probe(k).all()


def test_filter_false_positives_and_size():
    rng = np.random.default_rng(1)
    k = np.unique(rng.integers(0, 2**63, 60_000, dtype=np.uint64))
    f = E.BinaryFuse.build(k)
    assert f.probe(k).all() and f.probe(rng.integers(0, 2**63, 200_000, dtype=np.uint64)).mean() < 0.006
    assert len(f.cells) < 1.25 * len(k)


@pytest.mark.parametrize("loads", [1, 2, 3])
@pytest.mark.parametrize("clash", [False, True])
def test_against_brute_force(spark, loads, clash):
    data = rows()
    got = E.dedup(documents(spark, data, clash), E.loads_of(loads=loads), bucket_rows=16).collect()
    assert len(got) == len(data)
    groups = {}
    for i, t, *_ in data:
        groups.setdefault(digest(t), []).append(i)
    for r in got:
        assert (r["keep_id"], r["group_size"]) == (max(groups[r["digest"]]), len(groups[r["digest"]]))
    assert sorted(r["digest"] for r in got if r["kept"]) == sorted(groups)


def test_null_ids_and_empty_table(spark):
    got = E.dedup(documents(spark, [(None, "A b", "en", "s", 3), (None, "a B", "en", "s", 3), (4, "x", "en", "s", 1)]), E.loads_of()).collect()
    assert sorted((r["group_size"], r["kept"]) for r in got) == [(1, True), (2, False), (2, True)]
    assert E.dedup(documents(spark, []), E.loads_of()).count() == 0


def test_hot_group_keeps_one(spark):
    data = [(i, "Same text" if i % 3 else f"other {i}", "en", "s", 0) for i in range(600)]
    for batch in (None, E.loads_of()):
        kept = E.keep_one(documents(spark, data).withColumn("n", F.col("doc_id")), ["doc_id", "text"], "n", batch).collect()
        assert len(kept) == 201 and max(r["doc_id"] for r in kept if r["text"] == "Same text") == 599


def test_one_filter_for_each_snapshot(spark, monkeypatch):
    """Of k loads all but the last are snapshots; each one's filters are built once, whatever the number of loads that they screen."""
    built = []
    build = E.build_filters
    monkeypatch.setattr(E, "build_filters", lambda keys: built.append(keys.select("batch", "bucket").distinct().count()) or build(keys))
    data = [(i, f"text {i % 70}", "en", "s", 0) for i in range(300)]
    got = E.dedup(documents(spark, data), F.col("doc_id") % 5, bucket_rows=10_000).collect()
    assert built == [4] and sum(r["kept"] for r in got) == 70 and all(r["keep_id"] == max(i for i in range(300) if i % 70 == r["doc_id"] % 70) for r in got)


def test_screening_sees_earlier_loads_only(spark):
    keys = [(b, 0, k, f"d{k}") for b, ks in enumerate([range(50), range(40, 90), range(80, 130)]) for k in ks]
    g = spark.createDataFrame(keys, "batch int, bucket int, key long, digest string")
    hits = {(r["digest"], r["batch"], r["old"]) for r in E.screen(g, E.build_filters(g.where("batch < 2"))).collect()}
    want = {(f"d{k}", 1, 0) for k in range(40, 50)} | {(f"d{k}", 2, 1) for k in range(80, 90)}
    assert want <= hits and all(new > old for _, new, old in hits) and len(hits) < len(want) + 8


def test_a_third_of_all_rows_has_no_id(spark):
    """Texts of filter hits are found by row number: N hits without an id don't meet all rows without one."""
    rows = [(None, f"text {i % 400}") for i in range(900)] + [(5, f"text {i}") for i in range(300)] + [(1000 + i, f"text {i}") for i in range(900)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = E.dedup(df, F.pmod(F.xxhash64("text", "doc_id"), F.lit(3)).cast("int"))
    assert out.count() == len(rows)
    per = {}
    for r in out.collect():
        per.setdefault(r["digest"], []).append(r)
    assert len(per) == 900 and all(sum(r["kept"] for r in g) == 1 and {r["group_size"] for r in g} == {len(g)} for g in per.values())
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Cartesian" not in plan
