import pytest
from pyspark.sql import functions as F

from lotline.operators import keys
from lotline.streaming import incremental as T


def test_offsets(spark):
    log = spark.createDataFrame([("a", "all", 0, 10, 10), ("a", "all", 10, 10, 10), ("b", "all", 0, 10, 4)], "source string, scope string, offset int, requested int, rows int")
    assert [T.next_offset(log, s, "all") for s in "abc"] == [20, None, 0] and T.next_offset(log, "b", "all", 3) == 3
    assert T.scope_of("MN") == T.scope_of(1) == "1" and T.scope_of(None) == "all"


def test_offset_pages_stop_at_a_short_one(spark):
    data = spark.range(25)
    got, seen = [], []
    for page in T.run_offset_pages(lambda o, n: data.where((F.col("id") >= o) & (F.col("id") < o + n)), lambda d: seen.extend(r["id"] for r in d.collect()), 0, 10, 9):
        got.append(page)
    assert got == [(0, 10, 10), (10, 10, 10), (20, 10, 5)] and sorted(seen) == list(range(25))
    assert list(T.run_offset_pages(None, None, None, 10, 9)) == []


def test_keyset_pages_are_resumable(spark):
    d = spark.createDataFrame([(f"d{i // 2}", i) for i in range(9)], "day string, id int")
    seen = []
    fetch = lambda at, n: keys.keyset_after(d, "day", "id", at, n)
    sink = lambda x: seen.extend(r["id"] for r in x.collect())
    (first,) = T.run_keyset_pages(fetch, sink, None, ("day", "id"), 4, 1)
    assert first == ("d2", 5) and seen == [8, 7, 6, 5]
    list(T.run_keyset_pages(fetch, sink, None, ("day", "id"), 4, 9, durable=first))
    assert seen == list(range(8, -1, -1))
    with pytest.raises(ValueError, match="durable"):
        list(T.run_keyset_pages(fetch, sink, ("x", 1), ("day", "id"), 4, 1, durable=first))


def test_other_pages(spark):
    d = spark.createDataFrame([("a", 1), ("b", 2), ("b", 3), ("c", 4)], "doc string, row int")
    assert [r["row"] for r in keys.keyset_through(d, "doc", "row", "b", 9).collect()] == [3, 2, 1]
    assert [r["row"] for r in keys.keyset_above(d, "doc", "a", 2).orderBy("row").collect()][0] == 2


def test_replayed_pages_add_nothing(spark):
    raw = spark.createDataFrame([("p1",), ("p2",), ("p1",)], "payload string")
    staged = T.stage(raw, raw.limit(0).withColumn("row_id", F.lit("")))
    assert staged.count() == 2 and T.stage(raw, staged).count() == 0
    once = T.mark_resolved(staged, staged.limit(1), "t1")
    assert T.mark_resolved(once, staged, "t2").groupBy("resolved_at").count().count() == 2


def test_slot_cursor(spark):
    b = spark.createDataFrame([("1", 2), ("2", 0), ("3", 1)], "bbl string, units_res int")
    assert T.slots_state(spark, b, None, 1) == ("1", False) and T.slots_state(spark, b, "1", 5) == ("3", False) and T.slots_state(spark, b, "3", 5) == ("3", True)


def test_a_stream_goes_on_where_it_stopped(spark, tmp_path):
    land, out, check = (str(tmp_path / x) for x in ("land", "out", "check"))
    row = lambda i: spark.createDataFrame([(i, "2026-01-01 00:00:00")], "id int, at string").select("id", F.to_timestamp("at").alias("ts"))
    row(1).write.parquet(land)
    run = lambda: T.run_available(T.stream_files(spark, land, row(1).schema), lambda d, i: d.write.mode("overwrite").parquet(f"{out}/batch={i}"), check)
    run()
    row(2).write.mode("append").parquet(land)
    run()
    run()
    assert sorted(r["id"] for r in spark.read.parquet(out).collect()) == [1, 2]


def test_duplicates_within_a_watermark(spark, tmp_path):
    d = spark.createDataFrame([(1, "2026-01-01 00:00:00"), (1, "2026-01-01 00:00:30"), (2, "2026-01-01 00:01:00")], "id int, at string").select("id", F.to_timestamp("at").alias("ts"))
    d.write.parquet(str(tmp_path / "in"))
    s = T.distinct_rows(T.stream_files(spark, str(tmp_path / "in"), d.schema), "id", "ts", "10 minutes")
    q = s.writeStream.foreachBatch(lambda x, i: x.write.mode("append").parquet(str(tmp_path / "out"))).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted(r["id"] for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [1, 2]


def test_windows_of_files_that_overlap_in_time(spark, tmp_path):
    from lotline.plans.catalog import QUERIES

    for k in range(4):  # each file spans three days; rows are late from the third batch on
        d = spark.range(72).select(F.timestamp_seconds(1_767_225_600 + F.col("id") * 3600 + 60 * k).cast("timestamp_ntz").alias("ts"), F.lit("a").alias("event_type"))
        d.coalesce(1).write.mode("append").parquet(str(tmp_path / "events.parquet"))
    got = QUERIES["t10_windowed_counts"](spark, str(tmp_path)).collect()
    assert len(got) == 72 and {r["n"] for r in got} == {4}


def test_a_page_reads_its_own_files(spark, tmp_path):
    """Pages are cut by constants, so files that don't hold a page aren't read."""
    d = spark.range(0, 1000, 1, 8).withColumn("id", F.col("id"))
    T.positioned(d).write.parquet(str(tmp_path / "staged"))
    at = T.Positions(spark.read.parquet(str(tmp_path / "staged")))
    assert at.rows == 1000
    pages = [[r["id"] for r in at.page(o, 300).orderBy("id").collect()] for o in (0, 300, 600, 900, 1200)]
    assert [len(p) for p in pages] == [300, 300, 300, 100, 0] and sorted(sum(pages, [])) == list(range(1000))
    plan = at.page(300, 10)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "PushedFilters: [" in plan and "part" in plan.split("PushedFilters: [")[1].split("]")[0]


def test_a_stage_without_state(spark, tmp_path):
    """Batches that bring the same payloads, and a batch that is run again, add nothing."""
    from lotline.buckets import BucketTable

    src = tmp_path / "in"
    for i, rows in enumerate(([1, 2, 2], [2, 3], [1, 4])):
        spark.createDataFrame([(f"p{x}",) for x in rows], "payload string").coalesce(1).write.mode("append").parquet(str(src))
    table = BucketTable(spark, str(tmp_path / "stage"), "payload string, row_id string, resolved_at string", ["row_id"], buckets=4)
    stream = lambda: T.stream_files(spark, str(src), spark.read.parquet(str(src)).schema)
    T.stage_batches(stream(), table, str(tmp_path / "c1"))
    assert sorted(r["payload"] for r in table.read().collect()) == ["p1", "p2", "p3", "p4"]
    T.stage_batches(stream(), table, str(tmp_path / "c2"))  # all again, as after a lost checkpoint
    assert table.read().count() == 4
