import os

import pytest
from pyspark.sql import functions as F

from lotline.buckets import BucketTable
from lotline.lake import Lake
from lotline.operators import keys, upsert

LISTINGS = "source string, source_id string, price double, first_seen string, last_seen string, status string"


def files(path):
    return {os.path.join(d, n): os.stat(os.path.join(d, n)).st_mtime_ns for d, _, names in os.walk(path) for n in names if n.endswith(".parquet")}


def rows(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def table(spark, path, n=500):
    t = BucketTable(spark, str(path), "id string, name string, v long", ["id"], buckets=16)
    t.merge(spark.range(n).select(F.col("id").cast("string").alias("id"), F.lit("a").alias("name"), F.col("id").alias("v")), lambda old, new: new)
    return t


def test_a_pull_of_one_key_rewrites_one_bucket(spark, tmp_path):
    t = table(spark, tmp_path / "t")
    before, old = files(tmp_path / "t"), t.read()
    new = spark.createDataFrame([("77", "b", 7, 0)], "id string, name string, v long, n int")
    want = rows(keys.insert_or_replace(old, new, ["id"], "n").drop("n"))
    folders = t.merge(new, lambda a, b: keys.insert_or_replace(a, b, ["id"], "n"))
    after = files(tmp_path / "t")
    assert len(folders) == 1 and rows(t.read()) == want
    gone, came = before.keys() - after.keys(), after.keys() - before.keys()
    assert len({os.path.dirname(f) for f in gone | came}) == 1 and all(before[f] == after[f] for f in before.keys() & after.keys())
    assert len(before.keys() & after.keys()) >= 14
    plan = t.of(folders)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and f"bucket#" in plan.split("PartitionFilters: [")[1].split("]")[0]
    read = t.of(folders).select(F.input_file_name()).distinct().collect()
    assert len({os.path.dirname(r[0]) for r in read}) == 1


def test_snapshot_merge_by_buckets(spark, tmp_path):
    """Pull after pull, the same as merging the whole table; other sources' files stay as they are."""
    t = BucketTable(spark, str(tmp_path / "l"), LISTINGS, ["source_id"], ["source"], buckets=8)
    whole = spark.createDataFrame([], LISTINGS)
    pulls = [("a", "1", range(0, 40)), ("b", "2", range(0, 30)), ("a", "3", range(20, 60)), ("a b/c", "4", range(5)), ("a", "5", [7]), ("b", "6", [])]
    for source, now, ids in pulls:
        got = spark.createDataFrame([(str(i), float(i) + int(now), i) for i in ids], "source_id string, price double, arrival long")
        others = {f: m for f, m in files(tmp_path / "l").items() if f"source={source}/" not in f}
        whole = spark.createDataFrame(upsert.snapshot_merge(whole, got, source, now, ["price"]).drop("action").collect(), whole.schema).select(*whole.columns)
        t.merge(got.withColumn("source", F.lit(source)), lambda old, new, s=source, n=now: upsert.snapshot_merge(old, new.drop("source"), s, n, ["price"]), also=(F.col("source") == source) & (F.col("status") == "active") & (F.col("last_seen") < now) if len(ids) else None)
        assert rows(t.read()) == rows(whole)
        left = files(tmp_path / "l")
        assert all(left[f] == m for f, m in others.items())


def test_upserts_by_buckets(spark, tmp_path):
    schema = "bbl string, normalized string, address string, zipcode string, source string"
    t = BucketTable(spark, str(tmp_path / "a"), schema, ["bbl"], buckets=8)
    old = spark.createDataFrame([(str(i % 20), f"N{i}", f"n{i}", None, "x") for i in range(60)], schema)
    t.merge(old, lambda a, b: b)
    new = spark.createDataFrame([("3", "N3", "new", "1", "y", 0), ("99", "Z", "z", None, "y", 1)], f"{schema}, arrival long")
    want = upsert.address_upsert(old, new).select(*t.read().columns)
    assert len(t.merge(new, upsert.address_upsert)) <= 2
    assert rows(t.read()) == rows(want)


def test_rows_that_go_and_keys_that_are_null(spark, tmp_path):
    t = BucketTable(spark, str(tmp_path / "t"), "id string, v long", ["id"], buckets=4)
    t.merge(spark.createDataFrame([("1", 1), (None, 2), ("", 3)], "id string, v long"), lambda a, b: b)
    assert rows(t.read()) == rows(spark.createDataFrame([("1", 1), (None, 2), ("", 3)], "id string, v long"))
    one = spark.createDataFrame([("1", 0)], "id string, v long")
    t.merge(one, lambda a, b: a.join(b.select("id"), "id", "left_anti"))
    assert t.read().where("id = '1'").count() == 0 and t.read().count() == 2
    assert t.merge(one.limit(0), lambda a, b: b) == []


def test_a_failed_merge_changes_nothing(spark, tmp_path):
    t = table(spark, tmp_path / "t", 50)
    before = rows(t.read())
    with pytest.raises(Exception, match="broken"):
        t.merge(spark.createDataFrame([("7", "b", 7)], "id string, name string, v long"), lambda a, b: a.withColumn("name", F.raise_error(F.lit("broken"))))
    assert rows(t.read()) == before
    with pytest.raises(ValueError):
        BucketTable(spark, str(tmp_path / "t"), "id string", ["name"])


def test_a_lake_refuses_a_lost_change(spark, tmp_path):
    a, b = Lake(spark, str(tmp_path / "db")), Lake(spark, str(tmp_path / "db"))
    one = lambda x: spark.createDataFrame([(x,)], "x int")
    a.replace("t", one(1))
    old = b.read("t")
    a.replace("t", one(2))
    with pytest.raises(RuntimeError, match="another writer"):
        b.replace("t", old)
    assert a.read("t").first()[0] == 2
    b.read("t")
    b.replace("t", one(3))
    assert a.read("t").first()[0] == 3


def test_a_whole_table_is_dealt_once(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "db"))
    lake.replace("t", spark.createDataFrame([("1", 1), ("2", 2)], "id string, v long"))
    t = lake.buckets("t", "id string, v long, w string", ["id"], n=4)
    assert rows(lake.read("t")) == rows(spark.createDataFrame([("1", 1, None), ("2", 2, None)], "id string, v long, w string"))
    t.merge(spark.createDataFrame([("2", 5, "x", 0)], "id string, v long, w string, n int"), lambda a, b: keys.insert_or_replace(a, b, ["id"], "n"))
    assert {r["id"]: r["v"] for r in Lake(spark, str(tmp_path / "db")).buckets("t", "id string, v long, w string", ["id"], n=4).read().collect()} == {"1": 1, "2": 5}
