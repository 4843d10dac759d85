"""Merges by buckets, releases by tasks, paged streams and searches in space, over the driver's tables."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotline.buckets import BucketTable
from lotline.functions.documents import canonical_payload
from lotline.operators import coverage, enrich, export, keys, spatial, upsert
from lotline.plans.catalog import query, read
from lotline.session import scratch
from lotline.sources import paged
from lotline.sources.release import place
from lotline.streaming import incremental, tracked

c = F.col
text = lambda x: x.cast("string")


@query("""
WITH pulls AS (SELECT o_orderpriority AS source, o_custkey::VARCHAR AS source_id, o_totalprice AS price, o_orderkey, year(o_orderdate) // 4 * 4 AS y FROM orders),
last_pull AS (SELECT source, max(y) AS last_y FROM pulls GROUP BY 1)
SELECT source, source_id, arg_max(price, (y, o_orderkey)) AS price, min(y)::VARCHAR AS first_seen, max(y)::VARCHAR AS last_seen, CASE WHEN max(y) = any_value(last_y) THEN 'active' ELSE 'inactive' END AS status
FROM pulls JOIN last_pull USING (source) GROUP BY source, source_id
""")
def d17_bucket_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A pull of each source for each four years, merged into the buckets that it touches: the customers of those years' orders of a priority."""
    o = read(spark, sf_dir, "orders").select(c("o_orderpriority").alias("source"), text(c("o_custkey")).alias("source_id"), c("o_totalprice").alias("price"), c("o_orderkey").alias("arrival"), (F.floor(F.year("o_orderdate") / 4) * 4).alias("y"))
    t = BucketTable(spark, scratch(spark, "buckets"), "source string, source_id string, price double, first_seen string, last_seen string, status string", ["source_id"], ["source"], buckets=4)
    for y in sorted(r[0] for r in o.select("y").distinct().collect()):
        for source in sorted(r[0] for r in o.where(c("y") == y).select("source").distinct().collect()):
            got = o.where((c("y") == y) & (c("source") == source)).drop("y")
            gone = (c("source") == source) & (c("status") == "active") & (c("last_seen") < str(y))
            t.merge(got, lambda old, new, s=source, n=str(y): upsert.snapshot_merge(old, new.drop("source"), s, n, ["price"]), also=gone)
    return t.read()


@query("SELECT p_partkey::VARCHAR AS id, p_brand AS name, p_size AS v FROM part WHERE p_size % 2 = 0 UNION ALL SELECT p_partkey::VARCHAR, p_type, p_size + 100 FROM part WHERE p_size % 2 = 1")
def k03_bucket_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read(spark, sf_dir, "part")
    t = BucketTable(spark, scratch(spark, "buckets"), "id string, name string, v long", ["id"], buckets=8)
    row = lambda name, v: p.select(text(c("p_partkey")).alias("id"), c(name).alias("name"), v.cast("long").alias("v"), F.lit(0).alias("n"), "p_size")
    t.merge(row("p_brand", c("p_size")).drop("n", "p_size"), lambda old, new: new)
    t.merge(row("p_type", c("p_size") + 100).where("p_size % 2 = 1").drop("p_size"), lambda old, new: keys.insert_or_replace(old, new, ["id"], "n"))
    return t.read()


@query("SELECT 'lines.csv' AS file, l_orderkey::VARCHAR AS a, l_linenumber::VARCHAR AS b, l_returnflag AS c, (SELECT count(*) FROM lineitem) AS in_manifest FROM lineitem UNION ALL SELECT 'orders.csv', o_orderkey::VARCHAR, o_orderstatus, o_orderpriority, (SELECT count(*) FROM orders) FROM orders")
def k06_release_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A release of two files, read back by its manifest."""
    at = scratch(spark, "release")
    l = read(spark, sf_dir, "lineitem").select(c("l_orderkey").alias("k"), F.lpad(text(c("l_orderkey")), 12, "0").alias("at"), "l_linenumber", "l_returnflag")  # noqa: E741
    o = read(spark, sf_dir, "orders").select(c("o_orderkey").alias("k"), F.lpad(text(c("o_orderkey")), 12, "0").alias("at"), "o_orderstatus", "o_orderpriority")
    files = {"lines.csv": (["k", "l_linenumber", "l_returnflag"], ["at"]), "orders.csv": (["k", "o_orderstatus", "o_orderpriority"], ["at"])}
    m = export.release_parts(at, {"lines.csv": l, "orders.csv": o}, "2026-01-01 00:00:00", files=files)
    out = []
    for name, f in m["files"].items():
        parts = [f"{at}/{name}/{p['name']}" for p in f["parts"][1:]]
        d = spark.read.schema("a string, b string, c string").csv(parts) if parts else spark.createDataFrame([], "a string, b string, c string")
        out.append(d.select(F.lit(name).alias("file"), "a", "b", "c", F.lit(f["rows"]).cast("long").alias("in_manifest")))
    return out[0].unionByName(out[1])


def _pages(spark: SparkSession, rows: DataFrame, size: int) -> tuple[str, int]:
    """Rows as pages of a feed, in files that tasks write: their folder, and how many rows there are."""
    at = scratch(spark, "feed")
    d = incremental.positioned(rows)
    d.write.parquet(f"{at}/rows")
    staged = spark.read.parquet(f"{at}/rows")
    n = staged.count()
    first, sizes = {}, sorted((r["part"], r["count"]) for r in staged.groupBy("part").count().collect())  # a row a file
    for part, count in sizes:
        first[part] = sum(k for p, k in sizes if p < part)
    start = F.create_map(*[F.lit(x) for kv in first.items() for x in kv]) if first else F.lit(None).cast("map<long,long>")
    numbered = staged.select(F.struct(*[x for x in staged.columns if x not in ("part", "at")]).alias("r"), (start[c("part")] + c("at")).alias("i"))
    bodies = numbered.groupBy(F.floor(c("i") / size).cast("long").alias("page")).agg(F.to_json(F.transform(F.array_sort(F.collect_list(F.struct("i", "r"))), lambda x: x["r"])).alias("body"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for page, body in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                fs, root = place(at)
                with fs.open_output_stream(f"{root}/{page + 1}.json") as f:
                    f.write(body.encode())
            yield b.select(["page"])

    bodies.mapInArrow(write, "page long").count()
    fs, root = place(at)
    with fs.open_output_stream(f"{root}/count.json") as f:
        f.write(json.dumps([{"count": n}]).encode())
    return at, n


@query("SELECT event_id::VARCHAR AS event_id, event_type FROM events")
def t05_paged_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as a feed of pages, streamed: the offset lies in the checkpoint with the rows."""
    at, _ = _pages(spark, read(spark, sf_dir, "events").select("event_id", "event_type"), 1000)
    paged.register(spark)
    url = paged.folder_url(at)
    stream = spark.readStream.format("paged_feed").option("url", f"{url}/{{page}}.json").option("count", f"{url}/count.json").option("fields", "event_id,event_type").option("page_size", 1000).load()
    incremental.run_available(stream, lambda d, i: d.write.mode("overwrite").parquet(f"{at}/out/batch={i}"), f"{at}/checkpoint")
    return spark.read.parquet(f"{at}/out").select("event_id", "event_type")


@query("SELECT event_id::VARCHAR AS event_id, event_type FROM events WHERE event_type = 'click' OR event_type LIKE 'p%'")
def s15_counted_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A task for each page, or run of pages, of a feed that says how many rows it has; the filter goes to the feed, and holds whether or not it is heard."""
    at, _ = _pages(spark, read(spark, sf_dir, "events").select("event_id", "event_type"), 1000)
    paged.register(spark)
    url = paged.folder_url(at)
    d = spark.read.format("paged_feed").option("url", f"{url}/{{page}}.json").option("count", f"{url}/count.json").option("fields", "event_id,event_type").option("page_size", 1000).load()
    return d.where("event_type = 'click' OR event_type LIKE 'p%'")


# Searches in space: customers as points, suppliers as places.
POINTS = "SELECT c_custkey, 40.5e0 + (c_custkey % 400) / 1000e0 AS lat, -74.2e0 + (c_custkey % 433) / 1000e0 AS lng FROM customer"
PLACES = "SELECT s_suppkey, s_name, 40.5e0 + (s_suppkey % 37) / 100e0 AS slat, -74.2e0 + (s_suppkey % 41) / 100e0 AS slng FROM supplier"
AWAY = "12742000e0 * asin(sqrt(pow(sin(radians(slat - lat) / 2), 2) + cos(radians(lat)) * cos(radians(slat)) * pow(sin(radians(slng - lng) / 2), 2)))"


def _points(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = c("c_custkey")
    return read(spark, sf_dir, "customer").select("c_custkey", (F.lit(40.5) + (k % 400) / F.lit(1000.0)).alias("latitude"), (F.lit(-74.2) + (k % 433) / F.lit(1000.0)).alias("longitude"))


def _places(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = c("s_suppkey")
    return read(spark, sf_dir, "supplier").select(k, c("s_name").alias("name"), (F.lit(40.5) + (k % 37) / F.lit(100.0)).alias("lat"), (F.lit(-74.2) + (k % 41) / F.lit(100.0)).alias("lng"))


@query(f"SELECT c_custkey, count(*) FILTER (WHERE d <= 5000) AS n FROM (SELECT c_custkey, {AWAY} AS d FROM ({POINTS}), ({PLACES})) GROUP BY c_custkey")
def j24_within(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spatial.count_within(_points(spark, sf_dir), _places(spark, sf_dir), 5000.0, out="n").select("c_custkey", "n")


@query(f"SELECT c_custkey, rank, s_name AS name, round(d, 3) AS metres FROM (SELECT c_custkey, s_name, d, row_number() OVER (PARTITION BY c_custkey ORDER BY d, s_name) AS rank FROM (SELECT c_custkey, s_name, {AWAY} AS d FROM ({POINTS}), ({PLACES}))) WHERE rank <= 3")
def j24_three_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = spatial.k_nearest(_points(spark, sf_dir), _places(spark, sf_dir).select("name", "lat", "lng"), 3)
    return d.select("c_custkey", F.posexplode("nearest").alias("i", "x")).select("c_custkey", (c("i") + 1).cast("long").alias("rank"), c("x.name").alias("name"), F.round("x.distance", 3).alias("metres"))


def _rings(k: str, lng: str, lat: str) -> list[list[tuple[str, str]]]:
    """An octagon around a place, and a square hole: corners as texts that both engines read."""
    r = f"(0.0101e0 + ({k} % 7) * 0.0103e0)"
    octagon = [(f"{lng} + {a}e0 * {r}", f"{lat} + {b}e0 * {r}") for a, b in ((1, 0), (0.75, 0.75), (0, 1), (-0.75, 0.75), (-1, 0), (-0.75, -0.75), (0, -1), (0.75, -0.75))]
    square = [(f"{lng} + {a}e0 * {r}", f"{lat} + {b}e0 * {r}") for a, b in ((0.25, 0.25), (-0.25, 0.25), (-0.25, -0.25), (0.25, -0.25))]
    return [octagon, square]


def _areas_sql() -> str:
    edges = []
    for ring, corners in enumerate(_rings("s_suppkey", "slng", "slat")):
        for i, (x, y) in enumerate(corners):
            px, py = corners[i - 1]
            edges.append(f"SELECT s_suppkey, {x} AS x, {y} AS y, {px} AS px, {py} AS py FROM ({PLACES})")
    crossing = "(y > lat) <> (py > lat) AND lng < (px - x) * (lat - y) / (py - y + 1e-16) + x"
    return f"SELECT c_custkey, s_suppkey AS area FROM (SELECT c_custkey, s_suppkey, count(*) FILTER (WHERE {crossing}) AS n FROM ({POINTS}), ({' UNION ALL '.join(edges)}) GROUP BY ALL) WHERE n % 2 = 1"


@query(_areas_sql())
def j25_in_areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Areas with holes around each supplier, and the customers in them."""
    p = _places(spark, sf_dir)
    corner = lambda x, y: F.struct(F.expr(x).alias("lng"), F.expr(y).alias("lat"))
    rings = F.array(*[F.array(*[corner(x, y) for x, y in ring]) for ring in _rings("s_suppkey", "lng", "lat")])
    a = p.select(c("s_suppkey").alias("area"), rings.alias("rings"))
    return spatial.in_areas(_points(spark, sf_dir), a, holes=True).select("c_custkey", "area")


@query(f"SELECT c_custkey::VARCHAR AS bbl, count(*) FILTER (WHERE d <= 8000 AND s_suppkey % 2 = 0) AS n_even, count(*) FILTER (WHERE d <= 8000 AND s_suppkey % 2 = 1) AS n_odd FROM (SELECT c_custkey, s_suppkey, {AWAY} AS d FROM ({POINTS}), ({PLACES})) GROUP BY c_custkey")
def x08_amenities(spark: SparkSession, sf_dir: str) -> DataFrame:
    kinds = _places(spark, sf_dir).select(F.when(c("s_suppkey") % 2 == 0, "even").otherwise("odd").alias("kind"), "lat", "lng")
    return enrich.amenities(_points(spark, sf_dir).withColumn("bbl", text(c("c_custkey"))), kinds, 8000.0)


# Payloads, reports and tracking.


@query("""SELECT c_custkey, concat('{"a": {"name": "', replace(c_name, '"', '\\"'), '", "none": null}, "m": [', c_nationkey, ', "', c_mktsegment, ', x: y"], "z\\u00e9": "\\u00fc\\ud83d\\ude00', c_custkey, '"}') AS payload FROM customer""")
def f61_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested, non-ASCII and null values in the one form of a payload, whatever the order and spacing they came in."""
    raw = F.concat(F.lit('{"zé":"ü😀'), text(c("c_custkey")), F.lit('" , "m":['), text(c("c_nationkey")), F.lit(',"'), c("c_mktsegment"), F.lit(', x: y"],\n"a":{"none":null,"name":'), F.to_json(F.array("c_name")).substr(F.lit(2), F.length(F.to_json(F.array("c_name"))) - 2), F.lit("}}"))
    return read(spark, sf_dir, "customer").select("c_custkey", canonical_payload(raw).alias("payload"))


@query("SELECT 'l_returnflag' AS key, l_returnflag AS value, count(*) AS n FROM lineitem GROUP BY 2 UNION ALL SELECT 'l_linestatus', l_linestatus, count(*) FROM lineitem GROUP BY 2 UNION ALL SELECT 'l_linenumber', l_linenumber::VARCHAR, count(*) FROM lineitem GROUP BY 2 UNION ALL SELECT NULL, NULL, count(*) FROM lineitem")
def g17_all_distributions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage.all_distributions(read(spark, sf_dir, "lineitem"), ["l_returnflag", "l_linestatus", "l_linenumber"])


RUN = "SELECT o_custkey AS k, min(o_orderpriority) AS status, count(*) AS n FROM orders WHERE {} GROUP BY 1"
RUNS = (RUN.format("o_orderstatus <> 'O'"), RUN.format("o_orderstatus <> 'F'"))


def _run_of(spark: SparkSession, sf_dir: str, other: str) -> DataFrame:
    return read(spark, sf_dir, "orders").where(c("o_orderstatus") != other).groupBy(text(c("o_custkey")).alias("bbl")).agg(F.min("o_orderpriority").alias("status"), F.count(F.lit(1)).alias("n"))


@query(f"SELECT coalesce(a.k, b.k)::VARCHAR AS bbl, CASE WHEN a.k IS NULL THEN 'entered' WHEN b.k IS NULL THEN 'left' ELSE 'changed' END AS change, a.status AS status_before, b.status AS status_after, a.n AS n_before, b.n AS n_after FROM ({RUNS[0]}) a FULL JOIN ({RUNS[1]}) b USING (k) WHERE a.k IS NULL OR b.k IS NULL OR a.status <> b.status OR a.n <> b.n")
def t08_coverage_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two stored runs, and what they differ by."""
    at = scratch(spark, "coverage")
    for run, other in (("r1", "O"), ("r2", "F")):
        coverage.store_run(_run_of(spark, sf_dir, other), at, run)
    return coverage.run_difference(*(coverage.stored_run(spark, at, r) for r in ("r1", "r2")), "bbl", ["status", "n"])


@query("SELECT DISTINCT o_custkey FROM orders WHERE o_orderstatus = 'F' AND o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'O')")
def u06_newly_resolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders").select("o_custkey", "o_orderstatus")
    return coverage.newly_resolved(o.where("o_orderstatus = 'O'"), o.where("o_orderstatus = 'F'"), ["o_custkey"])


@query("""
WITH e AS (SELECT user_id, epoch_ms(ts) AS t FROM events), g AS (SELECT *, t - lag(t) OVER (PARTITION BY user_id ORDER BY t) AS gap FROM e)
SELECT user_id, count(*) FILTER (WHERE gap IS NULL) AS n_new, count(*) FILTER (WHERE gap IS NOT NULL) AS n_updated, count(*) FILTER (WHERE gap > 86400000) + CASE WHEN (SELECT max(t) FROM e) - max(t) >= 86400000 THEN 1 ELSE 0 END AS n_inactive, min(t) AS first_ms, max(t) AS last_ms FROM g GROUP BY user_id
""")
def t02_tracked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user's events as sightings: new, updated, and inactive a day after one that no other follows. Times are to the nearest millisecond, as the SQL takes them, before the stream's watermark is."""
    at, path = scratch(spark, "tracked"), f"{sf_dir}/events.parquet"
    schema = spark.read.parquet(path).schema

    def make() -> DataFrame:
        # all files in one batch: sightings of a key are taken in order of time
        d = incremental.stream_files(spark, f"{path[:-1]}[t]", schema, 1_000_000)
        return tracked.tracked(d.withColumn("ts", F.timestamp_micros(F.round(F.unix_micros(c("ts").cast("timestamp")), -3))), ["user_id"], "ts", "value", 86_400_000)

    tracked.run_tracked(make, lambda d, i: d.write.mode("overwrite").parquet(f"{at}/out/batch={i}"), f"{at}/checkpoint")
    n = lambda a: F.count_if(c("action") == a).alias(f"n_{a}")
    seen = F.when(c("action") != "inactive", c("at_ms"))
    return spark.read.parquet(f"{at}/out").groupBy("user_id").agg(n("new"), n("updated"), n("inactive"), F.min(seen).alias("first_ms"), F.max(seen).alias("last_ms"))
