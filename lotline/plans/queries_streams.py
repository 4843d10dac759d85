"""Incremental runs over the driver's events: each stream reads what has landed and stops."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotline.buckets import BucketTable
from lotline.functions.ids import row_hash
from lotline.plans.catalog import query, read
from lotline.session import scratch
from lotline.streaming import incremental

c = F.col


def _landed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, str]:
    path = f"{sf_dir}/events.parquet"
    # as a pattern, since a plain path has to be a folder and the table may be a single file
    return incremental.stream_files(spark, f"{path[:-1]}[t]", spark.read.parquet(path).schema), scratch(spark, "stream")


@query("SELECT user_id, count(*) AS events, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS first_seen, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS last_seen FROM events GROUP BY user_id")
def t02_stream_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State by key: a batch writes the keys that it changed, and the last state of a key counts."""
    stream, at = _landed(spark, sf_dir)
    state = incremental.latest_by_key(stream, "user_id", "ts", "value")
    q = state.writeStream.outputMode("update").foreachBatch(lambda d, i: d.write.mode("overwrite").parquet(f"{at}/state/batch={i}")).option("checkpointLocation", f"{at}/checkpoint").trigger(availableNow=True).start()
    q.awaitTermination()
    last = spark.read.parquet(f"{at}/state").groupBy("user_id").agg(F.max_by(F.struct("events", "first_seen", "last_seen"), "batch").alias("s"))
    text = lambda n: F.date_format(f"s.{n}", "yyyy-MM-dd HH:mm:ss").alias(n)
    return last.select("user_id", "s.events", text("first_seen"), text("last_seen"))


@query("SELECT event_type, count(*) AS n, count(DISTINCT event_id) AS ids FROM events GROUP BY event_type")
def t06_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages that are delivered twice add nothing: each batch meets the buckets of the stage that its hashes touch, so no state grows."""
    stream, at = _landed(spark, sf_dir)
    again, _ = _landed(spark, sf_dir)
    page = lambda d: d.select("event_id", "event_type", F.to_json(F.struct("event_id", "user_id", "event_type", "value")).alias("payload"))
    table = BucketTable(spark, f"{at}/stage", "event_id long, event_type string, payload string, row_id string, resolved_at string", ["row_id"], buckets=8)
    incremental.stage_batches(page(stream).union(page(again)), table, f"{at}/checkpoint")
    return table.read().groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("event_id").alias("ids"))


@query("SELECT event_type, strftime(time_bucket(INTERVAL 1 HOUR, ts), '%Y-%m-%d %H:%M:%S') AS hour, count(*) AS n FROM events GROUP BY ALL")
def t10_windowed_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events by hour and type of all that has landed. Files come in any order of time, one in each batch, so no watermark closes a window."""
    stream, at = _landed(spark, sf_dir)
    timed = stream.withColumn("ts", c("ts").cast("timestamp"))
    counts = incremental.windowed_counts(timed, "ts", "event_type", late=None)
    q = counts.writeStream.outputMode("update").foreachBatch(lambda d, i: d.write.mode("overwrite").parquet(f"{at}/out/batch={i}")).option("checkpointLocation", f"{at}/checkpoint").trigger(availableNow=True).start()
    q.awaitTermination()
    out = spark.read.parquet(f"{at}/out")
    latest = out.groupBy("event_type", "window").agg(F.max_by("n", "batch").alias("n"))
    return latest.select("event_type", F.date_format("window.start", "yyyy-MM-dd HH:mm:ss").alias("hour"), "n")


@query("SELECT count(*) AS staged, count(*) FILTER (WHERE event_id % 3 = 0) AS resolved FROM (SELECT DISTINCT event_id, event_type FROM events)")
def t07_mark_resolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read(spark, sf_dir, "events").select("event_id", F.concat_ws("|", "event_id", "event_type").alias("payload"))
    staged = incremental.stage(d.union(d), d.limit(0).withColumn("row_id", row_hash(c("payload"))))
    once = incremental.mark_resolved(staged, staged.where("event_id % 3 = 0"), "2026-01-01 00:00:00")
    twice = incremental.mark_resolved(once, staged.where("event_id % 3 = 0"), "2026-01-02 00:00:00")
    return twice.agg(F.count(F.lit(1)).alias("staged"), F.count_if(c("resolved_at") == "2026-01-01 00:00:00").alias("resolved"))
