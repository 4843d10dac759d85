"""Incremental runs: resumable pages, idempotent replays, and merges of streams.

State that must survive a run is a small Parquet table beside the data; within Structured Streaming it is the checkpoint.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lotline.buckets import BucketTable
from lotline.functions.ids import borough_code, row_hash
from lotline.operators.keys import insert_new


def scope_of(borough: str | int | None) -> str:
    """One name for a borough, however it was given."""
    return "all" if borough is None else str(borough_code(borough))


def next_offset(log: DataFrame, source: str, scope: str, explicit: int | None = None) -> int | None:
    """Where a paged run goes on: an explicit offset, else after the full pages; None once a short page was seen."""
    if explicit is not None:
        return explicit
    mine = log.where((F.col("source") == source) & (F.col("scope") == scope))
    r = mine.agg(F.count_if(F.col("rows") < F.col("requested")).alias("short"), F.max(F.when(F.col("rows") >= F.col("requested"), F.col("offset") + F.col("requested"))).alias("next")).first()
    return None if r["short"] else r["next"] or 0


def run_offset_pages(fetch: Callable[[int, int], DataFrame], sink: Callable[[DataFrame], None], start: int | None, page: int, pages: int) -> Iterator[tuple[int, int, int]]:
    """(offset, requested, rows) of each page; stops after a short one. A page is fetched once: ``sink`` runs it, and its rows are counted on the way."""
    offset = start
    for _ in range(pages if offset is not None else 0):
        seen = Observation()
        sink(fetch(offset, page).observe(seen, F.count(F.lit(1)).alias("rows")))
        rows = seen.get["rows"]
        yield offset, page, rows
        if rows < page:
            return
        offset += page


def run_keyset_pages(fetch: Callable[[tuple | None, int], DataFrame], sink: Callable[[DataFrame], None], cursor: tuple | None, key: tuple[str, ...], page: int, pages: int, durable: tuple | None = None, first: bool = False) -> Iterator[tuple | None]:
    """The cursor after each page: the least key of a page in descending order (``first``: the greatest, in ascending order). A cursor given by hand is refused where a durable one exists. As above, ``sink`` runs a page once."""
    if cursor is not None and durable is not None:
        raise ValueError("a durable cursor exists; it can't be set by hand")
    at = durable if durable is not None else cursor
    end = F.max if first else F.min
    for _ in range(pages):
        seen = Observation()
        sink(fetch(at, page).observe(seen, F.count(F.lit(1)).alias("n"), end(F.struct(*key)).alias("k")))
        r = seen.get
        at = tuple(r["k"]) if r["k"] is not None else None
        yield at
        if r["n"] < page or at is None:
            return


def positioned(feed: DataFrame) -> DataFrame:
    """``feed`` sorted by all its columns, with position from 0 on: what offset pages are cut from. Sorted once; to be written before pages are read."""
    d = feed.orderBy(*feed.columns).withColumn("__id", F.monotonically_increasing_id())
    return d.withColumns({"part": F.shiftright("__id", 33), "at": F.col("__id").bitwiseAND((1 << 33) - 1)}).drop("__id")


def page_of(staged: DataFrame, offset: int, n: int) -> DataFrame:
    """Rows ``offset`` to ``offset + n`` of a written ``positioned`` feed."""
    return Positions(staged).page(offset, n)


class Positions:
    """Where each part of a written ``positioned`` feed begins: counted once, a number for each part. A page then filters by constants, so only the files (and row groups) that hold it are read."""

    def __init__(self, staged: DataFrame):
        self.staged, self.parts, at = staged, [], 0
        for part, n in sorted((r["part"], r["count"]) for r in staged.groupBy("part").count().collect()):
            self.parts.append((part, at, n))
            at += n
        self.rows = at

    def page(self, offset: int, n: int) -> DataFrame:
        want = F.lit(False)
        for part, first, size in self.parts:
            low, high = max(offset, first) - first, min(offset + n, first + size) - first
            if low < high:
                want = want | ((F.col("part") == part) & F.col("at").between(low, high - 1))
        return self.staged.where(want).drop("part", "at")


def stage(raw: DataFrame, staged: DataFrame, payload: str = "payload") -> DataFrame:
    """Rows that the stage lacks, by the hash of their payload: a replayed page adds nothing."""
    d = raw.withColumn("row_id", row_hash(F.col(payload))).dropDuplicates(["row_id"])
    return d.join(staged.select("row_id"), "row_id", "left_anti").withColumn("resolved_at", F.lit(None).cast("string"))


def stage_stream(raw: DataFrame, payload: str = "payload") -> DataFrame:
    """The same of a stream: the state holds a hash for each payload, and a batch reads no more than itself. The state grows with the distinct payloads; ``stage_batches`` keeps none."""
    return raw.withColumn("row_id", row_hash(F.col(payload))).dropDuplicates(["row_id"]).withColumn("resolved_at", F.lit(None).cast("string"))


def stage_batches(stream: DataFrame, table: BucketTable, checkpoint: str, payload: str = "payload") -> None:
    """Stages a stream without state: each batch is merged into the buckets of the stage that its hashes touch, where rows that are there already stay. A batch that is run again adds nothing."""

    def insert(old: DataFrame, new: DataFrame) -> DataFrame:
        return old.unionByName(insert_new(old, new.dropDuplicates(["row_id"]), ["row_id"]), allowMissingColumns=True)

    def apply(batch: DataFrame, _: int) -> None:
        rows = batch.withColumn("row_id", row_hash(F.col(payload))).withColumn("resolved_at", F.lit(None).cast("string"))
        table.merge(rows, insert)

    run_available(stream, apply, checkpoint)


def mark_resolved(staged: DataFrame, done: DataFrame, now: str) -> DataFrame:
    """After the catalog has the rows: when they were resolved. Repeating it changes nothing."""
    d = done.select("row_id").distinct().withColumn("__done", F.lit(True))
    return staged.join(d, "row_id", "left").withColumn("resolved_at", F.coalesce("resolved_at", F.when(F.col("__done"), F.lit(now)))).drop("__done")


def slots_state(spark: SparkSession, buildings: DataFrame, cursor: str | None, batch: int) -> tuple[str | None, bool]:
    """(next cursor, completed) of a batch of capacity slots; an empty batch completes the run."""
    d = buildings.where("units_res > 0")
    d = d.where(F.col("bbl") > cursor) if cursor is not None else d
    last = d.orderBy("bbl").limit(batch).agg(F.max("bbl")).first()[0]
    return (cursor, True) if last is None else (last, False)


def stream_files(spark: SparkSession, path: str, schema: T.StructType, files: int = 1) -> DataFrame:
    """A stream of landed Parquet files, a bounded number of them in each batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path)


def run_available(stream: DataFrame, apply: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Runs what has landed, batch by batch, and stops; a restart goes on after the last finished batch. ``apply`` must be idempotent for a batch id."""
    q = stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()


def latest_by_key(stream: DataFrame, key: str, ts: str, value: str) -> DataFrame:
    """State of a stream: each key's events, bounds and last value; the same aggregate runs on a batch. Of values at the same time the greatest is the last."""
    return stream.groupBy(key).agg(F.count(F.lit(1)).alias("events"), F.min(ts).alias("first_seen"), F.max(ts).alias("last_seen"), F.max(F.struct(ts, value)).alias("__last")).withColumn("last_value", F.col("__last")[value]).drop("__last")


def distinct_rows(stream: DataFrame, key: str, ts: str, late: str) -> DataFrame:
    """At-least-once replays of a stream made exactly-once by key, within a watermark so that state stays bounded."""
    return stream.withWatermark(ts, late).dropDuplicatesWithinWatermark([key])


def windowed_counts(stream: DataFrame, ts: str, key: str, late: str | None = "1 hour", width: str = "1 hour") -> DataFrame:
    """Events by window and key, closed by a watermark that drops rows which come later; ``late`` None keeps every row, and the state of every window. An addition for streams: batch sources need none."""
    d = stream if late is None else stream.withWatermark(ts, late)
    return d.groupBy(F.window(ts, width), key).agg(F.count(F.lit(1)).alias("n"))
