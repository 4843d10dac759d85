"""Listings tracked by key in a stream: new, updated and inactive, with a timer for each key."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class Tracker(StatefulProcessor):
    """The state of a key: when it was first and last seen, its last value, whether it is active. A key that isn't seen for ``ttl_ms`` becomes inactive at that time; the timer goes with each new sighting. The state is dropped ``keep_ms`` after that, so it doesn't grow with keys that are gone (a key that comes back later is new)."""

    def __init__(self, keys: list[str], ttl_ms: int, keep_ms: int):
        self.keys, self.ttl, self.keep = keys, ttl_ms, keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("seen", "first long, last long, value double, active boolean")

    def _rows(self, key: tuple, out: list[tuple]) -> pd.DataFrame:
        frame = pd.DataFrame([(*key, *r) for r in out], columns=[*self.keys, "action", "at_ms", "first_ms", "value"])
        return frame.astype({"at_ms": "int64", "first_ms": "int64", "value": "float64"})

    def _timer(self, old: int | None, new: int) -> None:
        if old is not None:
            self.handle.deleteTimer(old)
        self.handle.registerTimer(new)

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        d = pd.concat(list(rows)).sort_values(["seen_ms", "seen_value"], na_position="first")
        first, last, value, active = self.state.get() if self.state.exists() else (None, None, None, False)
        was = None if last is None else last + (self.ttl if active else self.ttl + self.keep) - 1
        out: list[tuple] = []
        for ms, v in zip(d["seen_ms"].tolist(), d["seen_value"].tolist(), strict=True):
            if first is None:
                first, out = ms, [*out, ("new", ms, ms, v)]
            else:
                if active and ms - last > self.ttl:
                    out.append(("inactive", last + self.ttl, first, value))
                first = min(first, ms)
                out.append(("updated" if ms >= last else "late", ms, first, v))
            if last is None or ms >= last:
                last, value, active = ms, v, True
        self.state.update((first, last, value, active))
        self._timer(was, last + self.ttl - 1)
        yield self._rows(key, out)

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if not self.state.exists():
            return
        first, last, value, active = self.state.get()
        end = last + self.ttl
        if active and timerValues.getCurrentWatermarkInMs() >= end:
            self.state.update((first, last, value, False))
            self.handle.registerTimer(end + self.keep - 1)
            yield self._rows(key, [("inactive", end, first, value)])
        elif active:
            self.handle.registerTimer(end)
        else:
            self.state.clear()

    def close(self) -> None:
        """The handle owns the state."""


def tracked(stream: DataFrame, keys: list[str], ts: str, value: str, ttl_ms: int, keep_ms: int = 1 << 42, late: str = "0 seconds") -> DataFrame:
    """keys, action, at_ms, first_ms, value: a row for each sighting (new, updated, or late if a later one was seen before) and one when a key becomes inactive. Time is that of the pulls: a listing is inactive once its source's pulls have gone on for ``ttl_ms`` without it, so each source has a stream of its own. Needs the session's state store to be RocksDB (see ``run_tracked``)."""
    d = stream.withWatermark(ts, late).select(*keys, ts, F.unix_millis(ts).alias("seen_ms"), F.col(value).cast("double").alias("seen_value"))
    kind = {f.name: f.dataType.simpleString() for f in stream.schema.fields}
    schema = ", ".join([f"{k} {kind[k]}" for k in keys] + ["action string", "at_ms long", "first_ms long", "value double"])
    return d.groupBy(*keys).transformWithStateInPandas(Tracker(keys, ttl_ms, keep_ms), schema, "Append", "EventTime")


def run_tracked(make: Callable[[], DataFrame], apply: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Runs what has landed with a RocksDB state store, and stops; a restart goes on from the checkpoint's state and timers. ``apply`` must be idempotent for a batch id."""
    df = make()
    spark, key = df.sparkSession, "spark.sql.streaming.stateStore.providerClass"
    was = spark.conf.get(key)
    spark.conf.set(key, PROVIDER)
    try:
        df.writeStream.outputMode("append").foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    finally:
        spark.conf.set(key, was)
