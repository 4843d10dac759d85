"""A stream of pulls against merging each pull as a batch."""

import json
from datetime import UTC, datetime

import duckdb
import pandas as pd
from pyspark.sql import functions as F

from lotline.operators import upsert
from lotline.streaming import tracked

DAY = 86_400_000


def land(path, day, ids):
    at = datetime.fromtimestamp(day * DAY / 1000, UTC).strftime("%Y-%m-%dT%H:%M:%S.000Z")
    (path / f"{day:03}.json").write_text("\n".join(json.dumps({"source": "a", "source_id": str(i), "at": at, "price": 100.0 * i + day}) for i in ids))


def test_new_updated_and_inactive_across_a_restart(spark, tmp_path):
    pulls = {1: [1, 2, 3], 2: [1, 3, 4], 3: [1, 2, 4], 4: [1], 5: [1, 4], 6: [1], 7: [1]}
    src, out = tmp_path / "in", str(tmp_path / "out")
    src.mkdir()
    make = lambda: tracked.tracked(spark.readStream.schema("source string, source_id string, at timestamp, price double").option("maxFilesPerTrigger", 1).json(str(src)), ["source", "source_id"], "at", "price", DAY)
    sink = lambda d, i: d.write.mode("overwrite").parquet(f"{out}/batch={i}")
    for days in ((1, 2, 3), (4, 5), (6, 7)):
        for day in days:
            land(src, day, pulls[day])
        tracked.run_tracked(make, sink, str(tmp_path / "checkpoint"))
    got = sorted((r["source_id"], r["at_ms"] // DAY, r["action"], r["value"]) for r in spark.read.parquet(out).collect())

    listings = spark.createDataFrame([], "source string, source_id string, price double, first_seen string, last_seen string, status string")
    want = []
    for day, ids in pulls.items():
        d = spark.createDataFrame([(str(i), 100.0 * i + day, i) for i in ids], "source_id string, price double, arrival long")
        merged = upsert.snapshot_merge(listings, d, "a", str(day), ["price"]).collect()
        want += [(r["source_id"], day, r["action"], r["price"]) for r in merged if r["action"] != "kept"]
        listings = spark.createDataFrame([r[:-1] for r in merged], "source string, source_id string, price double, first_seen string, last_seen string, status string").select("source", "source_id", "price", "first_seen", "last_seen", "status")
    assert got == sorted(want)


def test_state_is_dropped(spark, tmp_path):
    """A key that is gone for long is new when it comes back: its state was dropped."""
    src, out = tmp_path / "in", str(tmp_path / "out")
    src.mkdir()
    for day in range(1, 9):
        land(src, day, [1, 2] if day in (1, 8) else [1])
    make = lambda: tracked.tracked(spark.readStream.schema("source string, source_id string, at timestamp, price double").option("maxFilesPerTrigger", 1).json(str(src)), ["source", "source_id"], "at", "price", DAY, keep_ms=2 * DAY)
    tracked.run_tracked(make, lambda d, i: d.write.mode("overwrite").parquet(f"{out}/batch={i}"), str(tmp_path / "checkpoint"))
    got = sorted((r["at_ms"] // DAY, r["action"]) for r in spark.read.parquet(out).where(F.col("source_id") == "2").collect())
    assert got == [(1, "new"), (2, "inactive"), (8, "new")]


def test_times_between_milliseconds(spark, tmp_path):
    """Sightings within, at and beyond a day of each other once they are rounded, against the query's SQL."""
    from lotline.plans import catalog

    at = 1_704_067_200_000_000  # microseconds
    micros = {1: [0, 499, 500, 86_400_000_499], 2: [1_500, 86_400_001_999], 3: [700, 86_400_001_500], 4: [3_499], 5: [3_500], 6: [4_499], 7: [1, 999], 8: [86_400_003_600]}
    rows = [(user, pd.Timestamp(at + t, unit="us"), 1.0) for user, ts in micros.items() for t in ts]
    path = str(tmp_path / "events.parquet")
    pd.DataFrame(rows, columns=["user_id", "ts", "value"]).astype({"ts": "datetime64[us]"}).to_parquet(path)
    names = ["user_id", "n_new", "n_updated", "n_inactive", "first_ms", "last_ms"]
    want = duckdb.sql(catalog.ORACLES["t02_tracked"].replace("FROM events", f"FROM '{path}'")).df()
    got = catalog.QUERIES["t02_tracked"](spark, str(tmp_path)).select(names).collect()
    assert sorted(map(tuple, got)) == sorted(want[names].astype("int64").itertuples(index=False, name=None))
