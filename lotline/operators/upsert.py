"""Merges of incoming rows into tables. Each returns the new table; a caller overwrites or appends."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotline.operators.keys import first_wins, insert_new, last_wins


def snapshot_merge(current: DataFrame, incoming: DataFrame, source: str, now: str, fields: Sequence[str], present: Mapping[str, str] | None = None, arrival: str = "arrival") -> DataFrame:
    """A pull of one source into the listings table, keyed by (source, source_id).

    Known keys keep first_seen; all pulled keys get last_seen = now and status active; keys of the same source that the pull lacks and that were last seen before ``now`` become inactive; other sources stay as they are. ``present``: field -> boolean column that says whether the feed's row had the field (a present null overwrites, an absent one keeps the old value); without it all fields count as present. ``action`` says new, updated, inactive or kept. An empty pull changes nothing.
    """
    present = dict(present or {})
    new = last_wins(incoming.withColumn("source", F.lit(source)), ["source", "source_id"], arrival)
    if new.isEmpty():
        return current.select("source", "source_id", *fields, "first_seen", "last_seen", "status", F.lit("kept").alias("action"))
    mine, others = current.where(F.col("source") == source), current.where(~F.col("source").eqNullSafe(source))
    n = new.select("source_id", F.lit(True).alias("__new"), *[F.col(f).alias(f"__n_{f}") for f in fields], *[F.col(p).alias(f"__p_{f}") for f, p in present.items()])
    both = mine.withColumn("__old", F.lit(True)).join(n, "source_id", "full_outer")
    there = F.col("__new").isNotNull()
    value = lambda f: F.when(there & (F.col(f"__p_{f}") if f in present else F.lit(True)), F.col(f"__n_{f}")).otherwise(F.col(f)).alias(f)
    gone = ~there & (F.col("last_seen") < now)
    out = both.select(
        F.lit(source).alias("source"), "source_id", *[value(f) for f in fields],
        F.coalesce("first_seen", F.lit(now)).alias("first_seen"),
        F.when(there, F.lit(now)).otherwise(F.col("last_seen")).alias("last_seen"),
        F.when(there, F.lit("active")).when(gone, F.lit("inactive")).otherwise(F.col("status")).alias("status"),
        F.when(there & F.col("__old").isNull(), "new").when(there, "updated").when(gone & (F.col("status") == "active"), "inactive").otherwise("kept").alias("action"),
    )
    return out.unionByName(others.select("source", "source_id", *fields, "first_seen", "last_seen", "status", F.lit("kept").alias("action")))


def history_rows(incoming: DataFrame, source: str, today: str, arrival: str = "arrival") -> DataFrame:
    """The price history of a pull: the day's last row per key."""
    rows = incoming.select(F.lit(source).alias("source"), "source_id", F.lit(today).alias("snapshot_date"), "price", "lease_terms", F.lit("active").alias("status"), arrival)
    return last_wins(rows, ["source", "source_id", "snapshot_date"], arrival).drop(arrival)


def pull_log(merged: DataFrame, source: str, now: str) -> DataFrame:
    count = lambda a: F.count_if(F.col("action") == a)
    return merged.where(F.col("source") == source).agg((count("new") + count("updated")).alias("listings_count"), count("new").alias("new_count"), count("updated").alias("updated_count")).select(F.lit(source).alias("source"), F.lit(now).alias("pulled_at"), "*")


def partial_upsert(current: DataFrame, incoming: DataFrame, key: str, fields: Sequence[str], present: Mapping[str, str], now: str | None = None) -> DataFrame:
    """One row per key; a field is written where its presence column is true, null or not, and kept elsewhere."""
    n = incoming.select(key, F.lit(True).alias("__new"), *[F.col(f).alias(f"__n_{f}") for f in fields], *[F.col(present[f]).alias(f"__p_{f}") for f in fields])
    both = current.join(n, key, "full_outer")
    extra = [F.coalesce("first_seen", F.lit(now)).alias("first_seen"), F.when(F.col("__new"), F.lit(now)).otherwise(F.col("last_seen")).alias("last_seen")] if now else []
    return both.select(key, *[F.when(F.coalesce(f"__p_{f}", F.lit(False)), F.col(f"__n_{f}")).otherwise(F.col(f)).alias(f) for f in fields], *extra)


def add_events(current: DataFrame, incoming: DataFrame, arrival: str = "arrival") -> DataFrame:
    """The events that are new by (bbl, event_type, event_date, source, detail): a null detail equals '', a null date never equals another."""
    keys = ["bbl", "event_type", "event_date", "source", "__detail"]
    e = incoming.withColumn("__detail", F.coalesce("detail", F.lit("")))
    dated = first_wins(e.where(F.col("event_date").isNotNull()), keys, arrival)
    fresh = insert_new(current.where(F.col("event_date").isNotNull()).withColumn("__detail", F.coalesce("detail", F.lit(""))), dated, keys)
    return fresh.unionByName(e.where(F.col("event_date").isNull())).drop("__detail")


def address_upsert(current: DataFrame, incoming: DataFrame, arrival: str = "arrival", keep_zip: bool = False) -> DataFrame:
    """By (bbl, normalized): address and zip are overwritten (``keep_zip``: an old zip stays), the source of the first row never is. Sources that came later are kept in ``sources``."""
    new = last_wins(incoming, ["bbl", "normalized"], arrival).drop(arrival)
    n = new.select("bbl", "normalized", *[F.col(c).alias(f"__{c}") for c in ("address", "zipcode", "source")])
    both = current.join(n, ["bbl", "normalized"], "full_outer")
    zipcode = F.coalesce("zipcode", "__zipcode") if keep_zip else F.when(F.col("__source").isNotNull(), F.col("__zipcode")).otherwise(F.col("zipcode"))
    return both.select("bbl", "normalized", F.coalesce("__address", "address").alias("address"), zipcode.alias("zipcode"), F.coalesce("source", "__source").alias("source"), F.array_sort(F.array_distinct(F.filter(F.array("source", "__source"), lambda x: x.isNotNull()))).alias("sources"))


def unit_upsert(current: DataFrame, incoming: DataFrame, keys: Sequence[str], ids: str, label: str, arrival: str = "arrival", keep_label: bool = False) -> DataFrame:
    """Units or premises: id and first_seen of the first row stay, label and last_seen are those of the last."""
    a = current.withColumn(arrival, F.lit(-1).cast("long")).unionByName(incoming, allowMissingColumns=True)
    by_label = F.min_by if keep_label else F.max_by
    return a.groupBy(*keys).agg(F.min_by(ids, arrival).alias(ids), by_label(label, F.col(arrival)).alias(label), F.min_by("first_seen", arrival).alias("first_seen"), F.max("last_seen").alias("last_seen"))


def match_upsert(current: DataFrame, incoming: DataFrame, order: str = "pass_no") -> DataFrame:
    """The last claim for each (observation_id, entity_type)."""
    return last_wins(current.unionByName(incoming), ["observation_id", "entity_type"], order)


def names(raw: Column, marker: str) -> Column:
    """Whether a text holds the marker, in any case."""
    return raw.ilike(f"%{marker}%")


def demote(matches: DataFrame, units: DataFrame, observations: DataFrame, marker: str = "TEXT_MINED") -> tuple[DataFrame, DataFrame]:
    """Unit claims of observations whose raw fields name ``marker`` become unresolved, and units without another resolved claim go."""
    mined = observations.where(names(F.col("raw_fields"), marker)).select("observation_id").distinct().withColumn("__mined", F.lit(True))
    m = matches.join(mined, "observation_id", "left").withColumn("__was", F.col("__mined").isNotNull() & (F.col("entity_type") == "unit") & (F.col("status") == "resolved"))
    touched = m.where("__was").select(F.col("entity_id").alias("unit_id")).distinct()
    new = {"entity_id": F.when(F.col("__was"), F.lit(None)).otherwise(F.col("entity_id")), "status": F.when(F.col("__was"), F.lit("unresolved")).otherwise(F.col("status")), "confidence": F.when(F.col("__was"), F.lit(0.0)).otherwise(F.col("confidence"))}
    out = m.withColumns(new).select(*matches.columns)
    held = out.where("entity_type = 'unit' AND status = 'resolved'").select(F.col("entity_id").alias("unit_id")).distinct()
    lost = touched.join(held, "unit_id", "left_anti")
    return out, units.join(lost, "unit_id", "left_anti")


def with_columns_of(df: DataFrame, schema: Mapping[str, str]) -> DataFrame:
    """Schema evolution: the columns that ``df`` lacks, as nulls of the given type."""
    return df.select("*", *[F.lit(None).cast(t).alias(c) for c, t in schema.items() if c not in df.columns])
