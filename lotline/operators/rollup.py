"""Counts and latest dates of events for each building."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotline.functions.numbers import ratio


def event_rollup(events: DataFrame, count: str, last: str, key: str = "bbl", open_: Column | None = None) -> DataFrame:
    """Rows and the latest date by key; null dates never are the latest. ``open_``: a condition that is counted too."""
    more = [F.count_if(open_).alias(f"{count}_open")] if open_ is not None else []
    return events.groupBy(key).agg(F.count(F.lit(1)).alias(count), F.max("event_date").alias(last), *more)


def sales(master: DataFrame, legals: DataFrame) -> DataFrame:
    """One row per deed and lot that it touches."""
    return master.join(legals, "document_id")


def resolve_rate(rows: DataFrame, attempted: Column, resolved: Column) -> DataFrame:
    out = rows.agg(F.count_if(attempted).alias("attempted"), F.count_if(attempted & resolved).alias("resolved"))
    return out.withColumn("rate", ratio(F.col("resolved"), F.col("attempted")))


def path_counts(rows: DataFrame, path: Column) -> DataFrame:
    """How many rows took each way."""
    return rows.groupBy(path.alias("path")).agg(F.count(F.lit(1)).alias("n"))


def status_counts(matches: DataFrame, statuses: tuple[str, ...] = ("resolved", "unresolved", "ambiguous", "not_a_dwelling")) -> DataFrame:
    """Importer statistics: one row a source, a column a status."""
    return matches.groupBy("source").agg(F.count(F.lit(1)).alias("observations"), *[F.count_if(F.col("status") == s).alias(s) for s in statuses])
