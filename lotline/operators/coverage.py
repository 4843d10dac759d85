"""Coverage, capacity and quality reports."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lotline.functions import ids
from lotline.functions.numbers import ratio
from lotline.functions.text import blank_as


def listing_coverage(listings: DataFrame, resolved: DataFrame) -> DataFrame:
    """By source and zip: listings, how many have a resolved observation, and the rate."""
    r = resolved.select("source", "source_id").distinct().withColumn("__hit", F.lit(1))
    d = listings.where("status = 'active'").join(r, ["source", "source_id"], "left")
    out = d.groupBy("source", blank_as(F.col("zipcode"), "unknown").alias("zipcode")).agg(F.count(F.lit(1)).alias("listings"), F.count("__hit").alias("resolved"))
    out = out.withColumn("unresolved", F.col("listings") - F.col("resolved")).withColumn("resolution_rate", ratio(F.col("resolved"), F.col("listings"), 6))
    return out.orderBy(F.desc("listings"), "source", "zipcode")


def coverage_by_source(coverage: DataFrame) -> DataFrame:
    out = coverage.groupBy("source").agg(F.sum("listings").alias("listings"), F.sum("resolved").alias("resolved"))
    return out.withColumn("resolution_rate", ratio(F.col("resolved"), F.col("listings"), 6))


def listing_zips(listings: DataFrame) -> DataFrame:
    z = F.trim("zipcode")
    return listings.where("status = 'active'").where(z != "").select(z.alias("zipcode")).distinct().orderBy("zipcode")


def capacity_gaps(buildings: DataFrame, units: DataFrame, top: int, borough: int | None = None) -> DataFrame:
    """The buildings with the most units without a name."""
    if top <= 0:
        raise ValueError("a positive number of rows is needed")
    named = units.groupBy("bbl").agg(F.count(F.lit(1)).alias("named"))
    d = buildings.where("units_res > 0").where(ids.in_borough(F.col("bbl"), borough)).join(named, "bbl", "left")
    d = d.withColumn("named", F.coalesce("named", F.lit(0))).withColumn("unnamed", F.col("units_res") - F.col("named"))
    return d.where("unnamed > 0").orderBy(F.desc("unnamed"), F.desc("units_res"), "bbl").limit(top)


def capacity_slots(buildings: DataFrame, run_id: str, after: str | None = None, batch: int | None = None) -> DataFrame:
    """bbl, slot_ordinal 1 to units_res: no join. With ``after`` and ``batch``, of the next buildings above a cursor."""
    d = buildings.where("units_res > 0").select("bbl", "units_res")
    if after is not None:
        d = d.where(F.col("bbl") > after)
    if batch is not None:
        d = d.orderBy("bbl").limit(batch)
    d = d.select("bbl", F.explode(F.sequence(F.lit(1), F.col("units_res"))).alias("slot_ordinal"))
    return d.select(ids.catalog_id("slot", F.col("bbl"), F.col("slot_ordinal")).alias("slot_id"), "bbl", "slot_ordinal", F.lit(run_id).alias("run_id"))


def membership(unexpired: Column, registered: Column, units_res: Column) -> Column:
    """The class of a building by its registration and its lot; the first that holds."""
    some = F.coalesce(units_res > 0, F.lit(False))
    return (
        F.when(unexpired & some, "hpd_unexpired_pluto_residential")
        .when(unexpired, "hpd_unexpired_no_positive_pluto_count")
        .when(registered & some, "hpd_expired_pluto_residential")
        .when(some, "pluto_residential_not_hpd_unexpired")
        .otherwise("hpd_only_no_pluto_lot")
    )


def claim_counts(unit_claims: DataFrame) -> DataFrame:
    """By building: resolved claims, and the distinct units that official sources name."""
    return unit_claims.groupBy("bbl").agg(F.count(F.lit(1)).alias("unit_claims"), F.count_distinct(F.when(F.col("grade") == "source_document", F.col("unit_id"))).alias("official_units"))


def registration_coverage(registrations: DataFrame, buildings: DataFrame, unit_claims: DataFrame) -> DataFrame:
    """Every building that is registered or residential, with its class and unit counts.

    ``registrations``: bbl, timing; ``unit_claims``: bbl, unit_id, grade, a row for each resolved claim (so a unit with several claims counts as often in ``unit_claims``, once in ``distinct_units``).
    """
    hpd = registrations.groupBy("bbl").agg(F.bool_or(F.col("timing") == "unexpired").alias("unexpired"), F.count(F.lit(1)).alias("registrations"))
    lots = buildings.where("units_res > 0").select("bbl", "units_res")
    counts = claim_counts(unit_claims)
    bbls = hpd.select("bbl").union(lots.select("bbl")).distinct()
    d = bbls.join(hpd, "bbl", "left").join(lots, "bbl", "left").join(counts, "bbl", "left")
    no = F.lit(False)
    return d.select("bbl", membership(F.coalesce("unexpired", no), F.col("registrations").isNotNull(), F.col("units_res")).alias("membership_status"), "units_res", F.coalesce("unit_claims", F.lit(0)).alias("unit_claims"), F.coalesce("official_units", F.lit(0)).alias("official_units"))


def distribution(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), key)


def catalog_status(**tables: DataFrame) -> DataFrame:
    """metric, n: the rows of each table."""
    return reduce(DataFrame.union, [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("metric"), "n") for name, df in tables.items()])


def optional_count(spark: SparkSession, table: str) -> int | None:
    """None where the table doesn't exist."""
    return spark.table(table).count() if spark.catalog.tableExists(table) else None


def all_distributions(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """key, value and n of each of ``keys``, and the number of rows (a null key), by one scan: grouping sets."""
    sets = df.select(*keys).groupingSets([[k] for k in keys] + [[]], *keys).agg(F.count(F.lit(1)).alias("n"), *[F.grouping(k).alias(f"__g{i}") for i, k in enumerate(keys)])
    here = lambda i: F.col(f"__g{i}") == 0
    return sets.select(F.coalesce(*[F.when(here(i), F.lit(k)) for i, k in enumerate(keys)]).alias("key"), F.coalesce(*[F.when(here(i), F.col(k).cast("string")) for i, k in enumerate(keys)]).alias("value"), "n")


def store_run(snapshot: DataFrame, path: str, run: str) -> None:
    """A snapshot as a partition of its own: what was stored stays, a second snapshot of a run is refused."""
    if not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9._-]*", run):
        raise ValueError(f"not a name for a run: {run!r}")
    snapshot.write.mode("errorifexists").parquet(f"{path.rstrip('/')}/run={run}")


def stored_run(spark: SparkSession, path: str, run: str) -> DataFrame:
    return spark.read.parquet(f"{path.rstrip('/')}/run={run}")


def run_difference(before: DataFrame, after: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """key, change (entered, left or changed) and the columns before and after: what differs between two runs."""
    side = lambda d, s: d.select(key, F.lit(True).alias(f"__{s}"), *[F.col(c).alias(f"{c}_{s}") for c in columns])
    both = side(before, "before").join(side(after, "after"), key, "full_outer")
    same = reduce(lambda a, b: a & b, [F.col(f"{c}_before").eqNullSafe(F.col(f"{c}_after")) for c in columns])
    change = F.when(F.col("__before").isNull(), "entered").when(F.col("__after").isNull(), "left").when(~same, "changed")
    return both.select(key, change.alias("change"), *[f"{c}_{s}" for c in columns for s in ("before", "after")]).where("change IS NOT NULL")


def newly_resolved(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The distinct keys that a second pass resolves and the first didn't: what the two sets of hits differ by."""
    return after.select(*keys).distinct().join(before.select(*keys).distinct(), [*keys], "left_anti")
