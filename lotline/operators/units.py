"""One canonical ad for each physical unit, and the duplicates behind it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotline.functions import ids
from lotline.functions.dates import seen_seconds
from lotline.functions.text import group_key, unit_key

# What a listing has, and which sources resell other sources' ads.
LISTING_FIELDS = ["source_id", "building_name", "address", "unit_number", "bedrooms", "bathrooms", "price", "sqft", "available_date", "lease_terms", "amenities", "description", "floor_plan_url", "image_urls", "latitude", "longitude", "neighborhood", "borough", "zipcode", "is_flex", "is_rent_stabilized", "finish_level", "raw_json"]
MARKETPLACES = ["nooklyn"]


def completeness(columns: Sequence[str]) -> Column:
    """How many columns are neither null nor '' nor an empty list; 0 counts."""
    return sum((F.when(F.col(c).isNotNull() & ~F.col(c).cast("string").isin("", "[]"), 1).otherwise(0) for c in columns), F.lit(0))


def _order(fields: Sequence[str], marketplaces: Sequence[str]) -> Column:
    return F.struct(F.col("source").isin(*marketplaces).cast("int").alias("resold"), (-completeness(fields)).alias("empty"), (-seen_seconds(F.col("last_seen"))).alias("unseen"), F.coalesce("source", F.lit("")).alias("source"), F.coalesce("source_id", F.lit("")).alias("source_id"))


def keyed(listings: DataFrame, only_active: bool = True) -> DataFrame:
    """Listings with unit_key and unit_id: the unit's, or the row's own where it names no unit."""
    d = listings.where("status = 'active'") if only_active else listings
    own = F.struct(group_key(unit_key(F.col("address"), F.col("unit_number"), F.col("bedrooms")), F.col("source"), F.col("source_id")).alias("unit_key"))
    d = d.drop("unit_key").select("*", F.inline_outer(F.array(own)))  # a column that no later step is merged with, so that it is made once a row
    return d.withColumn("unit_id", ids.unit_id(F.col("unit_key")))


def build_units(listings: DataFrame, only_active: bool = True, fields: Sequence[str] = LISTING_FIELDS, marketplaces: Sequence[str] = MARKETPLACES) -> DataFrame:
    """Every listing with unit_key, unit_id, cluster_size and is_canonical; (source, source_id) is a key.

    Of a unit's rows the canonical one comes from a direct feed before a marketplace, then has more fields filled, was seen later, and sorts first by source and id. The winner is an aggregate that is joined back, so a unit with very many ads needs no task of its own.
    """
    d = keyed(listings, only_active)
    order = _order([f for f in fields if f in d.columns], marketplaces)
    best = d.groupBy("unit_key").agg(F.min(order).alias("__best"), F.count(F.lit(1)).alias("cluster_size"))
    return d.join(best, "unit_key").withColumn("is_canonical", (order == F.col("__best")).cast("int")).drop("__best")


def canonical_rows(listings: DataFrame, columns: Sequence[str], only_active: bool = True, fields: Sequence[str] = LISTING_FIELDS, marketplaces: Sequence[str] = MARKETPLACES) -> DataFrame:
    """The canonical rows alone, with cluster_size: one aggregation, combined before the shuffle."""
    d = keyed(listings, only_active)
    order = _order([f for f in fields if f in d.columns], marketplaces)
    best = d.groupBy("unit_key").agg(F.min_by(F.struct(*columns), order).alias("__row"), F.count(F.lit(1)).alias("cluster_size"))
    return best.select(ids.unit_id(F.col("unit_key")).alias("unit_id"), "__row.*", "cluster_size")


def unit_stats(units: DataFrame) -> DataFrame:
    return units.agg(F.count(F.lit(1)).alias("raw_listings"), F.sum("is_canonical").alias("distinct_units"), F.count_if((F.col("is_canonical") == 1) & (F.col("cluster_size") > 1)).alias("duplicate_clusters"))


def canonical_listings(units: DataFrame) -> DataFrame:
    return units.where("is_canonical = 1")


def find_duplicates(units: DataFrame, cross_source_only: bool = True) -> DataFrame:
    """Units with two ads or more (from two sources or more), the largest first. Members are collected for these units only."""
    sizes = units.groupBy("unit_id").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("source").alias("sources")).where("n >= 2")
    if cross_source_only:
        sizes = sizes.where("sources >= 2")
    members = units.join(sizes, "unit_id").groupBy("unit_id", "n", "sources").agg(F.array_sort(F.collect_list(F.struct("source", "source_id", "is_canonical"))).alias("members"))
    return members.orderBy(F.desc("n"), "unit_id")
