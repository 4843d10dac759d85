"""Buildings clustered by their owners' office."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotline.functions import ids
from lotline.functions.text import cluster_key, filled
from lotline.operators.keys import most_frequent

# The counts that are summed, and the names of the sums.
TOTALS = {"violations": "total_violations", "evictions": "total_evictions", "complaints": "total_complaints", "dob_complaints": "total_dob_complaints", "litigations": "total_litigations", "sr311": "total_sr311", "sr311_open": "total_sr311_open", "permits": "total_permits", "sales": "total_sales", "cofos": "total_cofos"}
UNKNOWN = "(unknown owner)"


def clustered(buildings: DataFrame) -> DataFrame:
    d = buildings.where(F.col("owner_name").isNotNull() | F.col("owner_business_address").isNotNull())
    return d.withColumn("cluster", cluster_key(F.col("bbl"), F.col("owner_business_address"))).withColumn("portfolio_id", ids.portfolio_id(F.col("cluster")))


def build_portfolios(buildings: DataFrame, position: str = "position") -> tuple[DataFrame, DataFrame]:
    """(portfolios, bbl -> portfolio_id). ``position`` is the order in which rows count as first."""
    d = clustered(buildings)
    sums = d.groupBy("portfolio_id").agg(
        F.count(F.lit(1)).alias("building_count"),
        F.count_distinct(filled(F.col("owner_name"))).alias("llc_count"),
        F.min_by("owner_business_address", F.when(filled(F.col("owner_business_address")).isNotNull(), F.col(position))).alias("business_address"),
        *[F.sum(F.coalesce(c, F.lit(0))).cast("long").alias(t) for c, t in TOTALS.items() if c in d.columns],
    )
    names = most_frequent(d, ["portfolio_id"], "owner_name", position, "canonical_name")
    out = sums.join(names, "portfolio_id", "left").withColumn("canonical_name", F.coalesce("canonical_name", F.lit(UNKNOWN)))
    return out, d.select("bbl", "portfolio_id")


def largest(portfolios: DataFrame, top: int) -> DataFrame:
    return portfolios.where("building_count > 1").orderBy(F.desc("building_count"), "portfolio_id").limit(top)
