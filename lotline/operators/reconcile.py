"""Ambiguous listings settled by official unit evidence."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotline.functions.text import normalize_unit, with_address
from lotline.operators.importers import not_a_dwelling

# Fixed value: what an edge says of the evidence.
ROLE = "corroborates_candidate"


def corroborate(listings: DataFrame, evidence: DataFrame) -> DataFrame:
    """Ambiguous listings (observation_id, address, unit_label, bbls) with outcome, bbl, unit_id, confidence and rationale.

    ``evidence``: observation_id, source_ref, address, bbl, unit_id, normalized_unit of resolved official violations. A listing is settled if the same unit and the same address are found on exactly one candidate building and as exactly one unit. Evidence is gathered to one row for each building, unit and address before the join, so a unit with many violations doesn't multiply the listings that ask for it; its references are fetched for settled listings only.
    """
    d = with_address(listings, F.col("address")).withColumn("normalized_unit", normalize_unit(F.col("unit_label")))
    usable = (F.col("norm_address") != "") & (F.col("normalized_unit") != "") & ~not_a_dwelling(F.col("unit_label"))
    d = d.withColumn("usable", usable)
    asked = d.where("usable").select("observation_id", "norm_address", "normalized_unit", F.explode("bbls").alias("bbl"))
    e = with_address(evidence, F.col("address")).select("bbl", "normalized_unit", "norm_address", "unit_id", "source_ref", F.col("observation_id").alias("evidence_id"))
    place = ["bbl", "normalized_unit", "norm_address"]
    ids = e.groupBy(*place).agg(F.collect_set("unit_id").alias("ids"))
    found = asked.join(ids, place).groupBy("observation_id").agg(F.collect_set("bbl").alias("found"), F.array_distinct(F.flatten(F.collect_list("ids"))).alias("unit_ids"), F.min(F.struct(*place)).alias("place"))
    # a settled listing has one place
    refs = e.groupBy(F.struct(*place).alias("place")).agg(F.array_sort(F.collect_set("source_ref")).alias("refs"), F.array_sort(F.collect_set("evidence_id")).alias("evidence"))
    settled = found.where((F.size("found") == 1) & (F.size("unit_ids") == 1))
    hit = settled.join(refs, "place").select("observation_id", "found", "unit_ids", "refs", "evidence")
    one = (F.size("found") == 1) & (F.size("unit_ids") == 1)
    out = d.join(hit, "observation_id", "left").withColumn("one", F.coalesce(one, F.lit(False)))
    return out.select(
        "observation_id",
        F.when(~F.col("usable"), "skipped").when(F.col("one"), "resolved").otherwise("ambiguous").alias("outcome"),
        F.when(F.col("one"), F.get("found", F.lit(0))).alias("bbl"),
        F.when(F.col("one"), F.get("unit_ids", F.lit(0))).alias("unit_id"),
        F.when(F.col("one"), 0.98).otherwise(0.0).alias("confidence"),
        F.when(F.col("one"), F.concat(F.lit("official unit evidence: "), F.array_join("refs", ", "))).alias("rationale"),
        F.when(F.col("one"), F.col("evidence")).otherwise(F.array().cast("array<string>")).alias("evidence"),
    )


def evidence_edges(settled: DataFrame) -> DataFrame:
    """Two edges (building and unit) for each piece of evidence."""
    e = settled.where("outcome = 'resolved'").select("observation_id", F.explode("evidence").alias("evidence_observation_id"))
    return e.select("observation_id", F.explode(F.array(F.lit("building"), F.lit("unit"))).alias("entity_type"), "evidence_observation_id", F.lit(ROLE).alias("role"))
