"""Growth of the catalog from archives: extract, route, merge."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotline.functions import ids
from lotline.functions.text import normalize_designation, normalize_unit, source_label, with_address
from lotline.operators.resolve import by_designation, by_residence, keyed_by, zip_or_all

COLUMNS = ["source", "address", "unit", "zip", "source_ref"]
SYNTHETIC = '["PLUTO_INFERRED"]'


def extract_all(*sources: tuple[str, DataFrame, dict[str, Column]]) -> DataFrame:
    """(name, rows, column rules) of each archive in one shape; nothing is deduplicated."""
    shaped = [df.select(F.lit(name).alias("source"), *[rules[k].cast("string").alias(k) for k in COLUMNS[1:]]) for name, df, rules in sources]
    return reduce(DataFrame.unionByName, shaped)


def route(rows: DataFrame, addresses: DataFrame, lots: DataFrame) -> DataFrame:
    """Every raw row with route (units, ambiguous, unresolved or no_unit), bbl, resolved_via, reason and candidate_bbls."""
    d = with_address(keyed_by(rows, COLUMNS), F.col("address")).withColumn("unit_normalized", normalize_unit(F.col("unit")))
    d = zip_or_all(d, addresses, "norm_address", "zip")
    tie = by_designation(d.where(F.size("bbls") > 1), lots, "row_id", "unit_normalized").withColumnRenamed("bbl", "__tie")
    d = d.join(tie, "row_id", "left")
    n = F.size("bbls")
    blank, no_address = F.col("unit_normalized") == "", F.col("norm_address") == ""
    sure = n == 1
    route_ = F.when(blank, "no_unit").when(no_address | (n == 0), "unresolved").when(sure | F.col("__tie").isNotNull(), "units").otherwise("ambiguous")
    return d.select(
        *COLUMNS, "unit_normalized", route_.alias("route"),
        F.when(route_ == "units", F.when(sure, F.get("bbls", F.lit(0))).otherwise(F.col("__tie"))).alias("bbl"),
        F.when(route_ == "units", F.when(sure, "address+zip").otherwise("condo_unit_designation")).alias("resolved_via"),
        F.when(route_ == "unresolved", F.when(no_address, "address did not normalize").otherwise("no official BBL match")).alias("reason"),
        F.when(route_ == "ambiguous", F.array_join("bbls", ",")).alias("candidate_bbls"),
    )


def _unit_rows(d: DataFrame, now: str, confidence: float, method: Column) -> DataFrame:
    """Units and their claims; ids don't hold the time, so a repeated run yields the same ids."""
    return d.select(ids.merge_id("unit", F.col("bbl"), F.col("unit_normalized")).alias("unit_id"), "bbl", F.col("unit_label"), "unit_normalized", ids.merge_id("obs", F.col("source"), F.col("source_ref"), F.col("bbl"), F.col("unit_normalized")).alias("observation_id"), "source", "source_ref", F.lit(confidence).alias("confidence"), method.alias("method"), F.lit(now).alias("observed_at")).dropDuplicates(["observation_id"])


def classified(units: DataFrame, archive: DataFrame) -> DataFrame:
    """Units with the class of their archive row; inferred rows and rows that the archive lacks are left out."""
    a = archive.select(F.col("unit_id").alias("source_ref"), F.col("source_systems").alias("__systems")).where(F.col("__systems") != SYNTHETIC)
    return units.join(a, "source_ref").withColumn("source", source_label(F.col("__systems"))).drop("__systems")


def merge_known(routed: DataFrame, archive: DataFrame, archive_source: str, now: str) -> DataFrame:
    u = routed.where("route = 'units'").withColumn("unit_label", F.col("unit"))
    own = classified(u.where(F.col("source") == archive_source), archive)
    return _unit_rows(u.where(F.col("source") != archive_source).unionByName(own, allowMissingColumns=True), now, 1.0, F.col("resolved_via"))


def merge_single_family(buildings: DataFrame, units: DataFrame, now: str) -> DataFrame:
    """Buildings of one home without a named unit: the whole building is the unit."""
    d = buildings.where("units_res = 1").where(F.trim("primary_address") != "").join(units.select("bbl").distinct(), "bbl", "left_anti")
    d = d.withColumns({"unit_label": F.lit("(whole building)"), "unit_normalized": F.lit("WHOLEBLDG"), "source": F.lit("single_family"), "source_ref": F.col("bbl")})
    return _unit_rows(d, now, 1.0, F.lit("derived_inference"))


def merge_tiebreak(routed: DataFrame, buildings: DataFrame, now: str) -> DataFrame:
    """Ambiguous rows of which exactly one candidate has homes."""
    a = keyed_by(routed.where("route = 'ambiguous'").drop("bbl"), [*COLUMNS, "candidate_bbls"]).withColumn("bbls", F.split("candidate_bbls", ","))
    d = a.join(by_residence(a, buildings, "row_id"), "row_id").withColumn("source", F.concat("source", F.lit("_tradable_tiebreak"))).withColumn("unit_label", F.col("unit"))
    return _unit_rows(d, now, 0.9, F.lit("residential_tiebreak"))


def merge_condo_lots(lots: DataFrame, units: DataFrame, now: str) -> DataFrame:
    """Unit lots with a designation and no named unit; the lot's own number is the building number."""
    d = lots.where(F.trim("unit_designation") != "").withColumn("bbl", F.col("unit_lot_bbl")).join(units.select("bbl").distinct(), "bbl", "left_anti")
    d = d.withColumns({"unit_label": F.col("unit_designation"), "unit_normalized": normalize_designation(F.col("unit_designation")), "source": F.lit("condo_unit_lots"), "source_ref": F.col("unit_lot_bbl")})
    return _unit_rows(d, now, 1.0, F.lit("official_condo_unit_lot"))


def run(archives: list, addresses: DataFrame, lots: DataFrame, buildings: DataFrame, units: DataFrame, archive: DataFrame, archive_source: str, now: str) -> dict[str, DataFrame]:
    """The steps in their order; an error ends the run."""
    routed = route(extract_all(*archives), addresses, lots)
    known = merge_known(routed, archive, archive_source, now)
    single = merge_single_family(buildings, units.select("bbl").union(known.select("bbl")), now)
    tie = merge_tiebreak(routed, buildings, now)
    condo = merge_condo_lots(lots, units.select("bbl").union(known.select("bbl")).union(single.select("bbl")).union(tie.select("bbl")), now)
    return {"routed": routed, "known": known, "single_family": single, "tiebreak": tie, "condo_lots": condo}
