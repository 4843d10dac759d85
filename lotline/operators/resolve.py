"""From addresses to buildings: crosswalks, candidates and the policy that prefers no match to a wrong one."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotline.functions import ids
from lotline.functions.text import filled, normalize_designation, strip, with_address
from lotline.operators.keys import first_wins, insert_new

#: House-number ranges wider than this are dirt.
WIDEST = 3000


def house_numbers(low: Column, high: Column, parity: Column) -> Column:
    """The numbers of a range as an array of text: every other one where the parity and both ends agree; what isn't a range is its low end."""
    lo, hi = strip(F.coalesce(low, F.lit(""))), strip(F.coalesce(high, F.lit("")))
    plain = lo.rlike(r"^\d+$") & hi.rlike(r"^\d+$") & (hi != lo)
    a, b = lo.try_cast("long"), hi.try_cast("long")
    step = F.when(parity.isin("O", "E") & (a % 2 == b % 2), 2).otherwise(1).cast("long")
    walked = F.transform(F.sequence(a, b, step), lambda x: x.cast("string"))
    return F.when(lo == "", F.array().cast("array<string>")).when(F.coalesce(plain & (b >= a) & (b - a <= WIDEST), F.lit(False)), walked).otherwise(F.array(lo))


def crosswalk_from_lots(lots: DataFrame, arrival: str = "arrival") -> DataFrame:
    """norm_address, bbl, borough, zipcode of lots (bbl as the feed writes it); the first row of a pair stays."""
    d = with_address(lots, F.col("address")).select("norm_address", ids.float_bbl(F.col("bbl")).alias("bbl"), "borough", "zipcode", arrival)
    return first_wins(d.where((F.col("norm_address") != "") & F.col("bbl").isNotNull()), ["norm_address", "bbl"], arrival).drop(arrival)


def crosswalk_from_ranges(rows: DataFrame, existing: DataFrame, zips: Sequence[str] | None = None, limit: int | None = None, arrival: str = "arrival") -> DataFrame:
    """The pairs that an address file adds: real and vanity addresses (type '' or V), a row for each house number of a range. ``limit`` counts added pairs."""
    d = rows.where(F.col("zipcode").isin(*zips)) if zips else rows
    d = d.where(F.coalesce(strip(F.col("addrtype")), F.lit("")).isin("", "V"))
    d = d.withColumn("bbl", ids.file_bbl(F.col("boro"), F.col("block"), F.col("lot"))).where(F.col("bbl").isNotNull())
    d = d.withColumn("number", F.explode(house_numbers(F.col("lhnd"), F.col("hhnd"), F.col("parity"))))
    borough = F.create_map(*[F.lit(x) for code, _, name in ids.BOROUGHS for x in (str(code), name)])[strip(F.col("boro"))]
    d = with_address(d, F.concat_ws(" ", "number", strip(F.col("stname")))).select("norm_address", "bbl", borough.alias("borough"), filled(strip(F.col("zipcode"))).alias("zipcode"), arrival)
    new = insert_new(existing, first_wins(d.where("norm_address <> ''"), ["norm_address", "bbl"], arrival), ["norm_address", "bbl"])
    return new.orderBy(arrival, "norm_address").limit(limit).drop(arrival) if limit is not None else new.drop(arrival)


def first_bbl(rows: DataFrame, crosswalk: DataFrame, address: str = "norm_address", zipcode: str = "zipcode") -> DataFrame:
    """``rows`` with bbl: of the same address and zip, else of the same address; the least of several. The crosswalk is one row an address by then, so rows never multiply."""
    c = crosswalk.where(F.col("norm_address") != "")
    by_zip = c.groupBy(F.col("norm_address").alias("__a"), F.col("zipcode").alias("__z")).agg(F.min("bbl").alias("__b"))
    entries = F.collect_list(F.when(F.col("__z").isNotNull(), F.struct("__z", "__b")))
    by_address = by_zip.groupBy("__a").agg(F.map_from_entries(entries).alias("__by_zip"), F.min("__b").alias("__least"))
    d = rows.join(by_address, F.col(address) == F.col("__a"), "left")
    return d.withColumn("bbl", F.coalesce(F.col("__by_zip")[F.col(zipcode)], "__least")).drop("__a", "__by_zip", "__least")


def _indexed(rows: DataFrame, addresses: DataFrame, address: str, zipcode: Column) -> DataFrame:
    """``rows`` with __zips: the address's buildings by zip, gathered before the join, so that a lookup meets one row and not each building."""
    sets = addresses.where(F.col("normalized") != "").groupBy(F.col("normalized").alias("__a"), zipcode.alias("__z")).agg(F.collect_set("bbl").alias("__set"))
    return rows.join(sets.groupBy("__a").agg(F.collect_list(F.struct("__z", "__set")).alias("__zips")), F.col(address) == F.col("__a"), "left")


def _buildings(zips: Column) -> Column:
    return F.coalesce(F.array_sort(F.array_distinct(F.flatten(F.transform(zips, lambda z: z["__set"])))), F.array().cast("array<string>"))


def _agreeing(zipcode: Column) -> Column:
    return F.filter("__zips", lambda z: zipcode.isNull() | z["__z"].isNull() | (z["__z"] == zipcode))


def candidates(rows: DataFrame, addresses: DataFrame, address: str = "norm_address", zipcode: str = "zipcode") -> DataFrame:
    """``rows`` with bbls, the sorted distinct buildings of the address: zips agree, or either side has none ('' is a zip of its own)."""
    d = _indexed(rows, addresses, address, F.col("zipcode"))
    return d.withColumn("bbls", _buildings(_agreeing(F.col(zipcode)))).drop("__a", "__zips")


def status_of(bbls: Column, address: Column) -> Column:
    """struct(bbl, status, confidence, method, rationale) by the number of candidates."""
    n = F.size(bbls)
    return F.struct(
        F.when(n == 1, F.get(bbls, F.lit(0))).alias("bbl"),
        F.when(n == 1, "resolved").when(n > 1, "ambiguous").otherwise("unresolved").alias("status"),
        F.when(n == 1, 1.0).otherwise(0.0).alias("confidence"),
        F.lit("normalized_address").alias("method"),
        F.when(F.coalesce(address, F.lit("")) == "", "the address has no house number and street").when(n == 0, "no building has the address").when(n == 1, "one building has the address").otherwise("several buildings have the address").alias("rationale"),
    )


def candidate_rows(resolved: DataFrame, row_id: str, entity: str = "building") -> DataFrame:
    """A row for each candidate where there are two or more."""
    return resolved.where(F.size("bbls") > 1).select(F.col(row_id).alias("observation_id"), F.lit(entity).alias("entity_type"), F.explode("bbls").alias("candidate_id"))


def zip_or_all(rows: DataFrame, addresses: DataFrame, address: str = "norm_address", zipcode: str = "zipcode") -> DataFrame:
    """As ``candidates``, but if no candidate's zip agrees all of them stay. A blank zip on either side agrees."""
    d = _indexed(rows, addresses, address, filled(F.col("zipcode")))
    near = _agreeing(filled(F.col(zipcode)))
    return d.withColumn("bbls", _buildings(F.when(F.size(near) > 0, near).otherwise(F.col("__zips")))).drop("__a", "__zips")


def keyed_by(rows: DataFrame, columns: Sequence[str], out: str = "row_id") -> DataFrame:
    """``rows`` with a key made of their content: rows that are alike share it, and share what is found for it."""
    return rows.withColumn(out, F.sha2(F.to_json(F.struct(*columns)), 256))


def by_designation(rows: DataFrame, lots: DataFrame, row_id: str, unit: str) -> DataFrame:
    """row_id, bbl where exactly one candidate is a lot with the unit's designation."""
    d = lots.select(F.col("unit_lot_bbl").alias("bbl"), normalize_designation(F.col("unit_designation")).alias("__d"))
    c = rows.dropDuplicates([row_id]).select(row_id, unit, F.explode("bbls").alias("bbl")).join(d, "bbl").where(F.col("__d") == F.col(unit))
    return c.groupBy(row_id).agg(F.count(F.lit(1)).alias("__n"), F.min("bbl").alias("bbl")).where("__n = 1").drop("__n")


def by_residence(rows: DataFrame, buildings: DataFrame, row_id: str) -> DataFrame:
    """row_id, bbl where exactly one candidate has residential units."""
    c = rows.dropDuplicates([row_id]).select(row_id, F.explode("bbls").alias("bbl")).join(buildings.where("units_res > 0").select("bbl").distinct(), "bbl")
    return c.groupBy(row_id).agg(F.count(F.lit(1)).alias("__n"), F.min("bbl").alias("bbl")).where("__n = 1").drop("__n")


def missing_buildings(wanted: DataFrame, buildings: DataFrame) -> DataFrame:
    """BBLs that the buildings table lacks, for a scoped read."""
    return wanted.select("bbl").distinct().join(buildings.select("bbl"), "bbl", "left_anti")
