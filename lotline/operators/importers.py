"""One importer for all catalog sources, driven by a table of their rules.

A row becomes a document, one observation (or one for each unit label) and two claims: which building it is about and which unit. The ladder for the unit: no building -> unresolved; a label that isn't a dwelling -> not_a_dwelling; a blank label -> unresolved (not_a_dwelling for some archives); else resolved.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotline.functions import ids
from lotline.functions.dates import iso_date
from lotline.functions.text import NOT_DWELLINGS_EXTRA_ARCHIVE, NOT_DWELLINGS_EXTRA_FILINGS, filled, first_date, first_filled, join_labels, normalize_unit, sale_address, split_labels, split_mls_address, street_address, strip, with_address
from lotline.operators.resolve import candidates, status_of
from lotline.operators.upsert import with_columns_of

# Labels of places that aren't homes.
NOT_DWELLINGS = ["BASEMENT", "CELLAR", "ROOF", "PUBLIC HALL", "PUBLIC AREA", "HALLWAY", "STAIRWAY", "STAIRWELL", "ELEVATOR", "ENTIRE BUILDING", "BUILDING WIDE", "BLDG", "BUILDING", "MEDICAL", "COMMERCIAL", "RETAIL", "OFFICE", "PARKING", "STORAGE", "RESIDENTIAL"]

_named: list[str] | None = None


def c(name: str) -> Column:
    """A column; while a source's rules are asked what they read, its name is kept."""
    if _named is not None:
        _named.append(name)
    return F.col(name)


@dataclass(frozen=True)
class Source:
    """Rules of a source. Column rules are functions, so that no session is needed to define them."""

    name: str
    kind: str
    ref: Callable[[], Column]
    observed: Callable[[], Column]
    label: Callable[[], Column]
    address: Callable[[], Column] = lambda: F.lit(None).cast("string")
    zipcode: Callable[[], Column] = lambda: F.lit(None).cast("string")
    bbl: Callable[[], Column] | None = None  # None: by address
    status: Callable[[], Column] = lambda: F.lit(None).cast("string")
    price: Callable[[], Column] = lambda: F.lit(None).cast("double")
    grade: str = "source_document"
    payload_kind: str = "nyc_open_data_row"
    needs_date: bool = False
    needs_bbl: bool = False
    by_address_too: bool = False  # a building by address where the row has no BBL; the unit stays unresolved
    blank_is_no_dwelling: bool = False
    many_labels: bool = False
    building_confidence: float = 1.0
    unit_confidence: float = 1.0
    extra_labels: Sequence[str] = field(default_factory=tuple)
    floor_is_no_dwelling: bool = False
    where: Callable[[], Column] | None = None
    mined: Callable[[], Column] | None = None
    fields: Sequence[str] = ()  # what the payload may hold; () for all


def _bbl(borough: str, own: str | None = None) -> Callable[[], Column]:
    """A feed's own BBL, else one from numeric parts."""
    parts = lambda: ids.assembled_bbl(c(borough), c("block"), c("lot"))
    return parts if own is None else lambda: F.coalesce(ids.catalog_bbl(c(own)), parts())


def _sales(name: str, own: Callable[[], Column]) -> Source:
    """Sales sheets have no id of their own: the row's facts make one."""
    bbl = lambda: F.coalesce(ids.catalog_bbl(own()), ids.assembled_bbl(c("borough"), c("block"), c("lot")))
    ref = lambda: ids.catalog_id("sale", bbl(), iso_date(c("sale_date")), c("address"), c("apartment_number"), c("sale_price"))
    return Source(name, "official_sale", ref, lambda: iso_date(c("sale_date")), lambda: c("apartment_number"), lambda: sale_address(c("address"), c("apartment_number")), lambda: c("zip_code"), bbl, lambda: c("building_class_category"), lambda: c("sale_price").try_cast("double"), needs_date=True)


SOURCES = {
    s.name: s
    for s in (
        Source("hpd_violations", "official_unit_mention", lambda: c("violationid"), lambda: iso_date(first_date(c("novissueddate"), c("inspectiondate"))), lambda: c("apartment"), lambda: street_address(c("housenumber"), c("streetname")), lambda: c("zip"), _bbl("boroid"), lambda: c("violationstatus")),
        Source("hpd_problems", "official_unit_mention", lambda: c("problem_id"), lambda: iso_date(c("received_date")), lambda: c("apartment"), lambda: street_address(c("house_number"), c("street_name")), lambda: F.lit(None).cast("string"), _bbl("borough", "bbl"), lambda: c("problem_status"), needs_date=True, needs_bbl=True),
        Source("nycha_hmc_violations", "official_nycha_hmc_violation", lambda: c("viol_seq_no"), lambda: iso_date(first_date(c("insp_dt"), c("viol_appr_dt"))), lambda: c("actl_unit_insp"), lambda: street_address(c("phn"), c("str_nm")), lambda: F.lit(None).cast("string"), _bbl("boro", "bbl"), lambda: c("hzrd_clas"), needs_date=True, needs_bbl=True, where=lambda: c("issued_in_err") == "N"),
        Source("ose_str_snapshot", "str_registration_listing", lambda: first_filled(c("listing_id"), c("registration_id"), F.concat(F.lit("row-"), c("row_no"))), lambda: c("snapshot_date"), lambda: c("unit"), lambda: c("address"), lambda: F.coalesce(c("zipcode"), F.lit("")), payload_kind="xlsx_row"),
        Source("hpd_omo_work_orders", "official_unit_mention", lambda: c("omoid"), lambda: iso_date(first_date(c("omocreatedate"), c("omoawarddate"))), lambda: c("apartment"), lambda: street_address(c("housenumber"), c("streetname")), lambda: c("zip"), _bbl("boroid", "bbl"), lambda: c("omostatusreason")),
        Source("acris_property_legals", "official_unit_mention", lambda: F.concat_ws(":", c("document_id"), ids.assembled_bbl(c("borough"), c("block"), c("lot")), ids.catalog_id("row", c("payload"))), lambda: iso_date(c("good_through_date")), lambda: c("unit"), lambda: street_address(c("street_number"), c("street_name")), lambda: F.lit(None).cast("string"), _bbl("borough"), lambda: c("property_type"), needs_bbl=True),
        Source("archive_all_units", "archived_unit_mention", lambda: c("unit_id"), lambda: iso_date(c("snapshot_at")), lambda: c("unit_number"), lambda: c("address"), lambda: c("zipcode"), lambda: ids.catalog_bbl(c("bbl")), grade="archived_secondary_source", payload_kind="archive_row", needs_bbl=True, building_confidence=0.9, unit_confidence=0.8, extra_labels=NOT_DWELLINGS_EXTRA_ARCHIVE, where=lambda: F.coalesce(c("is_placeholder").try_cast("int"), F.lit(0)) == 0, mined=lambda: F.upper(c("source_systems")).contains("TEXT_MINED")),
        Source("archive_unit_summary", "archived_listing_history", lambda: c("id"), lambda: iso_date(first_date(c("date"), c("scraped_at"), c("snapshot_at"))), lambda: c("unit"), lambda: c("address"), lambda: F.lit(None).cast("string"), status=lambda: c("status"), price=lambda: c("price_numeric").try_cast("double"), grade="archived_secondary_source", payload_kind="archive_row", blank_is_no_dwelling=True, building_confidence=0.8, unit_confidence=0.8),
        Source("archive_mls_listings", "archived_listing_history", lambda: c("core_listing_id"), lambda: iso_date(first_date(c("close_date"), c("list_date"), c("update_date"), c("fetched_at"), c("snapshot_at"))), lambda: split_mls_address(c("address"), c("unit"))["unit"], lambda: split_mls_address(c("address"), c("unit"))["street"], lambda: filled(c("zip")), status=lambda: c("listing_status"), price=lambda: F.coalesce(c("close_price").try_cast("double"), c("list_price").try_cast("double")), grade="archived_secondary_source", payload_kind="archive_row", blank_is_no_dwelling=True, building_confidence=0.8, unit_confidence=0.8, fields=("core_listing_id", "address", "unit", "zip", "listing_status", "listing_type", "home_type", "ownership_type", "list_price", "close_price", "list_date", "close_date", "update_date", "bedrooms", "bathrooms_total", "living_area_sqft", "year_built", "building_name", "source_mls", "fetched_at")),
        Source("archive_broker_listings", "archived_listing_history", lambda: c("listing_id"), lambda: iso_date(first_date(c("closed_rented_date"), c("fetched_at"), c("snapshot_at"))), lambda: split_mls_address(c("address1"), c("address2"))["unit"], lambda: split_mls_address(c("address1"), c("address2"))["street"], lambda: filled(c("zip_code")), status=lambda: c("listing_status"), price=lambda: c("price").try_cast("double"), grade="archived_secondary_source", payload_kind="archive_row", blank_is_no_dwelling=True, building_confidence=0.8, unit_confidence=0.8, fields=("listing_id", "property_id", "source_id", "listing_status", "transaction_type", "listing_type", "building_type", "property_type", "ownership", "unit_type", "address1", "address2", "zip_code", "borough", "neighborhood", "price", "bedrooms", "bathrooms", "total_bathrooms", "square_footage", "closed_rented_date", "fetched_at")),
        _sales("annualized_sales", lambda: c("bbl")),
        _sales("rolling_sales", lambda: F.lit(None).cast("string")),
        Source("nyc_evictions", "official_eviction_event", lambda: ids.catalog_id("eviction", c("payload")), lambda: iso_date(c("executed_date")), lambda: c("eviction_apt_num"), lambda: c("eviction_address"), lambda: c("eviction_zip"), lambda: ids.catalog_bbl(c("bbl")), lambda: join_labels(c("eviction_possession"), c("ejectment")), payload_kind="nyc_open_data_row_redacted", needs_date=True, by_address_too=True, floor_is_no_dwelling=True, where=lambda: c("residential_commercial_ind") == "Residential", fields=("court_index_number", "docket_number", "eviction_address", "eviction_apt_num", "executed_date", "residential_commercial_ind", "borough", "eviction_zip", "eviction_possession", "ejectment", "bbl")),
        Source("dob_now_job_filings", "official_job_filing", lambda: c("job_filing_number"), lambda: iso_date(first_date(c("filing_date"), c("current_status_date"))), lambda: c("apt_condo_no_s"), lambda: street_address(c("house_no"), c("street_name")), lambda: c("postcode"), lambda: ids.catalog_bbl(c("bbl")), lambda: c("filing_status"), many_labels=True, extra_labels=NOT_DWELLINGS_EXTRA_FILINGS),
        Source("dob_now_approved_permits", "official_approved_permit", lambda: F.concat_ws(":", c("job_filing_number"), c("work_permit")), lambda: iso_date(first_date(c("issued_date"), c("approved_date"))), lambda: c("apt_condo_no_s"), lambda: street_address(c("house_no"), c("street_name")), lambda: c("zip_code"), lambda: ids.catalog_bbl(c("bbl")), lambda: c("permit_status"), many_labels=True, extra_labels=NOT_DWELLINGS_EXTRA_FILINGS),
    )
}


def columns_of(s: Source) -> list[str]:
    """The columns that a source's rules read. A landed row may lack any: feeds leave out what is null."""
    global _named
    _named = names = []
    try:
        for rule in (s.ref, s.observed, s.label, s.address, s.zipcode, s.bbl, s.status, s.price, s.where, s.mined):
            if rule is not None:
                rule()
    finally:
        _named = None
    return sorted({*names} - {"payload"})


def _common_area(key: Column, extra: Sequence[str], floors: bool) -> Column:
    out = key.isin(*NOT_DWELLINGS, *extra)
    return out | key.endswith(" FLOOR") if floors else out


def not_a_dwelling(label: Column, extra: Sequence[str] = (), floors: bool = False) -> Column:
    return _common_area(F.upper(strip(F.coalesce(label, F.lit("")))), extra, floors)


def with_unit_claim(df: DataFrame, bbl: Column, label: Column, s: Source, mined: Column | None = None, out: str = "unit") -> DataFrame:
    """``df`` with a struct(unit_id, status, confidence, rationale). The label is normalised once a row, in a column of its own that no later step is merged with."""
    parts = F.array(normalize_unit(label), F.upper(strip(F.coalesce(label, F.lit("")))))
    d = df.drop(out).select("*", F.explode_outer(F.array(parts)).alias("__parts"))
    unit, key = F.get("__parts", F.lit(0)), F.get("__parts", F.lit(1))
    common = _common_area(key, s.extra_labels, s.floor_is_no_dwelling)
    text_mined = F.lit(False) if mined is None else F.coalesce(mined, F.lit(False))
    status = F.when(bbl.isNull(), "unresolved").when(common, "not_a_dwelling").when(unit == "", "not_a_dwelling" if s.blank_is_no_dwelling else "unresolved").when(text_mined, "unresolved").otherwise("resolved")
    why = F.when(bbl.isNull(), "no building").when(common, "the label names a common area").when(unit == "", "no unit label").when(text_mined, "mined from text").otherwise("building and unit label")
    ok = status == "resolved"
    claim = F.struct(F.when(ok, ids.catalog_id("unit", bbl, unit)).alias("unit_id"), status.alias("status"), F.when(ok, s.unit_confidence).otherwise(0.0).alias("confidence"), why.alias("rationale"))
    return d.withColumn(out, claim).drop("__parts")


def observe(rows: DataFrame, s: Source, retrieved_at: str, addresses: DataFrame | None = None) -> DataFrame:
    """One row per observation: ids, fields, building and unit (structs), bbls (candidates). Rows without an immutable id, or without a date or BBL that the source requires, are left out; columns that the rules read and the rows lack are null."""
    fields = [f for f in (s.fields or rows.columns) if f in rows.columns and f != "payload"]
    payload = c("payload") if "payload" in rows.columns else F.to_json(F.struct(*[c(f) for f in sorted(fields)])) if fields else F.lit("{}")
    d = with_columns_of(rows.withColumn("payload", payload), dict.fromkeys(columns_of(s), "string"))
    d = d.where(s.where()) if s.where else d
    d = d.withColumns({"source_ref": s.ref().cast("string"), "observed_at": s.observed(), "label": s.label(), "addr": s.address(), "zip_in": s.zipcode(), "status_in": s.status(), "price_in": s.price(), "own_bbl": s.bbl() if s.bbl else F.lit(None).cast("string"), "mined": s.mined() if s.mined else F.lit(False)})
    d = d.where(filled(c("source_ref")).isNotNull())
    d = d.where(c("observed_at").isNotNull()) if s.needs_date else d.withColumn("observed_at", F.coalesce("observed_at", F.lit(retrieved_at[:10])))
    d = d.where(c("own_bbl").isNotNull()) if s.needs_bbl else d
    d = d.withColumn("document_id", ids.catalog_id("doc", F.lit(s.name), c("source_ref"), F.lit(retrieved_at)))
    if s.many_labels:
        d = d.withColumn("label", F.explode(split_labels(c("label"))))
        d = d.withColumn("source_ref", ids.catalog_id("unit_event", c("source_ref"), F.coalesce(filled(normalize_unit(c("label"))), F.lit("no_unit"))))
    d = d.withColumn("observation_id", ids.catalog_id("obs", F.lit(s.name), c("source_ref"), c("observed_at"), F.lit(s.kind)))
    d = with_address(d, c("addr"))
    by_address_too = s.bbl is None or s.by_address_too
    if by_address_too and addresses is not None:
        d = candidates(d, addresses, "norm_address", "zip_in")
    else:
        d = d.withColumn("bbls", F.array().cast("array<string>"))
    by_address = status_of(c("bbls"), c("norm_address"))
    own = F.struct(c("own_bbl").alias("bbl"), F.lit("resolved").alias("status"), F.lit(s.building_confidence).alias("confidence"), F.lit("official_bbl").alias("method"), F.lit("the row's own building").alias("rationale"))
    none = F.struct(F.lit(None).cast("string").alias("bbl"), F.lit("unresolved").alias("status"), F.lit(0.0).alias("confidence"), F.lit("official_bbl").alias("method"), F.lit("no usable building number").alias("rationale"))
    d = d.withColumn("building", F.when(c("own_bbl").isNotNull(), own).otherwise(by_address if by_address_too else none))
    d = with_unit_claim(d, c("own_bbl") if s.bbl else c("building.bbl"), c("label"), s, c("mined"))
    return d.select("observation_id", "document_id", F.lit(s.name).alias("source"), "source_ref", "observed_at", F.lit(s.kind).alias("observation_kind"), c("addr").alias("address"), c("label").alias("unit_label"), c("price_in").alias("price"), c("status_in").alias("status"), c("payload").alias("raw_fields"), F.lit(s.grade).alias("evidence_grade"), "norm_address", c("zip_in").alias("zipcode"), "bbls", "building", "unit")


def documents(observed: DataFrame, retrieved_at: str) -> DataFrame:
    return observed.groupBy("document_id").agg(F.first("source").alias("source"), F.min("source_ref").alias("source_ref"), F.min("raw_fields").alias("payload")).withColumn("retrieved_at", F.lit(retrieved_at))


def claims(observed: DataFrame, matched_at: str) -> DataFrame:
    """observation_id, entity_type, entity_id, status, confidence, rationale, matched_at: two rows an observation."""
    b = observed.select("observation_id", F.lit("building").alias("entity_type"), c("building.bbl").alias("entity_id"), "building.status", "building.confidence", "building.rationale")
    u = observed.select("observation_id", F.lit("unit").alias("entity_type"), c("unit.unit_id").alias("entity_id"), "unit.status", "unit.confidence", "unit.rationale")
    return b.unionByName(u).withColumn("matched_at", F.lit(matched_at))


def units_of(observed: DataFrame, now: str) -> DataFrame:
    """The units that observations name, in the order of ``arrival`` if they have one."""
    d = observed.where("unit.status = 'resolved'")
    return d.select(c("unit.unit_id").alias("unit_id"), c("building.bbl").alias("bbl"), "unit_label", normalize_unit(c("unit_label")).alias("normalized_unit"), F.lit(now).alias("first_seen"), F.lit(now).alias("last_seen"), *_arrival(d))


def addresses_of(observed: DataFrame) -> DataFrame:
    d = observed.where("building.status = 'resolved' AND norm_address <> ''")
    return d.select(ids.catalog_id("addr", c("building.bbl"), c("norm_address")).alias("address_id"), c("building.bbl").alias("bbl"), "address", c("norm_address").alias("normalized"), "zipcode", "source", *_arrival(d))


def _arrival(d: DataFrame) -> list[str]:
    return [n for n in ("arrival",) if n in d.columns]


def official_addresses(crosswalk: DataFrame, zips: Sequence[str] | None = None) -> DataFrame:
    """The address file's rows for the catalog, of some zips or all."""
    d = crosswalk.where(c("zipcode").isin(*zips)) if zips else crosswalk
    d = d.select("bbl", c("norm_address").alias("address"), c("norm_address").alias("normalized"), "zipcode").distinct()
    return d.select(ids.catalog_id("addr", c("bbl"), c("normalized")).alias("address_id"), "*", F.lit("nyc_pad").alias("source"))


def record_backbone(buildings: DataFrame, now: str) -> tuple[DataFrame, DataFrame]:
    """(buildings, addresses) of the catalog from the record's buildings table."""
    b = buildings.where(filled(c("bbl")).isNotNull())
    known = b.select("bbl", "borough", c("address").alias("primary_address"), "zipcode", "units_res", "units_total", "building_class", F.lit("record_db").alias("source"), F.lit(now).alias("first_seen"), F.lit(now).alias("last_seen"))
    a = with_address(b, c("address"), "normalized").where("normalized <> ''")
    return known, a.select(ids.catalog_id("addr", c("bbl"), c("normalized")).alias("address_id"), "bbl", "address", "normalized", "zipcode", F.lit("record_db").alias("source"))


def condo_lots(rows: DataFrame, retrieved_at: str) -> tuple[DataFrame, DataFrame]:
    """(official lots of condominium units, their unresolved links). Rows without a valid unit BBL are left out; the borough is no filter."""
    d = rows.withColumn("unit_lot_bbl", ids.catalog_bbl(c("unit_bbl"))).where(c("unit_lot_bbl").isNotNull())
    lots = d.select("unit_lot_bbl", ids.catalog_bbl(c("condo_base_bbl")).alias("condo_base_bbl"), "condo_number", "condo_key", "unit_designation", F.lit(retrieved_at).alias("retrieved_at"))
    links = lots.select("unit_lot_bbl", F.lit(None).cast("string").alias("unit_id"), F.lit("unresolved").alias("status"), F.lit(0.0).alias("confidence"), F.lit("condo_base_lot").alias("method"))
    return lots, links


def listing_observations(listings: DataFrame, history: DataFrame, addresses: DataFrame) -> DataFrame:
    """Every snapshot of every listing (the listing itself where it has none): address, unit and rooms are the listing's, price and status the snapshot's. A snapshot of the last day seen is a source document, an older one a legacy snapshot."""
    s = Source("listing", "listing", lambda: c("source_id"), lambda: c("snapshot_date"), lambda: c("unit_number"))
    l = candidates(with_address(listings, c("address")), addresses)  # noqa: E741
    l = l.withColumn("building", status_of(c("bbls"), c("norm_address")))  # noqa: E741
    h = history.select(c("source").alias("__s"), c("source_id").alias("__i"), "snapshot_date", c("price").alias("__price"), c("status").alias("__status"), F.lit(True).alias("__h"))
    d = l.join(h, (c("source") == c("__s")) & (c("source_id") == c("__i")), "left")
    last_day = F.substring("last_seen", 1, 10)
    d = d.withColumns({"observed_at": F.coalesce("snapshot_date", last_day), "price_at": F.when(c("__h"), c("__price")).otherwise(c("price")), "status_at": F.when(c("__h"), c("__status")).otherwise(c("status"))})
    d = d.withColumn("grade", F.when(c("observed_at") == last_day, "source_document").otherwise("legacy_snapshot"))
    d = with_unit_claim(d, c("building.bbl"), c("unit_number"), s)
    d = d.withColumn("unit_status", F.when(c("building.status") != "resolved", c("building.status")).otherwise(c("unit.status")))
    return d.select(ids.catalog_id("obs", c("source"), c("source_id"), c("observed_at"), F.lit("listing")).alias("observation_id"), "source", "source_id", "observed_at", "address", "unit_number", "bedrooms", "bathrooms", c("price_at").alias("price"), c("status_at").alias("status"), "grade", "bbls", "building", c("unit.unit_id").alias("unit_id"), "unit_status")


def premises(observed: DataFrame, official: DataFrame, now: str, confidence: float = 1.0) -> tuple[DataFrame, DataFrame]:
    """(premises, addressable units): observations whose building and exact address the official address file has."""
    pad = official.where("source = 'nyc_pad'").select("bbl", c("normalized").alias("norm_address"), c("address").alias("official_address"), c("zipcode").alias("official_zip")).dropDuplicates(["bbl", "norm_address"])
    d = observed.where("building.status = 'resolved'").withColumn("bbl", c("building.bbl")).drop("address", "zipcode").join(pad, ["bbl", "norm_address"])
    d = d.withColumn("premise_id", ids.catalog_id("premise", c("bbl"), c("norm_address")))
    p = d.groupBy("premise_id", "bbl", "norm_address").agg(F.min("official_address").alias("address"), F.min("official_zip").alias("zipcode")).withColumns({"first_seen": F.lit(now), "last_seen": F.lit(now)})
    label = normalize_unit(c("unit_label"))
    a = d.where((label != "") & ~not_a_dwelling(c("unit_label"))).withColumn("normalized_unit", label)
    a = a.groupBy("premise_id", "normalized_unit").agg(F.min("unit_label").alias("unit_label"), F.count(F.lit(1)).alias("observations")).withColumn("confidence", F.lit(confidence))
    return p, a.withColumn("addressable_unit_id", ids.catalog_id("addr_unit", c("premise_id"), c("normalized_unit")))
