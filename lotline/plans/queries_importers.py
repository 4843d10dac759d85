"""Every catalog importer over the customer table, whose columns are put together as each source writes them. The SQL states each source's rules anew."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotline.functions import dates
from lotline.operators import coverage, importers
from lotline.plans.catalog import query, read
from lotline.plans.queries_entities import INDEX_SQL, _index

c = F.col
RETRIEVED = "2026-02-03 04:05:06"
text = lambda x: x.cast("string")


def raw_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with the columns of all sources: some ids are blank, some dates and labels are null, some boroughs and buildings are none."""
    k, n = c("c_custkey"), c("c_nationkey")
    ref = F.when(k % 50 == 0, "").otherwise(F.concat(F.lit("r"), text(k)))
    first = F.when(k % 4 > 0, F.concat(F.lit("2024-01-0"), text(k % 9 + 1), F.lit("T00:00:00.000")))
    second = F.when(k % 8 > 0, F.lit("2023-05-06T00:00:00.000"))
    label = F.when(k % 5 == 0, " roof").when(k % 5 == 1, " - ").when(k % 5 == 2, F.concat(F.lit("Apt "), text(k), F.lit("b"))).when(k % 5 == 3, "2nd Floor")
    house, street = text(F.floor(k / 20) + 1), F.lit(" Main Street ")
    zipcode = F.when(k % 4 > 0, text(k % 7))
    bbl = F.when(k % 3 == 0, F.concat(text(k + 1_000_000_000), F.lit(".0")))
    borough, status, price = text(k % 7), F.when(k % 2 == 0, "Open").otherwise("CLOSE"), F.when(k % 6 > 0, text(c("c_acctbal"))).otherwise("n/a")
    names = {
        "violationid problem_id viol_seq_no listing_id omoid document_id unit_id id core_listing_id job_filing_number": ref,
        "novissueddate insp_dt omocreatedate close_date closed_rented_date filing_date issued_date date": first,
        "inspectiondate received_date viol_appr_dt omoawarddate list_date current_status_date approved_date good_through_date sale_date executed_date snapshot_at snapshot_date scraped_at fetched_at": second,
        "apartment actl_unit_insp unit unit_number apartment_number eviction_apt_num address2": label,
        "apt_condo_no_s": F.when(k % 5 == 2, F.concat(label, F.lit("; ALL ,"), text(k))).otherwise(label),
        "housenumber house_number phn street_number house_no": house,
        "streetname street_name str_nm": street,
        "address eviction_address": F.concat(house, street),
        "address1": F.concat(house, F.lit(" Main St, New York")),
        "zip zipcode zip_code eviction_zip postcode": zipcode,
        "boroid borough boro": borough,
        "block": text(k),
        "lot": text(n + 1),
        "bbl": bbl,
        "violationstatus problem_status hzrd_clas omostatusreason property_type status listing_status filing_status permit_status building_class_category eviction_possession": status,
        "price_numeric close_price price sale_price": price,
        "issued_in_err": F.when(k % 10 == 0, "Y").otherwise("N"),
        "is_placeholder": F.when(k % 10 == 0, "1").otherwise("0"),
        "residential_commercial_ind": F.when(k % 10 == 0, "Commercial").otherwise("Residential"),
        "source_systems": F.when(k % 11 == 0, '["text_mined"]').otherwise('["permits"]'),
        "work_permit": F.lit("w"),
    }
    return read(spark, sf_dir, "customer").select(*[col.alias(name) for group, col in names.items() for name in group.split()], k.alias("row_no"))


# The same columns in SQL.
REF = "CASE WHEN k % 50 = 0 THEN '' ELSE concat('r', k) END"
FIRST = "CASE WHEN k % 4 > 0 THEN concat('2024-01-0', k % 9 + 1) END"
SECOND = "CASE WHEN k % 8 > 0 THEN '2023-05-06' END"
PARTS = "CASE WHEN k % 7 BETWEEN 1 AND 5 THEN printf('%d%05d%04d', k % 7, k, n + 1) END"
OWN = "CASE WHEN k % 3 = 0 THEN printf('%010d', 1000000000 + k) END"
# what is left of a label, and whether it names a common area
UNIT = "CASE k % 5 WHEN 0 THEN 'ROOF' WHEN 2 THEN concat(k, 'B') WHEN 3 THEN '2ND' ELSE '' END"
CLOSED = "CASE WHEN k % 2 = 0 THEN 'Open' ELSE 'CLOSE' END"
PRICE = "CASE WHEN k % 6 > 0 THEN c_acctbal END"


def claims_sql(date: str, bbl: str | None, *, ref: str = REF, where: str = "true", needs_date: bool = False, needs_bbl: bool = False, by_address: bool = False, building: float = 1.0, unit: float = 1.0, common: str = "k % 5 = 0", blank: str = "unresolved", mined: str = "false", status: str = CLOSED, price: str = "NULL::DOUBLE", rows: str = "customer") -> str:
    """Observations with their building and unit. ``bbl``: the row's own building, if the source has any; ``by_address``: one building with the address, zips agreeing."""
    return f"""
WITH r AS (SELECT *, c_custkey AS k, c_nationkey AS n FROM {rows}),
i AS ({INDEX_SQL}),
found AS (SELECT c_custkey, count(DISTINCT i.bbl) AS n_bbls, min(i.bbl::VARCHAR) AS one FROM (SELECT c_custkey, concat(1 + c_custkey // 20, ' MAIN ST') AS a, CASE WHEN c_custkey % 4 > 0 THEN c_custkey % 7 END AS z FROM customer) l JOIN i ON i.a = l.a AND (l.z IS NULL OR i.z IS NULL OR l.z = i.z) GROUP BY c_custkey),
o AS (SELECT r.*, {ref} AS source_ref, {date} AS dated, {bbl or "NULL::VARCHAR"} AS own, coalesce(n_bbls, 0) AS n_bbls, one, {UNIT} AS u FROM r LEFT JOIN found USING (c_custkey) WHERE {where}),
b AS (SELECT *, coalesce(own, CASE WHEN {by_address} AND n_bbls = 1 THEN one END) AS bbl, CASE WHEN own IS NOT NULL THEN 'resolved' WHEN NOT {by_address} OR n_bbls = 0 THEN 'unresolved' WHEN n_bbls = 1 THEN 'resolved' ELSE 'ambiguous' END AS building_status FROM o WHERE source_ref <> '' AND ({not needs_date} OR dated IS NOT NULL) AND ({not needs_bbl} OR own IS NOT NULL)),
s AS (SELECT *, {"own" if bbl else "bbl"} AS unit_bbl, CASE WHEN {"own" if bbl else "bbl"} IS NULL THEN 'unresolved' WHEN {common} THEN 'not_a_dwelling' WHEN u = '' THEN '{blank}' WHEN {mined} THEN 'unresolved' ELSE 'resolved' END AS unit_status FROM b)
SELECT source_ref, coalesce(dated, '2026-02-03') AS observed_at, bbl, building_status, CASE WHEN own IS NOT NULL THEN {building}e0 WHEN building_status = 'resolved' THEN 1e0 ELSE 0e0 END AS building_confidence, unit_status, CASE WHEN unit_status = 'resolved' THEN concat('unit_', substr(sha256(concat(unit_bbl, '\\x1f', u)), 1, 20)) END AS unit_id, CASE WHEN unit_status = 'resolved' THEN {unit}e0 ELSE 0e0 END AS unit_confidence, {status} AS status, {price} AS price FROM s
"""


def observed(spark: SparkSession, sf_dir: str, source: str) -> DataFrame:
    o = importers.observe(raw_rows(spark, sf_dir), importers.SOURCES[source], RETRIEVED, _index(spark, sf_dir))
    return o.select("source_ref", "observed_at", c("building.bbl").alias("bbl"), c("building.status").alias("building_status"), c("building.confidence").alias("building_confidence"), c("unit.status").alias("unit_status"), c("unit.unit_id").alias("unit_id"), c("unit.confidence").alias("unit_confidence"), "status", "price")


EITHER = f"coalesce({OWN}, {PARTS})"
ARCHIVED = {"by_address": True, "blank": "not_a_dwelling", "building": 0.8, "unit": 0.8}
LABELS = "(SELECT *, unnest(CASE c_custkey % 5 WHEN 0 THEN [' roof'] WHEN 2 THEN [concat('Apt ', c_custkey, 'b'), 'ALL', c_custkey::VARCHAR] WHEN 1 THEN ['-'] WHEN 3 THEN ['2nd Floor'] ELSE [NULL] END) AS label FROM customer)"
LABEL_UNIT = "CASE WHEN label = ' roof' THEN 'ROOF' WHEN label LIKE 'Apt%' THEN concat(k, 'B') WHEN label = '2nd Floor' THEN '2ND' WHEN label = '-' OR label IS NULL THEN '' ELSE label END"
EVENT = "CASE WHEN {r} <> '' THEN concat('unit_event_', substr(sha256(concat({r}, '\\x1f', coalesce(nullif(" + LABEL_UNIT + ", ''), 'no_unit'))), 1, 20)) ELSE '' END"
#: query -> (source, SQL)
IMPORTERS = {
    "i01_hpd_violations": ("hpd_violations", claims_sql(f"coalesce({FIRST}, {SECOND})", PARTS)),
    "i02_hpd_problems": ("hpd_problems", claims_sql(SECOND, EITHER, needs_date=True, needs_bbl=True)),
    "i03_housing_authority_violations": ("nycha_hmc_violations", claims_sql(f"coalesce({FIRST}, {SECOND})", EITHER, where="k % 10 > 0", needs_date=True, needs_bbl=True)),
    "i04_short_term_registrations": ("ose_str_snapshot", claims_sql("CASE WHEN k % 8 > 0 THEN '2023-05-06T00:00:00.000' END", None, ref="CASE WHEN k % 50 = 0 THEN concat('row-', k) ELSE concat('r', k) END", by_address=True, status="NULL::VARCHAR").replace("CASE WHEN c_custkey % 4 > 0 THEN c_custkey % 7 END AS z FROM customer", "CASE WHEN c_custkey % 4 > 0 THEN c_custkey % 7 ELSE -1 END AS z FROM customer")),
    "i06_work_orders": ("hpd_omo_work_orders", claims_sql(f"coalesce({FIRST}, {SECOND})", EITHER)),
    "i10_archive_units": ("archive_all_units", claims_sql(SECOND, OWN, where="k % 10 > 0", needs_bbl=True, building=0.9, unit=0.8, mined="k % 11 = 0", status="NULL::VARCHAR")),
    "i11_archive_unit_summary": ("archive_unit_summary", claims_sql(f"coalesce({FIRST}, {SECOND})", None, price=PRICE, **ARCHIVED).replace("l.z IS NULL OR i.z IS NULL OR l.z = i.z", "true")),
    "i12_archive_mls_listings": ("archive_mls_listings", claims_sql(f"coalesce({FIRST}, {SECOND})", None, price=PRICE, **ARCHIVED)),
    "i13_archive_broker_listings": ("archive_broker_listings", claims_sql(f"coalesce({FIRST}, {SECOND})", None, price=PRICE, **ARCHIVED)),
    "i16_job_filings": ("dob_now_job_filings", claims_sql(f"coalesce({FIRST}, {SECOND})", OWN, ref=EVENT.format(r=REF), rows=LABELS, common="label IN (' roof', 'ALL')").replace(UNIT + " AS u", LABEL_UNIT + " AS u")),
    "i16_approved_permits": ("dob_now_approved_permits", claims_sql(f"coalesce({FIRST}, {SECOND})", OWN, ref=EVENT.format(r="concat(nullif(" + REF + ", ''), ':w')").replace("<> ''", "IS NOT NULL"), rows=LABELS, common="label IN (' roof', 'ALL')").replace(UNIT + " AS u", LABEL_UNIT + " AS u")),
}


def _importer(name: str) -> None:
    source, sql = IMPORTERS[name]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return observed(spark, sf_dir, source)

    run.__name__ = name
    query(sql)(run)


for _name in IMPORTERS:
    _importer(_name)


def without_ref(name: str, source: str, sql: str) -> None:
    """Sources whose reference is a hash of the whole row: all but the reference is compared."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return observed(spark, sf_dir, source).drop("source_ref")

    run.__name__ = name
    query(f"SELECT * EXCLUDE (source_ref) FROM ({sql})")(run)


ANY = "'some'"
without_ref("i07_property_legals", "acris_property_legals", claims_sql(SECOND, PARTS, ref=ANY, needs_bbl=True))
without_ref("i14_annualized_sales", "annualized_sales", claims_sql(SECOND, EITHER, ref=ANY, needs_date=True, price=PRICE))
without_ref("i14_rolling_sales", "rolling_sales", claims_sql(SECOND, PARTS, ref=ANY, needs_date=True, price=PRICE))
without_ref("i15_evictions", "nyc_evictions", claims_sql(SECOND, OWN, ref=ANY, where="k % 10 > 0", needs_date=True, by_address=True, common="k % 5 IN (0, 3)"))


@query("SELECT printf('%010d', 1000000000 + c_custkey) AS unit_lot_bbl, CASE WHEN c_nationkey > 3 THEN printf('%010d', 2000000000 + c_nationkey) END AS condo_base_bbl, c_mktsegment AS unit_designation, 'unresolved' AS status FROM customer WHERE c_custkey % 6 > 0")
def i05_condo_lots(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, n = c("c_custkey"), c("c_nationkey")
    d = read(spark, sf_dir, "customer").select(F.when(k % 6 > 0, text(k + 1_000_000_000)).otherwise("bad").alias("unit_bbl"), F.when(n > 3, text(n + 2_000_000_000)).otherwise("0").alias("condo_base_bbl"), F.lit("5").alias("condo_number"), F.lit("k").alias("condo_key"), c("c_mktsegment").alias("unit_designation"))
    lots, links = importers.condo_lots(d, RETRIEVED)
    return lots.join(links.select("unit_lot_bbl", "status"), "unit_lot_bbl").select("unit_lot_bbl", "condo_base_bbl", "unit_designation", "status")


@query(f"SELECT entity_type, entity_id, status, confidence, count(*) AS n FROM (SELECT 'building' AS entity_type, bbl AS entity_id, building_status AS status, building_confidence AS confidence FROM ({IMPORTERS['i01_hpd_violations'][1]}) UNION ALL SELECT 'unit', unit_id, unit_status, unit_confidence FROM ({IMPORTERS['i01_hpd_violations'][1]})) GROUP BY ALL")
def j06_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = importers.observe(raw_rows(spark, sf_dir), importers.SOURCES["hpd_violations"], RETRIEVED)
    return importers.claims(o, RETRIEVED).groupBy("entity_type", "entity_id", "status", "confidence").agg(F.count(F.lit(1)).alias("n"))


@query(f"SELECT unit_id, bbl, {UNIT} AS normalized_unit FROM (SELECT *, CAST(substr(source_ref, 2) AS BIGINT) AS k FROM ({IMPORTERS['i01_hpd_violations'][1]})) WHERE unit_status = 'resolved'")
def e10_units_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = importers.observe(raw_rows(spark, sf_dir), importers.SOURCES["hpd_violations"], RETRIEVED)
    return importers.units_of(o, RETRIEVED).select("unit_id", "bbl", "normalized_unit")


PREMISE = f"SELECT concat('premise_', substr(sha256(concat(bbl, '\\x1f', a)), 1, 20)) AS premise_id, bbl, u, common FROM (SELECT {PARTS} AS bbl, concat(1 + k // 20, ' MAIN ST') AS a, {UNIT} AS u, k % 5 = 0 AS common, k FROM (SELECT c_custkey AS k, c_nationkey AS n FROM customer)) WHERE k % 50 > 0 AND bbl IS NOT NULL"


@query(f"SELECT premise_id, u AS normalized_unit, count(*) AS observations FROM ({PREMISE}) WHERE u <> '' AND NOT common GROUP BY ALL")
def j07_addressable_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = importers.observe(raw_rows(spark, sf_dir), importers.SOURCES["hpd_violations"], RETRIEVED)
    official = o.where("building.bbl IS NOT NULL").select(c("building.bbl").alias("bbl"), c("norm_address").alias("normalized"), "address", "zipcode", F.lit("nyc_pad").alias("source"))
    return importers.premises(o, official, RETRIEVED)[1].select("premise_id", "normalized_unit", "observations")


@query(f"SELECT bbl, norm AS normalized, count(*) AS n FROM (SELECT {PARTS} AS bbl, concat(1 + k // 20, ' MAIN ST') AS norm, k FROM (SELECT c_custkey AS k, c_nationkey AS n FROM customer)) WHERE bbl IS NOT NULL AND k % 50 > 0 GROUP BY ALL")
def i18_addresses_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = importers.observe(raw_rows(spark, sf_dir), importers.SOURCES["hpd_violations"], RETRIEVED)
    return importers.addresses_of(o).groupBy("bbl", "normalized").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT DISTINCT s_suppkey::VARCHAR AS bbl, concat(1 + s_suppkey // 2, ' MAIN ST') AS normalized, (s_suppkey % 7)::VARCHAR AS zipcode, 'nyc_pad' AS source FROM supplier WHERE s_suppkey % 5 > 0 AND s_suppkey % 7 IN (2, 3)")
def i18_official_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = _index(spark, sf_dir).withColumnRenamed("normalized", "norm_address")
    return importers.official_addresses(x.union(x), ["2", "3"]).select("bbl", "normalized", "zipcode", "source")


@query("SELECT c_custkey::VARCHAR AS bbl, c_name AS primary_address, c_nationkey AS units_res, concat(1 + c_nationkey, ' OAK ST') AS normalized FROM customer WHERE c_custkey % 5 > 0")
def i20_record_backbone(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = c("c_custkey")
    b = read(spark, sf_dir, "customer").select(F.when(k % 5 > 0, text(k)).otherwise("").alias("bbl"), F.lit("X").alias("borough"), F.concat(text(c("c_nationkey") + 1), F.lit(" Oak Street")).alias("address"), F.lit("1").alias("zipcode"), c("c_nationkey").alias("units_res"), F.lit(1).alias("units_total"), c("c_name").alias("building_class"))
    known, a = importers.record_backbone(b, RETRIEVED)
    return known.join(a.select("bbl", "normalized"), "bbl").select("bbl", c("building_class").alias("primary_address"), "units_res", "normalized")


@query("SELECT o_custkey::VARCHAR AS bbl, count(*) AS registrations, bool_or(strftime(o_orderdate, '%Y-%m-%d') >= '1998-01-01') AS unexpired FROM orders GROUP BY 1")
def i17_registrations(spark: SparkSession, sf_dir: str) -> DataFrame:
    regs = read(spark, sf_dir, "orders").select(text(c("o_custkey")).alias("bbl"), dates.timing(F.date_format("o_orderdate", "yyyy-MM-dd"), "1998-01-01").alias("timing"))
    none = regs.limit(0)
    out = coverage.registration_coverage(regs, none.select("bbl", F.lit(1).alias("units_res")), none.select("bbl", F.lit("").alias("unit_id"), F.lit("").alias("grade")))
    counts = regs.groupBy("bbl").agg(F.count(F.lit(1)).alias("registrations"))
    return out.join(counts, "bbl").select("bbl", "registrations", (c("membership_status") == "hpd_unexpired_no_positive_pluto_count").alias("unexpired"))



