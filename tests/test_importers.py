import json

from pyspark.sql import functions as F

from lotline.operators import importers as I

NOW = "2026-02-01 00:00:00"


def observed(spark, source, data, addresses=None):
    fields = sorted({k for r in data for k in r})
    df = spark.createDataFrame([tuple(r.get(k) for k in fields) for r in data], ", ".join(f"{k} string" for k in fields))
    return I.observe(df, I.SOURCES[source], NOW, addresses)


def units(o):
    return {r["unit_label"]: (r["b"], r["u"], r["c"]) for r in o.select("unit_label", F.col("building.bbl").alias("b"), F.col("unit.status").alias("u"), F.col("unit.confidence").alias("c")).collect()}


VIOLATION = {"violationid": "1", "boroid": "3", "block": "12", "lot": "7", "apartment": "6B", "housenumber": "5", "streetname": "MAIN STREET", "zip": "11201", "novissueddate": None, "inspectiondate": "2026-01-05T00:00", "violationstatus": "Open"}


def test_violations(spark):
    rows = [VIOLATION, VIOLATION | {"violationid": "2", "apartment": "PUBLIC HALL"}, VIOLATION | {"violationid": "3", "boroid": "9", "apartment": "9X"}, VIOLATION | {"violationid": ""}, VIOLATION | {"violationid": "4", "apartment": " "}]
    o = observed(spark, "hpd_violations", rows)
    assert units(o) == {"6B": ("3000120007", "resolved", 1.0), "PUBLIC HALL": ("3000120007", "not_a_dwelling", 0.0), "9X": (None, "unresolved", 0.0), " ": ("3000120007", "unresolved", 0.0)}
    assert {r["observed_at"] for r in o.collect()} == {"2026-01-05"} and o.select("document_id").distinct().count() == 4
    assert I.addresses_of(o).select("normalized").distinct().collect()[0][0] == "5 MAIN ST"
    assert I.claims(o, NOW).count() == 8 and I.units_of(o, NOW).count() == 1
    assert I.documents(o, NOW).count() == 4


def test_problems_need_date_and_bbl(spark):
    row = {"problem_id": "1", "received_date": "2026-01-01", "borough": "BRONX", "block": "1", "lot": "2", "bbl": "2000010002", "house_number": "5", "street_name": "X ST", "apartment": "BLDG", "problem_status": "OPEN"}
    o = observed(spark, "hpd_problems", [row, row | {"problem_id": "2", "received_date": None}, row | {"problem_id": "3", "bbl": None}])
    assert [(r["source_ref"], r["unit"]["status"]) for r in o.collect()] == [("1", "not_a_dwelling")]


def test_labels_of_a_filing(spark):
    row = {"job_filing_number": "J1", "bbl": "1000010001", "house_no": "5", "street_name": "MAIN ST", "apt_condo_no_s": "1A, 2B; all", "filing_date": "2026-01-01", "current_status_date": None, "filing_status": "OK", "postcode": "1"}
    o = observed(spark, "dob_now_job_filings", [row, row | {"job_filing_number": "J2", "apt_condo_no_s": None}])
    assert {k: v[1] for k, v in units(o).items()} == {"1A": "resolved", "2B": "resolved", "all": "not_a_dwelling", None: "unresolved"}
    assert o.select("observation_id").distinct().count() == 4 and o.select("document_id").distinct().count() == 2


def addresses(spark):
    return spark.createDataFrame([("5 MAIN ST", "1000010001", None), ("7 MAIN ST", "1000010002", "1"), ("7 MAIN ST", "1000010003", "1")], "normalized string, bbl string, zipcode string")


def test_evictions_keep_units_of_addresses_unresolved(spark):
    row = {"court_index_number": "c", "docket_number": "d", "eviction_address": "5 Main Street", "eviction_apt_num": "2", "executed_date": "2026-01-01", "residential_commercial_ind": "Residential", "borough": "X", "eviction_zip": "1", "eviction_possession": "Possession", "ejectment": None, "bbl": None, "marshal_last_name": "SECRET"}
    o = observed(spark, "nyc_evictions", [row, row | {"eviction_address": "7 Main Street", "docket_number": "e"}, row | {"bbl": "1000010009", "eviction_apt_num": "2ND FLOOR", "docket_number": "f"}, row | {"residential_commercial_ind": "Commercial"}], addresses(spark))
    got = {r["address"] + str(r["unit_label"]): (r["building"]["bbl"], r["building"]["status"], r["unit"]["status"]) for r in o.collect()}
    assert got == {"5 Main Street2": ("1000010001", "resolved", "unresolved"), "7 Main Street2": (None, "ambiguous", "unresolved"), "5 Main Street2ND FLOOR": ("1000010009", "resolved", "not_a_dwelling")}
    assert not o.where(F.col("raw_fields").contains("SECRET")).count()


def test_archive_rules(spark):
    row = {"unit_id": "1", "bbl": "1000010001", "address": "5 Main St", "zipcode": "1", "unit_number": "6", "is_placeholder": "0", "source_systems": '["PERMITS"]', "snapshot_at": "2025-05-05 00:00:00"}
    o = observed(spark, "archive_all_units", [row, row | {"unit_id": "2", "unit_number": "7", "source_systems": '["text_mined"]'}, row | {"unit_id": "3", "is_placeholder": "1"}, row | {"unit_id": "4", "unit_number": "FINISHES"}])
    assert units(o) == {"6": ("1000010001", "resolved", 0.8), "7": ("1000010001", "unresolved", 0.0), "FINISHES": ("1000010001", "not_a_dwelling", 0.0)}
    s = {"id": "1", "date": "02/06/26", "scraped_at": None, "snapshot_at": "x", "unit": "", "address": "5 Main St", "status": "s", "price_numeric": "1590000"}
    (r,) = observed(spark, "archive_unit_summary", [s], addresses(spark)).collect()
    assert (r["unit"]["status"], r["observed_at"], r["price"]) == ("not_a_dwelling", "02/06/26", 1590000.0)


def test_agent_contacts_never_leave(spark):
    row = {"core_listing_id": "1", "address": "211 W 10th St 2B, New York", "unit": None, "zip": "", "listing_status": "Closed", "listing_type": "R", "home_type": "x", "ownership_type": "x", "list_price": "10", "close_price": None, "list_date": "2026-01-01", "close_date": "", "update_date": None, "bedrooms": "1", "bathrooms_total": "1", "living_area_sqft": None, "year_built": None, "building_name": None, "source_mls": None, "fetched_at": "2026", "snapshot_at": "2026", "listing_agent_email": "a@b.c"}
    (r,) = observed(spark, "archive_mls_listings", [row], addresses(spark)).collect()
    assert "a@b.c" not in r["raw_fields"] and json.loads(r["raw_fields"])["core_listing_id"] == "1"
    assert (r["address"], r["unit_label"], r["observed_at"], r["price"]) == ("211 W 10th St", "2B", "2026-01-01", 10.0)


def test_sales(spark):
    row = {"borough": "1", "block": "1", "lot": "1", "bbl": "1000010001", "address": "5 MAIN ST, 6B", "apartment_number": "6B", "zip_code": "1", "sale_price": "1590000", "sale_date": "2026-01-01T00", "building_class_category": "x"}
    (r,) = observed(spark, "annualized_sales", [row, row | {"sale_date": None}]).collect()
    assert (r["address"], r["price"], r["unit"]["status"]) == ("5 MAIN ST", 1590000.0, "resolved")
    (r,) = observed(spark, "rolling_sales", [{k: v for k, v in row.items() if k != "bbl"}]).collect()
    assert r["building"]["bbl"] == "1000010001"


def test_condo_lots(spark):
    d = spark.createDataFrame([("1000017501", "1000010001", "5", "k", "A1"), ("bad", "1", "5", "k", "A2")], "unit_bbl string, condo_base_bbl string, condo_number string, condo_key string, unit_designation string")
    lots, links = I.condo_lots(d, NOW)
    assert lots.count() == links.count() == 1 and links.first()["status"] == "unresolved"


def test_listing_snapshots(spark):
    l = spark.createDataFrame([("a", "1", "5 Main Street", "6B", 1.0, 1.0, 10.0, "active", "2026-01-02 00:00:00", None), ("a", "2", "7 Main Street", "Roof", 1.0, 1.0, 10.0, "active", "2026-01-02 00:00:00", "1")], "source string, source_id string, address string, unit_number string, bedrooms double, bathrooms double, price double, status string, last_seen string, zipcode string")  # noqa: E741
    h = spark.createDataFrame([("a", "1", "2026-01-01", 9.0, "active"), ("a", "1", "2026-01-02", 10.0, "active")], "source string, source_id string, snapshot_date string, price double, status string")
    got = sorted((r["source_id"], r["observed_at"], r["price"], r["grade"], r["unit_status"]) for r in I.listing_observations(l, h, addresses(spark)).collect())
    assert got == [("1", "2026-01-01", 9.0, "legacy_snapshot", "resolved"), ("1", "2026-01-02", 10.0, "source_document", "resolved"), ("2", "2026-01-02", 10.0, "source_document", "ambiguous")]


def test_premises(spark):
    o = observed(spark, "hpd_violations", [VIOLATION, VIOLATION | {"violationid": "2"}, VIOLATION | {"violationid": "3", "apartment": "ROOF"}])
    pad = spark.createDataFrame([("3000120007", "5 MAIN ST", "5 MAIN STREET", "11201", "nyc_pad"), ("3000120007", "6 MAIN ST", "6 MAIN STREET", "11201", "other")], "bbl string, normalized string, address string, zipcode string, source string")
    p, a = I.premises(o, pad, NOW)
    assert [(r["address"], r["zipcode"]) for r in p.collect()] == [("5 MAIN STREET", "11201")] and [(r["normalized_unit"], r["observations"]) for r in a.collect()] == [("6B", 2)]


def test_every_source_has_rules():
    assert len(I.SOURCES) == 15 and all(s.name and s.kind for s in I.SOURCES.values())


def test_address_backbones(spark):
    cw = spark.createDataFrame([("5 MAIN ST", "1000010001", "X", "1"), ("7 MAIN ST", "1000010002", "X", "2")], "norm_address string, bbl string, borough string, zipcode string")
    assert I.official_addresses(cw, ["2"]).first()["source"] == "nyc_pad" and I.official_addresses(cw).count() == 2
    b = spark.createDataFrame([("1000010001", "X", "5 Main Street", "1", 2, 3, "C"), ("", "X", "x", "1", 2, 3, "C"), ("1000010003", "X", None, "1", 2, 3, "C")], "bbl string, borough string, address string, zipcode string, units_res int, units_total int, building_class string")
    known, a = I.record_backbone(b, NOW)
    assert known.count() == 2 and [r["normalized"] for r in a.collect()] == ["5 MAIN ST"]
