import pytest
from pyspark.sql import functions as F

from lotline.functions import ids
from lotline.operators import coverage, enrich, keys, merges, portfolios, reconcile, resolve, rollup, units, upsert


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def test_snapshot_merge(spark):
    cur = spark.createDataFrame([("a", "1", 10.0, "z", "d1", "d1", "active"), ("a", "2", 20.0, "z", "d1", "d1", "active"), ("b", "9", 1.0, "z", "d1", "d1", "active")], "source string, source_id string, price double, zipcode string, first_seen string, last_seen string, status string")
    inc = spark.createDataFrame([("1", 11.0, None, True, False, 0), ("1", 12.0, None, True, True, 1), ("3", None, "y", True, True, 2)], "source_id string, price double, zipcode string, has_price boolean, has_zip boolean, arrival int")
    out = upsert.snapshot_merge(cur, inc, "a", "d2", ["price", "zipcode"], {"price": "has_price", "zipcode": "has_zip"})
    assert rows(out, "source", "source_id", "price", "zipcode", "first_seen", "last_seen", "status", "action") == sorted(
        [("a", "1", 12.0, None, "d1", "d2", "active", "updated"), ("a", "2", 20.0, "z", "d1", "d1", "inactive", "inactive"), ("a", "3", None, "y", "d2", "d2", "active", "new"), ("b", "9", 1.0, "z", "d1", "d1", "active", "kept")], key=repr
    )
    assert rows(upsert.pull_log(out, "a", "d2"), "listings_count", "new_count", "updated_count") == [(2, 1, 1)]
    same = upsert.snapshot_merge(cur, inc.limit(0), "a", "d2", ["price", "zipcode"])
    assert {r["status"] for r in same.collect()} == {"active"}


def test_absent_keeps_and_present_null_overwrites(spark):
    cur = spark.createDataFrame([("1", "x", "y")], "bbl string, a string, b string")
    inc = spark.createDataFrame([("1", None, None, True, False), ("2", "n", "m", True, True)], "bbl string, a string, b string, pa boolean, pb boolean")
    assert rows(upsert.partial_upsert(cur, inc, "bbl", ["a", "b"], {"a": "pa", "b": "pb"}), "bbl", "a", "b") == [("1", None, "y"), ("2", "n", "m")]


def test_history_keeps_the_last_of_a_day(spark):
    inc = spark.createDataFrame([("1", 1.0, "t", 0), ("1", None, None, 1)], "source_id string, price double, lease_terms string, arrival int")
    assert rows(upsert.history_rows(inc, "a", "2026-01-01"), "source_id", "price", "lease_terms") == [("1", None, None)]


def test_events_without_a_date_never_merge(spark):
    schema = "bbl string, event_type string, event_date string, source string, detail string, arrival int"
    new = spark.createDataFrame([("1", "v", "d", "s", None, 0), ("1", "v", "d", "s", "", 1), ("1", "v", None, "s", None, 2), ("1", "v", None, "s", None, 3), ("1", "v", "d", "s", "x", 4)], schema)
    assert upsert.add_events(new.limit(0), new).count() == 4
    assert upsert.add_events(new, new).count() == 2


def test_first_and_last_writes(spark):
    d = spark.createDataFrame([("k", 1, "a"), ("k", 2, None), ("j", 1, "c")], "k string, at int, v string")
    assert rows(keys.first_wins(d, ["k"], "at"), "k", "v") == [("j", "c"), ("k", "a")]
    assert rows(keys.last_wins(d, ["k"], "at"), "k", "v") == [("j", "c"), ("k", None)]
    assert rows(keys.insert_or_ignore(d.where("k = 'j'"), d, ["k"], "at"), "k", "v") == [("j", "c"), ("k", "a")]
    assert rows(keys.insert_or_replace(d.where("at = 1"), d.where("at = 2"), ["k"], "at"), "k", "v") == [("j", "c"), ("k", None)]
    assert rows(keys.most_frequent(spark.createDataFrame([("k", "b", 2), ("k", "a", 1), ("k", "", 0), ("k", "a", 3), ("k", "b", 4)], "k string, v string, p int"), ["k"], "v", "p", "m"), "k", "m") == [("k", "a")]


def test_address_and_unit_upserts(spark):
    cur = spark.createDataFrame([("1", "n", "A", "z1", "first")], "bbl string, normalized string, address string, zipcode string, source string")
    inc = spark.createDataFrame([("1", "n", "B", None, "nyc_pad", 0)], "bbl string, normalized string, address string, zipcode string, source string, arrival int")
    assert rows(upsert.address_upsert(cur, inc), "address", "zipcode", "source", F.array_join("sources", ",")) == [("B", None, "first", "first,nyc_pad")]
    assert rows(upsert.address_upsert(cur, inc, keep_zip=True), "zipcode") == [("z1",)]
    u = spark.createDataFrame([("1", "6B", "id1", "6b", "d1", "d1")], "bbl string, normalized_unit string, unit_id string, unit_label string, first_seen string, last_seen string")
    n = spark.createDataFrame([("1", "6B", "id2", "#6B", "d2", "d2", 5)], "bbl string, normalized_unit string, unit_id string, unit_label string, first_seen string, last_seen string, arrival long")
    assert rows(upsert.unit_upsert(u, n, ["bbl", "normalized_unit"], "unit_id", "unit_label"), "unit_id", "unit_label", "first_seen", "last_seen") == [("id1", "#6B", "d1", "d2")]


def test_house_numbers(spark):
    d = spark.createDataFrame([("602", "606", "E"), ("602", "605", "E"), ("5", "", "O"), ("52-41", "52-49", "O"), ("1", "9000", "O"), ("9", "3", "O"), ("", "3", "O"), (None, None, None), ("1", "4", None)], "lo string, hi string, p string")
    got = [r["x"] for r in d.select(resolve.house_numbers(F.col("lo"), F.col("hi"), F.col("p")).alias("x")).collect()]
    assert got == [["602", "604", "606"], ["602", "603", "604", "605"], ["5"], ["52-41"], ["1"], ["9"], [], [], ["1", "2", "3", "4"]]


def addresses(spark):
    return spark.createDataFrame([("5 MAIN ST", "1", "10001"), ("5 MAIN ST", "2", "10002"), ("7 MAIN ST", "3", None), ("9 MAIN ST", "4", "10001"), ("9 MAIN ST", "4", "10009")], "normalized string, bbl string, zipcode string")


def test_resolution(spark):
    q = spark.createDataFrame([(1, "5 MAIN ST", "10001"), (2, "5 MAIN ST", None), (3, "5 MAIN ST", "99999"), (4, "7 MAIN ST", "10001"), (5, "7 MAIN ST", ""), (6, "", None), (7, "9 MAIN ST", None), (8, "5 MAIN ST", "")], "id int, norm_address string, zipcode string")
    d = resolve.candidates(q, addresses(spark))
    s = d.select("id", resolve.status_of(F.col("bbls"), F.col("norm_address")).alias("s"))
    assert rows(s, "id", "s.bbl", "s.status") == [(1, "1", "resolved"), (2, None, "ambiguous"), (3, None, "unresolved"), (4, "3", "resolved"), (5, "3", "resolved"), (6, None, "unresolved"), (7, "4", "resolved"), (8, None, "unresolved")]
    assert rows(resolve.candidate_rows(d, "id"), "observation_id", "candidate_id") == [(2, "1"), (2, "2")]
    z = resolve.zip_or_all(q, addresses(spark))
    assert dict(rows(z, "id", F.array_join("bbls", ",")))[3] == "1,2"
    f = resolve.first_bbl(q, addresses(spark).withColumnRenamed("normalized", "norm_address"))
    assert dict(rows(f, "id", "bbl")) == {1: "1", 2: "1", 3: "1", 4: "3", 5: "3", 6: None, 7: "4", 8: "1"} and f.count() == 8


def test_crosswalks(spark):
    lots = spark.createDataFrame([("1000010001.0", "5 Main Street", "MN", "10001", 0), ("1000010001", "5 MAIN ST", "XX", "9", 1), ("x", "6 Main St", "MN", "1", 2), ("1000010002", "Main", "MN", "1", 3)], "bbl string, address string, borough string, zipcode string, arrival int")
    cw = resolve.crosswalk_from_lots(lots)
    assert rows(cw, "norm_address", "bbl", "borough") == [("5 MAIN ST", "1000010001", "MN")]
    pad = spark.createDataFrame([("1", "1", "1", "5", "9", "O", "Main Street", "", "10001", 0), ("1", "1", "2", "5", "5", "O", "High Street", "X", "10001", 1), ("1", "", "2", "5", "5", "O", "Low Street", "", "10001", 2), ("2", "7", "8", "52-41", "", "", "Vanity Plz", "V", "10002", 3)], "boro string, block string, lot string, lhnd string, hhnd string, parity string, stname string, addrtype string, zipcode string, arrival int")
    assert rows(resolve.crosswalk_from_ranges(pad, cw), "norm_address", "bbl", "borough") == [("52-41 VANITY PLAZA", "2000070008", "BRONX"), ("7 MAIN ST", "1000010001", "MANHATTAN"), ("9 MAIN ST", "1000010001", "MANHATTAN")]
    assert resolve.crosswalk_from_ranges(pad, cw, zips=["10002"]).count() == 1 and resolve.crosswalk_from_ranges(pad, cw, limit=2).count() == 2


def test_canonical_units(spark):
    schema = "source string, source_id string, address string, unit_number string, bedrooms double, last_seen string, status string, price double"
    d = spark.createDataFrame(
        [("nooklyn", "1", "5 Main Street", "#6B", 1.0, "2026-01-03 00:00:00", "active", 5.0), ("direct", "2", "5 MAIN ST", "Apt 6B", 1.0, "2026-01-01 00:00:00", "active", None), ("direct", "3", "5 MAIN ST", "", 1.0, "bad", "active", 1.0), ("direct", "4", "5 MAIN ST", "", 1.0, "bad", "active", 1.0), ("other", "5", "5 Main St", "6b", None, "2026-01-01 00:00:00", "active", 0.0), ("direct", "6", "5 MAIN ST", "6B", 1.0, "2026-01-01 00:00:00", "inactive", 9.0)],
        schema,
    )
    u = units.build_units(d)
    assert rows(u, "source_id", "is_canonical", "cluster_size") == [("1", 0, 2), ("2", 1, 2), ("3", 1, 1), ("4", 1, 1), ("5", 1, 1)]
    assert rows(units.canonical_rows(d, ["source_id"]), "source_id", "cluster_size") == [("2", 2), ("3", 1), ("4", 1), ("5", 1)]
    assert rows(units.unit_stats(u), "raw_listings", "distinct_units", "duplicate_clusters") == [(5, 4, 1)]
    assert rows(units.find_duplicates(u), "n", "sources") == [(2, 2)]
    same = d.where("source = 'direct' AND status = 'active'").withColumn("unit_number", F.lit("1"))
    assert units.find_duplicates(units.build_units(same)).count() == 0 and units.find_duplicates(units.build_units(same), False).count() == 1


def test_portfolios(spark):
    b = spark.createDataFrame([("1", "A LLC", "5 Main Street", 1, 2), ("2", "B LLC", "5 MAIN ST.", None, 1), ("3", "B LLC", "", 3, 3), ("4", None, "", 3, 4), ("5", None, None, 3, 5), ("6", "", "5 Main St", 1, 6)], "bbl string, owner_name string, owner_business_address string, violations int, position int")
    p, where = portfolios.build_portfolios(b)
    got = rows(p, "building_count", "llc_count", "canonical_name", "business_address", "total_violations")
    assert got == sorted([(3, 2, "B LLC", "5 MAIN ST.", 2), (1, 1, "B LLC", None, 3), (1, 0, "(unknown owner)", None, 3)], key=repr)
    assert where.count() == 5 and where.select("portfolio_id").distinct().count() == 3
    assert rows(portfolios.largest(p, 5), "building_count") == [(3,)]


def test_rollups(spark):
    e = spark.createDataFrame([("1", "2026-01-02", "Open"), ("1", None, "closed"), ("1", "2026-01-01", None), ("2", None, "open")], "bbl string, event_date string, status string")
    assert rows(rollup.event_rollup(e, "n", "last", open_=F.lower("status") == "open"), "bbl", "n", "last", "n_open") == [("1", 3, "2026-01-02", 1), ("2", 1, None, 1)]


def test_coverage_and_capacity(spark):
    b = spark.createDataFrame([("1", 3), ("2", 1), ("3", 0), ("4", None), ("5", 9)], "bbl string, units_res int")
    u = spark.createDataFrame([("1",), ("5",), ("5",)], "bbl string")
    assert [(r["bbl"], r["unnamed"]) for r in coverage.capacity_gaps(b, u, 2).collect()] == [("5", 7), ("1", 2)]
    with pytest.raises(ValueError):
        coverage.capacity_gaps(b, u, 0)
    assert rows(coverage.capacity_slots(b, "r", after="1", batch=1), "bbl", "slot_ordinal") == [("2", 1)]
    assert coverage.capacity_slots(b, "r").count() == 13
    regs = spark.createDataFrame([("1", "unexpired"), ("3", "unexpired"), ("2", "missing"), ("6", "expired")], "bbl string, timing string")
    claims = spark.createDataFrame([("1", "u", "source_document"), ("1", "u", "source_document"), ("1", "v", "other")], "bbl string, unit_id string, grade string")
    got = {r["bbl"]: r for r in coverage.registration_coverage(regs, b, claims).collect()}
    assert {k: r["membership_status"] for k, r in got.items()} == {"1": "hpd_unexpired_pluto_residential", "2": "hpd_expired_pluto_residential", "3": "hpd_unexpired_no_positive_pluto_count", "5": "pluto_residential_not_hpd_unexpired", "6": "hpd_only_no_pluto_lot"}
    assert (got["1"]["unit_claims"], got["1"]["official_units"]) == (3, 1)
    listings = spark.createDataFrame([("a", "1", "10001", "active"), ("a", "2", " ", "active"), ("b", "1", None, "active"), ("b", "2", "10001", "inactive")], "source string, source_id string, zipcode string, status string")
    cov = coverage.listing_coverage(listings, spark.createDataFrame([("a", "1"), ("a", "1")], "source string, source_id string"))
    assert rows(cov, "source", "zipcode", "listings", "resolved", "resolution_rate") == [("a", "10001", 1, 1, 1.0), ("a", "unknown", 1, 0, 0.0), ("b", "unknown", 1, 0, 0.0)]
    assert rows(coverage.listing_zips(listings), "zipcode") == [("10001",)] and coverage.optional_count(spark, "no_such_table") is None


def test_corroboration(spark):
    l = spark.createDataFrame([(1, "5 Main Street", "6B", ["a", "b"]), (2, "5 Main Street", "7", ["a", "b"]), (3, "5 Main Street", "Roof", ["a", "b"]), (4, "Main", "6B", ["a", "b"])], "observation_id int, address string, unit_label string, bbls array<string>")  # noqa: E741
    e = spark.createDataFrame([("a", "6B", "5 MAIN ST", "u1", "r2", "o1"), ("a", "6B", "5 Main Street", "u1", "r1", "o2"), ("b", "6B", "9 MAIN ST", "u2", "r3", "o3"), ("a", "7", "5 MAIN ST", "u3", "r4", "o4"), ("b", "7", "5 MAIN ST", "u4", "r5", "o5"), ("c", "6B", "5 MAIN ST", "u9", "r9", "o9")], "bbl string, normalized_unit string, address string, unit_id string, source_ref string, observation_id string")
    got = reconcile.corroborate(l, e)
    assert rows(got, "observation_id", "outcome", "bbl", "unit_id", "confidence") == [(1, "resolved", "a", "u1", 0.98), (2, "ambiguous", None, None, 0.0), (3, "skipped", None, None, 0.0), (4, "skipped", None, None, 0.0)]
    assert got.where("observation_id = 1").first()["rationale"].endswith("r1, r2") and reconcile.evidence_edges(got).count() == 4


def test_demotion(spark):
    m = spark.createDataFrame([("o1", "unit", "u1", "resolved", 0.8), ("o2", "unit", "u1", "resolved", 0.8), ("o3", "unit", "u2", "resolved", 0.8), ("o3", "building", "b", "resolved", 0.9)], "observation_id string, entity_type string, entity_id string, status string, confidence double")
    o = spark.createDataFrame([("o1", "Text_Mined"), ("o2", "permit"), ("o3", "x TEXT_MINED y")], "observation_id string, raw_fields string")
    claims, left = upsert.demote(m, spark.createDataFrame([("u1",), ("u2",), ("u3",)], "unit_id string"), o)
    assert rows(left, "unit_id") == [("u1",), ("u3",)]
    assert rows(claims.where("status = 'unresolved'"), "observation_id", "entity_id", "confidence") == [("o1", None, 0.0), ("o3", None, 0.0)]


def test_merges(spark):
    raw = spark.createDataFrame([("a", "5 Main Street", "6B", "10001", "r1"), ("a", "5 Main Street", "A1", None, "r2"), ("a", "5 Main Street", "Z", None, "r3"), ("a", "8 None St", "1", None, "r4"), ("a", "Main", "1", None, "r5"), ("a", "5 Main Street", "apt", None, "r6")], "source string, address string, unit string, zip string, source_ref string")
    lots = spark.createDataFrame([("1", "A-1"), ("2", "B")], "unit_lot_bbl string, unit_designation string")
    r = merges.route(raw, addresses(spark), lots)
    assert rows(r, "source_ref", "route", "bbl", "resolved_via", "reason", "candidate_bbls") == [("r1", "units", "1", "address+zip", None, None), ("r2", "units", "1", "condo_unit_designation", None, None), ("r3", "ambiguous", None, None, None, "1,2"), ("r4", "unresolved", None, None, "no official BBL match", None), ("r5", "unresolved", None, None, "address did not normalize", None), ("r6", "no_unit", None, None, None, None)]
    b = spark.createDataFrame([("1", 0, "x"), ("2", 4, "x"), ("3", 1, "x"), ("4", 1, " ")], "bbl string, units_res int, primary_address string")
    t = merges.merge_tiebreak(r, b, "now")
    assert rows(t, "bbl", "confidence", "source") == [("2", 0.9, "a_tradable_tiebreak")]
    archive = spark.createDataFrame([("r1", '["PERMITS"]'), ("r2", '["PLUTO_INFERRED"]')], "unit_id string, source_systems string")
    assert rows(merges.merge_known(r, archive, "a", "now"), "bbl", "source") == [("1", "permits")]
    none = spark.createDataFrame([], "bbl string")
    assert rows(merges.merge_single_family(b, none, "now"), "bbl", "unit_normalized") == [("3", "WHOLEBLDG")]
    assert rows(merges.merge_condo_lots(lots, none, "now"), "bbl", "unit_normalized") == [("1", "A1"), ("2", "B")]
    again = merges.merge_single_family(b, none, "later").select("observation_id").collect()
    assert again == merges.merge_single_family(b, none, "now").select("observation_id").collect()


def test_enrichment(spark):
    b = spark.createDataFrame([("1", 40.7, -74.0, "12"), ("2", 40.8, -73.9, None), ("3", None, -73.9, "1")], "bbl string, latitude double, longitude double, census_tract string")
    s = spark.createDataFrame([("Far", 41.0, -74.0, "A"), ("Near", 40.701, -74.0, "N W"), ("Near too", 40.801, -73.9, "")], "name string, lat double, lng double, daytime_routes string")
    assert rows(enrich.nearest_station(b, s), "bbl", "nearest_subway", "subway_dist_m", "subway_lines") == [("1", "Near", 111, "N,W"), ("2", "Near too", 111, None)]
    areas = spark.createDataFrame([("36061000012", 5)], "geoid string, income int")
    assert dict(rows(enrich.by_area(b, areas), "bbl", "income")) == {"1": 5, "2": None, "3": None}
    assert rows(enrich.with_points(b, borough=2), "bbl") == [("2",)]


def test_missing_buildings(spark):
    assert rows(resolve.missing_buildings(spark.createDataFrame([("1",), ("2",), ("2",)], "bbl string"), spark.createDataFrame([("1",)], "bbl string")), "bbl") == [("2",)]
    assert rows(upsert.with_columns_of(spark.range(1), {"id": "long", "x": "double"}), "id", "x") == [(0, None)]
    assert ids.in_borough(F.lit("1"), None) is not None
