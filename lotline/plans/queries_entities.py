"""Entity resolution over the driver's tables: merges, resolution, units, portfolios, coverage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from lotline.functions import dates, ids
from lotline.functions import text as X
from lotline.operators import coverage, enrich, importers, keys, merges, portfolios, reconcile, resolve, units, upsert
from lotline.plans.catalog import query, read
from lotline.plans.queries_scalars import point

c = F.col

DOC_UNITS_SQL = "SELECT doc_id, source, sha1(text) AS k, row_number() OVER (PARTITION BY text ORDER BY CASE WHEN source IN ('src0', 'src7') THEN 1 ELSE 0 END, (CASE WHEN doc_id % 3 > 0 THEN 1 ELSE 0 END) DESC, source, doc_id::VARCHAR) AS n, count(*) OVER (PARTITION BY text) AS cluster_size FROM documents"


def _doc_ads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as ads: equal texts advertise the same unit."""
    return read(spark, sf_dir, "documents").select("doc_id", "source", c("doc_id").cast("string").alias("source_id"), F.concat(F.lit("1 Main Street "), F.upper(F.sha1(c("text").cast("binary")))).alias("address"), F.concat(F.lit("1"), F.upper(F.sha1(c("text").cast("binary")))).alias("unit_number"), F.lit(None).cast("double").alias("bedrooms"), F.lit("2026-01-01 00:00:00").alias("last_seen"), F.lit("active").alias("status"), F.when(c("doc_id") % 3 > 0, c("lang")).otherwise("").alias("neighborhood"))


def _doc_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    return units.build_units(_doc_ads(spark, sf_dir), fields=["address", "unit_number", "neighborhood"], marketplaces=["src0", "src7"])


@query(f"SELECT doc_id, source, cluster_size FROM ({DOC_UNITS_SQL}) WHERE n = 1")
def e06_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship: one row for each physical unit."""
    out = units.canonical_rows(_doc_ads(spark, sf_dir), ["doc_id", "source"], fields=["address", "unit_number", "neighborhood"], marketplaces=["src0", "src7"])
    return out.select("doc_id", "source", "cluster_size")


@query(f"SELECT doc_id, (n = 1)::INTEGER AS is_canonical, cluster_size FROM ({DOC_UNITS_SQL})")
def e06_build_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _doc_units(spark, sf_dir).select("doc_id", "is_canonical", "cluster_size")


@query("SELECT count(*) AS n, count(DISTINCT source) AS sources, array_to_string(list_sort(list(concat(source, ':', doc_id))), ',') AS members FROM documents GROUP BY text HAVING count(*) >= 2 AND count(DISTINCT source) >= 2")
def e07_find_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = units.find_duplicates(_doc_units(spark, sf_dir))
    return d.select("n", "sources", F.array_join(F.array_sort(F.transform("members", lambda m: F.concat_ws(":", m["source"], m["source_id"]))), ",").alias("members"))


@query("SELECT count(*) AS raw_listings, count(DISTINCT text) AS distinct_units, (SELECT count(*) FROM (SELECT 1 FROM documents GROUP BY text HAVING count(*) > 1)) AS duplicate_clusters FROM documents")
def e06_unit_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return units.unit_stats(_doc_units(spark, sf_dir))


# two suppliers at an address, twenty customers at another street's number: some are found, some are not, some are found twice
LOOKUP_SQL = "SELECT c_custkey, CASE WHEN c_custkey % 4 > 0 THEN c_custkey % 7 END AS z, concat(1 + c_custkey // 20, ' MAIN ST') AS a FROM customer"
INDEX_SQL = "SELECT concat(1 + s_suppkey // 2, ' MAIN ST') AS a, CASE WHEN s_suppkey % 5 > 0 THEN s_suppkey % 7 END AS z, s_suppkey AS bbl FROM supplier"


def _lookups(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = c("c_custkey")
    house = F.floor(k / 20) + 1
    d = read(spark, sf_dir, "customer").select("c_custkey", F.when(k % 4 > 0, (k % 7).cast("string")).alias("zipcode"), F.concat(house.cast("string"), F.lit(" Main Street, Apt 3")).alias("address"), k.cast("string").alias("unit"))
    return X.with_address(d, c("address"))


def _index(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = c("s_suppkey")
    d = read(spark, sf_dir, "supplier").select(F.concat((F.floor(k / 2) + 1).cast("string"), F.lit(" MAIN STREET")).alias("address"), F.when(k % 5 > 0, (k % 7).cast("string")).alias("zipcode"), k.cast("string").alias("bbl"))
    return X.with_address(d, c("address"), "normalized").drop("address")


@query(f"SELECT c_custkey, coalesce((SELECT min(bbl::VARCHAR) FROM ({INDEX_SQL}) i WHERE i.a = l.a AND i.z = l.z), (SELECT min(bbl::VARCHAR) FROM ({INDEX_SQL}) i WHERE i.a = l.a)) AS bbl FROM ({LOOKUP_SQL}) l")
def j04_prioritised_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolve.first_bbl(_lookups(spark, sf_dir), _index(spark, sf_dir).withColumnRenamed("normalized", "norm_address")).select("c_custkey", "bbl")


@query(f"SELECT c_custkey, CASE WHEN n = 1 THEN b END AS bbl, CASE WHEN n = 1 THEN 'resolved' WHEN n > 1 THEN 'ambiguous' ELSE 'unresolved' END AS status, CASE WHEN n = 1 THEN 1e0 ELSE 0e0 END AS confidence, n AS found FROM (SELECT l.c_custkey, count(DISTINCT i.bbl) AS n, min(i.bbl::VARCHAR) AS b FROM ({LOOKUP_SQL}) l LEFT JOIN ({INDEX_SQL}) i ON i.a = l.a AND (l.z IS NULL OR i.z IS NULL OR l.z = i.z) GROUP BY l.c_custkey)")
def e04_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = resolve.candidates(_lookups(spark, sf_dir), _index(spark, sf_dir))
    s = resolve.status_of(c("bbls"), c("norm_address"))
    return d.select("c_custkey", s["bbl"].alias("bbl"), s["status"].alias("status"), s["confidence"].alias("confidence"), F.size("bbls").cast("long").alias("found"))


@query(f"SELECT l.c_custkey::VARCHAR AS observation_id, i.bbl::VARCHAR AS candidate_id FROM ({LOOKUP_SQL}) l JOIN ({INDEX_SQL}) i ON i.a = l.a AND (l.z IS NULL OR i.z IS NULL OR l.z = i.z) QUALIFY count(*) OVER (PARTITION BY l.c_custkey) > 1")
def e05_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = resolve.candidates(_lookups(spark, sf_dir), _index(spark, sf_dir))
    return resolve.candidate_rows(d, "c_custkey").select(c("observation_id").cast("string").alias("observation_id"), "candidate_id")


@query(f"SELECT c_custkey, array_to_string(list_sort(CASE WHEN count(*) FILTER (WHERE near) > 0 THEN list(bbl) FILTER (WHERE near) ELSE list(bbl) END), ',') AS bbls FROM (SELECT l.c_custkey, i.bbl::VARCHAR AS bbl, l.z IS NULL OR i.z IS NULL OR l.z = i.z AS near FROM ({LOOKUP_SQL}) l JOIN ({INDEX_SQL}) i ON i.a = l.a) GROUP BY c_custkey")
def j21_zip_or_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = resolve.zip_or_all(_lookups(spark, sf_dir), _index(spark, sf_dir))
    return d.where(F.size("bbls") > 0).select("c_custkey", F.array_join("bbls", ",").alias("bbls"))


M02_SQL = f"""
WITH hit AS (SELECT l.c_custkey, i.bbl::VARCHAR AS bbl, l.z IS NULL OR i.z IS NULL OR l.z = i.z AS near FROM ({LOOKUP_SQL}) l JOIN ({INDEX_SQL}) i ON i.a = l.a),
sets AS (SELECT c_custkey, CASE WHEN count(*) FILTER (WHERE near) > 0 THEN list(bbl) FILTER (WHERE near) ELSE list(bbl) END AS bbls FROM hit GROUP BY c_custkey),
tie AS (SELECT c_custkey, min(bbl) AS bbl FROM (SELECT c_custkey, unnest(bbls) AS bbl FROM sets WHERE len(bbls) > 1) WHERE CAST(bbl AS BIGINT) % 10 = c_custkey % 10 GROUP BY c_custkey HAVING count(*) = 1)
SELECT c.c_custkey::VARCHAR AS source_ref, CASE WHEN c.c_custkey % 9 = 0 THEN 'no_unit' WHEN bbls IS NULL THEN 'unresolved' WHEN len(bbls) = 1 OR tie.bbl IS NOT NULL THEN 'units' ELSE 'ambiguous' END AS route,
  CASE WHEN c.c_custkey % 9 = 0 THEN NULL WHEN len(bbls) = 1 THEN bbls[1] ELSE tie.bbl END AS bbl,
  CASE WHEN c.c_custkey % 9 > 0 AND len(bbls) > 1 AND tie.bbl IS NULL THEN array_to_string(list_sort(bbls), ',') END AS candidate_bbls
FROM customer c LEFT JOIN sets USING (c_custkey) LEFT JOIN tie USING (c_custkey)
"""


def _routed(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _lookups(spark, sf_dir).withColumn("label", F.when(c("c_custkey") % 9 > 0, F.concat(F.lit("u"), (c("c_custkey") % 10).cast("string"))))
    rows = merges.extract_all(("archive", raw, {"address": c("address"), "unit": c("label"), "zip": c("zipcode"), "source_ref": c("c_custkey")}))
    lots = _index(spark, sf_dir).select(c("bbl").alias("unit_lot_bbl"), F.concat(F.lit("U-"), F.substring("bbl", -1, 1)).alias("unit_designation"))
    return merges.route(rows, _index(spark, sf_dir), lots)


@query(M02_SQL)
def m02_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _routed(spark, sf_dir).select("source_ref", "route", "bbl", "candidate_bbls")


@query(f"WITH r AS ({M02_SQL}), x AS (SELECT source_ref, unnest(string_split(candidate_bbls, ',')) AS bbl FROM r WHERE route = 'ambiguous') SELECT source_ref, min(x.bbl) AS bbl, 0.9e0 AS confidence FROM x WHERE CAST(x.bbl AS BIGINT) % 4 = 1 GROUP BY source_ref HAVING count(*) = 1")
def m05_tiebreak(spark: SparkSession, sf_dir: str) -> DataFrame:
    buildings = _index(spark, sf_dir).select("bbl", F.when(c("bbl").cast("long") % 4 == 1, 2).otherwise(0).alias("units_res"))
    return merges.merge_tiebreak(_routed(spark, sf_dir), buildings, "2026-01-01 00:00:00").select("source_ref", "bbl", "confidence")


@query("SELECT s_suppkey::VARCHAR AS bbl, '(whole building)' AS unit_label FROM supplier WHERE s_suppkey % 2 = 1 AND s_suppkey NOT IN (SELECT l_suppkey FROM lineitem WHERE l_quantity >= 50 AND l_returnflag = 'R')")
def m04_single_family(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = read(spark, sf_dir, "supplier").select(c("s_suppkey").cast("string").alias("bbl"), (2 - c("s_suppkey") % 2).alias("units_res"), c("s_name").alias("primary_address"))
    named = read(spark, sf_dir, "lineitem").where("l_quantity >= 50 AND l_returnflag = 'R'").select(c("l_suppkey").cast("string").alias("bbl"))
    return merges.merge_single_family(b, named, "2026-01-01 00:00:00").select("bbl", "unit_label")


@query("SELECT p_partkey::VARCHAR AS bbl, p_brand AS unit_label, 'BRAND' || substr(p_brand, 7) AS unit_normalized FROM part WHERE p_size % 3 > 0 AND p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity >= 49)")
def m06_condo_lots(spark: SparkSession, sf_dir: str) -> DataFrame:
    lots = read(spark, sf_dir, "part").select(c("p_partkey").cast("string").alias("unit_lot_bbl"), F.when(c("p_size") % 3 > 0, c("p_brand")).otherwise(" ").alias("unit_designation"))
    named = read(spark, sf_dir, "lineitem").where("l_quantity >= 49").select(c("l_partkey").cast("string").alias("bbl"))
    return merges.merge_condo_lots(lots, named, "2026-01-01 00:00:00").select("bbl", "unit_label", "unit_normalized")


@query("SELECT c_custkey, s.s_name AS nearest, CAST(round_even(s.d, 0) AS INTEGER) AS metres FROM (SELECT c_custkey, arg_min({'s_name': s_name, 'd': d}, {'d': d, 's_name': s_name}) AS s FROM (SELECT c_custkey, s_name, 12742000e0 * asin(sqrt(pow(sin(radians(slat - lat) / 2), 2) + cos(radians(lat)) * cos(radians(slat)) * pow(sin(radians(slng - lng) / 2), 2))) AS d FROM (SELECT c_custkey, 40.5e0 + (c_custkey % 400) / 1000e0 AS lat, -74.2e0 + (c_custkey % 433) / 1000e0 AS lng FROM customer), (SELECT s_name, 40.5e0 + (s_suppkey % 37) / 100e0 AS slat, -74.2e0 + (s_suppkey % 41) / 100e0 AS slng FROM supplier)) GROUP BY c_custkey)")
def j24_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = c("s_suppkey")
    stations = read(spark, sf_dir, "supplier").select(c("s_name").alias("name"), (F.lit(40.5) + (k % 37) / F.lit(100.0)).alias("lat"), (F.lit(-74.2) + (k % 41) / F.lit(100.0)).alias("lng"), F.lit("N W").alias("daytime_routes"))
    b = read(spark, sf_dir, "customer").select(c("c_custkey").cast("string").alias("bbl"), point()[0].alias("latitude"), point()[1].alias("longitude"))
    return enrich.nearest_station(b, stations).select(c("bbl").cast("long").alias("c_custkey"), c("nearest_subway").alias("nearest"), c("subway_dist_m").alias("metres"))


@query("SELECT p_partkey::VARCHAR AS bbl, unnest(generate_series(1, p_size))::INTEGER AS slot_ordinal FROM part WHERE p_size > 0")
def j13_capacity_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = read(spark, sf_dir, "part").select(c("p_partkey").cast("string").alias("bbl"), c("p_size").alias("units_res"))
    return coverage.capacity_slots(b, "run").select("bbl", "slot_ordinal")


@query("SELECT p_partkey::VARCHAR AS bbl, p_size + 60 AS units_res, coalesce(n, 0) AS named, p_size + 60 - coalesce(n, 0) AS unnamed FROM part LEFT JOIN (SELECT l_partkey AS p_partkey, count(*) AS n FROM lineitem GROUP BY 1) USING (p_partkey) WHERE p_size + 60 > coalesce(n, 0) ORDER BY unnamed DESC, units_res DESC, bbl LIMIT 25")
def o02_topk_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = read(spark, sf_dir, "part").select(c("p_partkey").cast("string").alias("bbl"), (c("p_size") + 60).alias("units_res"))
    return coverage.capacity_gaps(b, read(spark, sf_dir, "lineitem").select(c("l_partkey").cast("string").alias("bbl")), 25)


@query("SELECT source, zipcode, listings, resolved, listings - resolved AS unresolved, round(resolved / listings, 6) AS resolution_rate FROM (SELECT source, coalesce(nullif(trim(CASE WHEN d.doc_id % 7 > 0 THEN lang ELSE ' ' END), ''), 'unknown') AS zipcode, count(*) AS listings, count(l.doc_id) AS resolved FROM documents d LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l USING (doc_id) GROUP BY ALL)")
def e13_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read(spark, sf_dir, "documents")
    listings = d.select("source", c("doc_id").cast("string").alias("source_id"), F.when(c("doc_id") % 7 > 0, c("lang")).otherwise(" ").alias("zipcode"), F.lit("active").alias("status"))
    hits = read(spark, sf_dir, "labels").select("doc_id").join(d.select("doc_id", "source"), "doc_id").select("source", c("doc_id").cast("string").alias("source_id"))
    return coverage.listing_coverage(listings, hits)


@query("SELECT source, sum(n)::BIGINT AS listings, sum(r)::BIGINT AS resolved, round(sum(r) / sum(n), 6) AS resolution_rate FROM (SELECT source, lang, count(*) AS n, count(l.doc_id) AS r FROM documents d LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l USING (doc_id) GROUP BY ALL) GROUP BY source")
def g12_coverage_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage.coverage_by_source(e13_coverage(spark, sf_dir))


E16_SQL = """
WITH hpd AS (SELECT o_custkey AS k, bool_or(strftime(o_orderdate, '%Y-%m-%d') >= '1998-01-01') AS unexpired FROM orders GROUP BY 1),
lots AS (SELECT c_custkey AS k, c_nationkey AS u FROM customer WHERE c_nationkey > 5),
counts AS (SELECT o_custkey AS k, count(*) AS n, count(DISTINCT CASE WHEN l_returnflag = 'R' THEN l_partkey END) AS d FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1)
SELECT k::VARCHAR AS bbl, CASE WHEN unexpired AND u > 0 THEN 'hpd_unexpired_pluto_residential' WHEN unexpired THEN 'hpd_unexpired_no_positive_pluto_count' WHEN unexpired IS NOT NULL AND u > 0 THEN 'hpd_expired_pluto_residential' WHEN u > 0 THEN 'pluto_residential_not_hpd_unexpired' ELSE 'hpd_only_no_pluto_lot' END AS membership_status, u AS units_res, coalesce(n, 0) AS unit_claims, coalesce(d, 0) AS official_units
FROM (SELECT k FROM hpd UNION SELECT k FROM lots) LEFT JOIN hpd USING (k) LEFT JOIN lots USING (k) LEFT JOIN counts USING (k)
"""


@query(E16_SQL)
def e16_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders")
    regs = o.select(c("o_custkey").cast("string").alias("bbl"), dates.timing(F.date_format("o_orderdate", "yyyy-MM-dd"), "1998-01-01").alias("timing"))
    b = read(spark, sf_dir, "customer").select(c("c_custkey").cast("string").alias("bbl"), F.when(c("c_nationkey") > 5, c("c_nationkey")).alias("units_res"))
    l = read(spark, sf_dir, "lineitem").select(c("l_orderkey").alias("o_orderkey"), "l_partkey", "l_returnflag")  # noqa: E741
    claims = o.join(l, "o_orderkey").select(c("o_custkey").cast("string").alias("bbl"), c("l_partkey").alias("unit_id"), F.when(c("l_returnflag") == "R", "source_document").otherwise("other").alias("grade"))
    return coverage.registration_coverage(regs, b, claims)


@query("SELECT o_custkey % 100 AS portfolio, count(*) AS building_count, count(DISTINCT nullif(name, '')) AS llc_count, CAST(sum(coalesce(v, 0)) AS BIGINT) AS total_violations, coalesce(arg_max(name, {'n': n, 'f': -f}) FILTER (WHERE name <> ''), '(unknown owner)') AS canonical_name FROM (SELECT *, count(*) OVER (PARTITION BY o_custkey % 100, name) AS n, min(o_orderkey) OVER (PARTITION BY o_custkey % 100, name) AS f FROM (SELECT o_custkey, o_orderkey, CASE WHEN o_orderkey % 3 > 0 THEN o_orderpriority ELSE '' END AS name, CASE WHEN o_orderkey % 4 > 0 THEN o_orderkey % 10 END AS v FROM orders)) GROUP BY 1")
def e08_portfolio(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = c("o_orderkey")
    b = read(spark, sf_dir, "orders").select(k.cast("string").alias("bbl"), k.alias("position"), F.when(k % 3 > 0, c("o_orderpriority")).otherwise("").alias("owner_name"), F.concat((c("o_custkey") % 100).cast("string"), F.lit(" Broad Street, Suite 5")).alias("owner_business_address"), F.when(k % 4 > 0, k % 10).alias("violations"))
    p, _ = portfolios.build_portfolios(b)
    return p.select(F.element_at(F.split("business_address", " "), 1).cast("long").alias("portfolio"), "building_count", "llc_count", "total_violations", "canonical_name")


@query("SELECT o_custkey % 1000 AS portfolio, count(*) AS building_count FROM orders GROUP BY 1 HAVING count(*) > 1 ORDER BY 2 DESC, concat('pf_', substr(sha1(concat(o_custkey % 1000, ' BROAD ST STE 5')), 1, 16)) LIMIT 10")
def o03_largest_portfolios(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = read(spark, sf_dir, "orders").select(c("o_orderkey").cast("string").alias("bbl"), c("o_orderkey").alias("position"), F.lit("x").alias("owner_name"), F.concat((c("o_custkey") % 1000).cast("string"), F.lit(" Broad Street, Suite 5")).alias("owner_business_address"))
    p, _ = portfolios.build_portfolios(b)
    return portfolios.largest(p, 10).select(F.element_at(F.split("business_address", " "), 1).cast("long").alias("portfolio"), "building_count")


D01_SQL = """
WITH cur AS (SELECT user_id AS id, arg_max(value, {'t': ts, 'e': event_id}) AS price FROM events WHERE event_id % 2 = 0 OR user_id % 3 = 0 GROUP BY 1),
inc AS (SELECT user_id AS id, arg_max(value, {'t': ts, 'e': event_id}) AS price FROM events WHERE event_id % 2 = 1 AND user_id % 3 > 0 GROUP BY 1)
SELECT coalesce(cur.id, inc.id)::VARCHAR AS source_id, CASE WHEN inc.id IS NOT NULL AND inc.id % 5 > 0 THEN inc.price ELSE cur.price END AS price, CASE WHEN cur.id IS NULL THEN '2026-01-02 00:00:00' ELSE '2026-01-01 00:00:00' END AS first_seen, CASE WHEN inc.id IS NULL THEN '2026-01-01 00:00:00' ELSE '2026-01-02 00:00:00' END AS last_seen, CASE WHEN inc.id IS NULL THEN 'inactive' ELSE 'active' END AS status, CASE WHEN cur.id IS NULL THEN 'new' WHEN inc.id IS NULL THEN 'inactive' ELSE 'updated' END AS action
FROM cur FULL JOIN inc ON cur.id = inc.id
UNION ALL SELECT 'other', 1.0, '2026-01-01 00:00:00', '2026-01-01 00:00:00', 'active', 'kept'
"""


@query(D01_SQL)
def d01_snapshot_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "events").select(c("user_id"), c("value").alias("price"), c("event_id"), F.struct("ts", "event_id").alias("arrival"))
    old = F.lit("2026-01-01 00:00:00")
    mine = keys.last_wins(e.where("event_id % 2 = 0 OR user_id % 3 = 0"), ["user_id"], "arrival").select(F.lit("a").alias("source"), c("user_id").cast("string").alias("source_id"), "price")
    other = spark.createDataFrame([("b", "other", 1.0)], "source string, source_id string, price double")
    current = mine.union(other).withColumns({"first_seen": old, "last_seen": old, "status": F.lit("active")})
    incoming = e.where("event_id % 2 = 1 AND user_id % 3 > 0").select(c("user_id").cast("string").alias("source_id"), "price", (c("user_id") % 5 > 0).alias("has_price"), "arrival")
    out = upsert.snapshot_merge(current, incoming, "a", "2026-01-02 00:00:00", ["price"], {"price": "has_price"})
    return out.select("source_id", "price", "first_seen", "last_seen", "status", "action")


@query("SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN (CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE 'NEW' END) ELSE c_mktsegment END AS segment, CASE WHEN c_custkey % 3 = 0 THEN c_acctbal + 1 ELSE c_acctbal END AS balance FROM customer")
def d03_partial_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    cu, k = read(spark, sf_dir, "customer"), c("c_custkey")
    current = cu.select("c_custkey", c("c_mktsegment").alias("segment"), c("c_acctbal").alias("balance"))
    incoming = cu.where((k % 2 == 0) | (k % 3 == 0)).select("c_custkey", F.when(k % 4 != 0, F.lit("NEW")).alias("segment"), (c("c_acctbal") + 1).alias("balance"), (k % 2 == 0).alias("has_segment"), (k % 3 == 0).alias("has_balance"))
    return upsert.partial_upsert(current, incoming, "c_custkey", ["segment", "balance"], {"segment": "has_segment", "balance": "has_balance"})


@query("SELECT user_id::VARCHAR AS bbl, event_type, d AS event_date, detail, count(*) AS n FROM (SELECT DISTINCT ON (user_id, event_type, d, coalesce(detail, '')) user_id, event_type, d, nullif(coalesce(detail, ''), '') AS detail FROM (SELECT user_id, event_type, strftime(ts, '%Y-%m-%d') AS d, CASE WHEN event_id % 4 = 0 THEN NULL WHEN event_id % 4 = 1 THEN '' ELSE 'x' END AS detail, event_id FROM events WHERE event_id % 6 > 0)) GROUP BY ALL UNION ALL SELECT user_id::VARCHAR, event_type, NULL, CASE WHEN event_id % 4 < 2 THEN NULL ELSE 'x' END, count(*) FROM events WHERE event_id % 6 = 0 GROUP BY ALL")
def d04_event_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = c("event_id")
    e = read(spark, sf_dir, "events").select(c("user_id").cast("string").alias("bbl"), "event_type", F.when(k % 6 > 0, F.date_format("ts", "yyyy-MM-dd")).alias("event_date"), F.lit("s").alias("source"), F.when(k % 4 == 1, "").when(k % 4 > 1, "x").alias("detail"), k.alias("arrival"))
    out = upsert.add_events(e.limit(0), e)
    return out.groupBy("bbl", "event_type", "event_date", X.filled(c("detail")).alias("detail")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT lang AS unit_id FROM documents WHERE source <> 'src0' AND doc_id % 50 > 0 GROUP BY lang UNION SELECT CONCAT(source, '-only') FROM documents WHERE source NOT IN ('src0') GROUP BY source")
def d13_demote(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read(spark, sf_dir, "documents")
    obs = d.select(c("doc_id").cast("string").alias("observation_id"), F.when(c("source") == "src0", '["Text_Mined"]').otherwise('["permits"]').alias("raw_fields"))
    a = d.select(c("doc_id").cast("string").alias("observation_id"), F.lit("unit").alias("entity_type"), F.when(c("doc_id") % 50 > 0, c("lang")).otherwise(F.concat("source", F.lit("-only"))).alias("entity_id"), F.lit("resolved").alias("status"), F.lit(1.0).alias("confidence"))
    b = a.where("entity_id NOT LIKE '%only'").union(d.select(c("doc_id").cast("string"), F.lit("unit"), F.concat("source", F.lit("-only")), F.lit("resolved"), F.lit(1.0)))
    all_units = b.select(c("entity_id").alias("unit_id")).distinct()
    return upsert.demote(b, all_units, obs)[1]


E11_SQL = """
WITH x AS (SELECT o_orderkey, o_custkey % 20 AS label, list_distinct(list(l_suppkey % 50)) AS bbls FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY ALL),
e AS (SELECT c_custkey % 50 AS bbl, c_custkey % 20 AS label FROM customer GROUP BY ALL),
h AS (SELECT o_orderkey, count(*) AS n, min(e.bbl) AS bbl FROM (SELECT o_orderkey, label, unnest(bbls) AS bbl FROM x) y JOIN e ON e.bbl = y.bbl AND e.label = y.label GROUP BY o_orderkey)
SELECT o_orderkey, CASE WHEN label = 0 THEN 'skipped' WHEN n = 1 THEN 'resolved' ELSE 'ambiguous' END AS outcome, CASE WHEN label > 0 AND n = 1 THEN h.bbl::VARCHAR END AS bbl FROM x LEFT JOIN h USING (o_orderkey)
"""


@query(E11_SQL)
def e11_corroborate(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    l = read(spark, sf_dir, "lineitem").select(c("l_orderkey").alias("o_orderkey"), (c("l_suppkey") % 50).cast("string").alias("bbl"))  # noqa: E741
    label = lambda k: F.when(k % 20 == 0, F.lit("Roof")).otherwise(F.concat(F.lit("Apt "), (k % 20).cast("string")))
    listings = o.join(l, "o_orderkey").groupBy("o_orderkey", "o_custkey").agg(F.collect_set("bbl").alias("bbls")).select(c("o_orderkey").alias("observation_id"), F.lit("5 Main Street").alias("address"), label(c("o_custkey")).alias("unit_label"), "bbls")
    cu = read(spark, sf_dir, "customer").select((c("c_custkey") % 50).cast("string").alias("bbl"), X.normalize_unit(label(c("c_custkey"))).alias("normalized_unit"), c("c_custkey").cast("string").alias("source_ref"))
    evidence = cu.select("bbl", "normalized_unit", F.lit("5 MAIN ST").alias("address"), ids.catalog_id("unit", c("bbl"), c("normalized_unit")).alias("unit_id"), "source_ref", F.concat(F.lit("obs_"), "source_ref").alias("observation_id"))
    return reconcile.corroborate(listings, evidence).select(c("observation_id").alias("o_orderkey"), "outcome", "bbl")


@query("SELECT lang AS zipcode FROM documents WHERE doc_id % 2 = 0 GROUP BY lang ORDER BY lang")
def e18_listing_zips(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read(spark, sf_dir, "documents").select(F.when(c("doc_id") % 2 == 0, F.concat(F.lit(" "), "lang")).otherwise(" ").alias("zipcode"), F.lit("active").alias("status"))
    return coverage.listing_zips(d)


@query("SELECT 'customers' AS metric, count(*) AS n FROM customer UNION ALL SELECT 'orders', count(*) FROM orders UNION ALL SELECT 'events', count(*) FROM events")
def e17_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage.catalog_status(customers=read(spark, sf_dir, "customer"), orders=read(spark, sf_dir, "orders"), events=read(spark, sf_dir, "events"))


@query("SELECT a.c_custkey::VARCHAR AS bbl, a.norm AS norm_address FROM (SELECT min(c_custkey) AS c_custkey, concat(1 + c_nationkey, ' MAIN ST') AS norm, c_custkey FROM customer GROUP BY ALL) a")
def e01_crosswalk(spark: SparkSession, sf_dir: str) -> DataFrame:
    lots = read(spark, sf_dir, "customer").select(F.concat((F.lit(1_000_000_000) + c("c_custkey")).cast("string"), F.lit(".0")).alias("bbl"), F.concat((c("c_nationkey") + 1).cast("string"), F.lit(" Main  Street #4")).alias("address"), F.lit("BRONX").alias("borough"), F.lit("10001").alias("zipcode"), c("c_custkey").alias("arrival"))
    out = resolve.crosswalk_from_lots(lots.union(lots))
    return out.select((c("bbl").cast("long") - 1_000_000_000).cast("string").alias("bbl"), "norm_address")


@query("SELECT l_orderkey, l_linenumber, CASE WHEN b IS NULL THEN 'unresolved' WHEN p_size % 4 = 0 THEN 'not_a_dwelling' WHEN p_size % 4 = 1 THEN 'unresolved' ELSE 'resolved' END AS status, CASE WHEN b IS NOT NULL AND p_size % 4 > 1 THEN concat('unit_', substr(sha256(concat(b, '\\x1f', 'B', p_partkey)), 1, 20)) END AS unit_id, CASE WHEN b IS NOT NULL AND p_size % 4 > 1 THEN 1e0 ELSE 0e0 END AS confidence FROM (SELECT *, CASE WHEN l_suppkey % 7 BETWEEN 1 AND 5 THEN printf('%d%05d%04d', l_suppkey % 7, l_orderkey, l_suppkey) END AS b FROM lineitem JOIN part ON p_partkey = l_partkey)")
def e09_unit_ladder(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read(spark, sf_dir, "lineitem").join(read(spark, sf_dir, "part").select("p_partkey", "p_size"), c("l_partkey") == c("p_partkey"))
    text = lambda x: x.cast("string")
    bbl = ids.assembled_bbl(text(c("l_suppkey") % 7), text(c("l_orderkey")), text(c("l_suppkey")))
    s = c("p_size") % 4
    label = F.when(s == 0, " roof").when(s == 1, " - ").otherwise(F.concat(F.lit("Apt b"), text(c("p_partkey"))))
    d = importers.with_unit_claim(d, bbl, label, importers.SOURCES["hpd_violations"])
    return d.select("l_orderkey", "l_linenumber", "unit.status", "unit.unit_id", "unit.confidence")


@query("SELECT o_orderkey, observed_at, price, CASE WHEN observed_at = last_day THEN 'source_document' ELSE 'legacy_snapshot' END AS grade FROM (SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS last_day, coalesce(strftime(h.d, '%Y-%m-%d'), strftime(o_orderdate, '%Y-%m-%d')) AS observed_at, coalesce(h.p, o_totalprice) AS price FROM orders LEFT JOIN (SELECT l_orderkey, l_extendedprice AS p, l_shipdate AS d FROM lineitem WHERE l_returnflag = 'R') h ON h.l_orderkey = o_orderkey)")
def e20_listing_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = lambda x: F.date_format(x, "yyyy-MM-dd")
    none = F.lit(None)
    o = read(spark, sf_dir, "orders").select(F.lit("s").alias("source"), c("o_orderkey").cast("string").alias("source_id"), F.lit("5 Main Street").alias("address"), F.lit("6B").alias("unit_number"), none.cast("double").alias("bedrooms"), none.cast("double").alias("bathrooms"), c("o_totalprice").alias("price"), F.lit("active").alias("status"), F.concat(day("o_orderdate"), F.lit(" 00:00:00")).alias("last_seen"), none.cast("string").alias("zipcode"))
    h = read(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").select(F.lit("s").alias("source"), c("l_orderkey").cast("string").alias("source_id"), day("l_shipdate").alias("snapshot_date"), c("l_extendedprice").alias("price"), F.lit("active").alias("status"))
    out = importers.listing_observations(o, h, _index(spark, sf_dir))
    return out.select(c("source_id").cast("long").alias("o_orderkey"), "observed_at", "price", "grade")


@query("SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 OR c_custkey % 3 = 0 THEN 'NEW' ELSE c_name END AS address, CASE WHEN c_custkey % 2 = 0 OR c_custkey % 3 = 0 THEN NULL ELSE c_mktsegment END AS zipcode, CASE WHEN c_custkey % 3 = 0 THEN 'nyc_pad' ELSE 'record_db' END AS source FROM customer")
def d09_address_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = c("c_custkey")
    d = read(spark, sf_dir, "customer").select(k.cast("string").alias("bbl"), F.lit("n").alias("normalized"), c("c_name").alias("address"), c("c_mktsegment").alias("zipcode"), F.lit("record_db").alias("source"), "c_custkey")
    new = d.where((k % 2 == 0) | (k % 3 == 0)).select("bbl", "normalized", F.lit("NEW").alias("address"), F.lit(None).cast("string").alias("zipcode"), F.lit("nyc_pad").alias("source"), F.lit(1).alias("arrival"))
    out = upsert.address_upsert(d.where(k % 3 > 0).drop("c_custkey"), new)
    return out.select(c("bbl").cast("long").alias("c_custkey"), "address", "zipcode", "source")


@query("SELECT user_id::VARCHAR AS bbl, event_type AS normalized_unit, arg_min(event_id, {'t': ts, 'e': event_id})::VARCHAR AS unit_id, arg_max(event_id, {'t': ts, 'e': event_id})::VARCHAR AS unit_label, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS first_seen, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS last_seen FROM events GROUP BY ALL")
def d10_unit_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    d = read(spark, sf_dir, "events").withColumn("arrival", F.row_number().over(W.partitionBy("user_id").orderBy("ts", "event_id")).cast("long"))
    d = d.select(c("user_id").cast("string").alias("bbl"), c("event_type").alias("normalized_unit"), c("event_id").cast("string").alias("unit_id"), c("event_id").cast("string").alias("unit_label"), at.alias("first_seen"), at.alias("last_seen"), "arrival")
    return upsert.unit_upsert(d.limit(0).drop("arrival"), d, ["bbl", "normalized_unit"], "unit_id", "unit_label")


@query("SELECT user_id::VARCHAR AS observation_id, arg_max(event_type, {'t': ts, 'e': event_id}) AS status, 'unit' AS entity_type FROM events GROUP BY user_id")
def d07_match_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read(spark, sf_dir, "events").select(c("user_id").cast("string").alias("observation_id"), F.lit("unit").alias("entity_type"), c("event_type").alias("status"), F.struct("ts", "event_id").alias("pass_no"))
    return upsert.match_upsert(d.where("pass_no.event_id % 2 = 0"), d.where("pass_no.event_id % 2 = 1")).select("observation_id", "entity_type", "status")


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN '5 MAIN ST' WHEN o_orderkey % 3 = 1 THEN '5 MAIN ST, 9' ELSE concat(o_orderkey, ' MAIN ST') END AS sale, CASE WHEN o_orderkey % 3 = 0 THEN '211 W 10th St' WHEN o_orderkey % 3 = 1 THEN '622 Avenue B' ELSE '7 Oak Road' END AS street, CASE WHEN o_orderkey % 3 = 0 THEN concat(o_orderkey % 10, 'B') END AS unit FROM orders")
def f20_split_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = c("o_orderkey") % 3
    u = (c("o_orderkey") % 10).cast("string")
    sale = F.when(k == 0, F.concat(F.lit("5 MAIN ST, Apt "), u, F.lit("B"))).when(k == 1, "5 MAIN ST, 9").otherwise(F.concat(c("o_orderkey").cast("string"), F.lit(" MAIN ST")))
    mls = F.when(k == 0, F.concat(F.lit("211 W 10th St "), u, F.lit("b, New York"))).when(k == 1, "622 Avenue B, New York").otherwise("7 Oak Road")
    split = X.split_mls_address(mls, F.lit(None).cast("string"))
    d = read(spark, sf_dir, "orders")
    return d.select("o_orderkey", X.sale_address(sale, F.when(k == 0, F.concat(u, F.lit("b"))).otherwise("1")).alias("sale"), split["street"].alias("street"), split["unit"].alias("unit"))
