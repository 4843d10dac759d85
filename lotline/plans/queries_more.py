"""Operators and functions that the other modules of queries leave out, over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotline.functions import dates, documents, ids, numbers
from lotline.functions import text as X
from lotline.operators import coverage, enrich, export, importers, keys, merges, portfolios, resolve, rollup, units, upsert
from lotline.plans.catalog import query, read
from lotline.plans.queries_entities import DOC_UNITS_SQL, INDEX_SQL, LOOKUP_SQL, M02_SQL, _doc_units, _index, _lookups, _routed
from lotline.session import scratch
from lotline.sources import landing
from lotline.streaming import incremental

c = F.col
text = lambda x: x.cast("string")
NOW = "2026-01-02 00:00:00"


# Functions.


@query("SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN (c_custkey % 5)::VARCHAR WHEN 1 THEN concat(c_custkey % 5, '.5') ELSE '' END AS beds FROM customer")
def f04_beds_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = c("c_custkey")
    raw = F.when(k % 4 == 0, F.concat(text(k % 5), F.lit(".0"))).when(k % 4 == 1, F.concat(text(k % 5), F.lit(".50"))).when(k % 4 == 2, "studio")
    return read(spark, sf_dir, "customer").select("c_custkey", X.beds_key(raw).alias("beds"))


@query("SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 AND c_custkey % 2 = 0 THEN NULL WHEN c_custkey % 3 = 0 THEN c_mktsegment WHEN c_custkey % 2 = 0 THEN c_nationkey::VARCHAR ELSE concat(c_nationkey, ' ', c_mktsegment) END AS street, CASE WHEN c_custkey % 2 = 0 THEN 'Corp' ELSE concat('Ann ', c_mktsegment) END AS owner FROM customer")
def f17_street_address(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = c("c_custkey")
    number, street = F.when(k % 3 > 0, F.concat(F.lit(" "), text(c("c_nationkey")))).otherwise(" "), F.when(k % 2 > 0, F.concat(c("c_mktsegment"), F.lit("  ")))
    return read(spark, sf_dir, "customer").select("c_custkey", X.street_address(number, street).alias("street"), X.owner_name(F.when(k % 2 == 0, "Corp").otherwise(""), F.lit("Ann"), c("c_mktsegment")).alias("owner"))


@query("SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN concat(c_nationkey, ' Broad St #5, NY 1') WHEN c_custkey % 3 = 1 THEN concat(c_nationkey, ' Broad St') ELSE 'City NY 1' END AS office FROM customer")
def f18_office_address(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = c("c_custkey") % 3
    some = lambda on, x: F.when(on, x).otherwise("")
    return read(spark, sf_dir, "customer").select("c_custkey", X.office_address(some(k < 2, text(c("c_nationkey"))), some(k < 2, F.lit("Broad St")), some(k == 0, F.lit("5")), some(k == 2, F.lit("City")), some(k != 1, F.lit("NY")), some(k != 1, F.lit("1"))).alias("office"))


@query("SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN '5 Oak St' ELSE p_name END AS street, CASE p_partkey % 3 WHEN 0 THEN concat(p_size, 'A') END AS unit, CASE WHEN p_size % 2 = 0 THEN '11201' END AS zipcode FROM part")
def f22_split_trailing_unit(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, s = c("p_partkey"), c("p_size")
    raw = F.when(k % 3 == 0, F.concat(F.lit("5 Oak St, apt. "), text(s), F.lit("A"))).when(k % 3 == 1, c("p_name")).otherwise(F.concat(c("p_name"), F.lit(" ")))
    d = X.split_trailing_unit(raw)
    return read(spark, sf_dir, "part").select("p_partkey", d["street"].alias("street"), d["unit"].alias("unit"), X.trailing_zip(F.when(s % 2 == 0, "Brooklyn, NY 11201-0001").otherwise("11201 Brooklyn")).alias("zipcode"))


@query("SELECT page_id, trim(regexp_replace(regexp_replace(html, '<[^>]+>', ' ', 'g'), '[\\s\\p{Z}\\x0B\\x1C-\\x1F\\x85]+', ' ', 'g')) AS text FROM pages")
def f30_strip_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "pages").select("page_id", X.strip_tags(c("html")).alias("text"))


@query("SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN 'N,W' WHEN 1 THEN c_mktsegment END AS lines, CASE WHEN c_custkey % 2 = 0 THEN lower(c_mktsegment) ELSE '' END AS label FROM customer")
def f31_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = c("c_custkey")
    return read(spark, sf_dir, "customer").select("c_custkey", X.routes(F.when(k % 3 == 0, " N  W ").when(k % 3 == 1, c("c_mktsegment")).otherwise(" ")).alias("lines"), X.source_label(F.when(k % 2 == 0, F.concat(F.lit('["'), c("c_mktsegment"), F.lit('"]'))).otherwise("[]")).alias("label"))


@query("SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS at, strftime(o_orderdate + INTERVAL 180 DAY, '%Y-%m-%d') AS horizon FROM orders")
def f44_horizon(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "orders").select("o_orderkey", dates.timestamp_text(c("o_orderdate")).alias("at"), dates.horizon(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("horizon"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 0e0 ELSE round((o_orderkey % 7) / (o_orderkey % 3), 6) END AS share, o_orderkey / 100.0e0 AS dollars FROM orders")
def f59_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = c("o_orderkey")
    return read(spark, sf_dir, "orders").select("o_orderkey", numbers.ratio(k % 7, k % 3, 6).alias("share"), numbers.dollars(k).alias("dollars"))


@query("SELECT c_custkey, CASE WHEN c_custkey % 3 > 0 THEN (2000 + c_custkey % 100)::INTEGER ELSE (1000 + c_custkey % 50)::INTEGER END AS price FROM customer")
def f58_term_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = c("c_custkey")
    term = lambda name, price: F.struct(name.alias("term"), price.cast("int").alias("price"))
    terms = F.array(term(F.lit("6 months"), 1500 + k), term(F.when(k % 3 > 0, "12 months").otherwise("18 months"), F.when(k % 3 > 0, 2000 + k % 100).otherwise(1000 + k % 50)))
    return read(spark, sf_dir, "customer").select("c_custkey", numbers.term_price(terms).alias("price"))


@query("SELECT c_custkey, concat('{\"c_mktsegment\":\"', c_mktsegment, '\",\"c_nationkey\":', c_nationkey, ',\"none\":null}') AS payload, concat('[{\"term\":\"6 months\",\"price\":', c_custkey, '},{\"term\":\"12 months\",\"price\":', c_nationkey, '}]') AS terms, CASE WHEN c_custkey % 2 = 0 THEN concat('[\"u', c_custkey, '\"]') END AS images FROM customer")
def f61_json_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = c("c_custkey")
    d = read(spark, sf_dir, "customer").withColumn("none", F.lit(None).cast("string"))
    rates = F.create_map(F.lit("12"), c("c_nationkey"), F.lit("6"), k)
    images = F.array(F.struct(F.when(k % 2 == 0, F.concat(F.lit("u"), text(k))).alias("url")), F.struct(F.lit("").alias("url")), F.struct(F.when(k % 2 == 0, "more").alias("url")))
    return d.select("c_custkey", documents.canonical_json(["none", "c_nationkey", "c_mktsegment"]).alias("payload"), F.to_json(documents.rate_terms(rates)).alias("terms"), documents.image_urls(images, 1).alias("images"))


@query("SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN c_mktsegment WHEN c_custkey % 3 = 1 THEN c_name ELSE NULL END AS day FROM customer")
def p29_first_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = c("c_custkey") % 3
    return read(spark, sf_dir, "customer").select("c_custkey", X.first_date(F.when(k == 0, c("c_mktsegment")), F.when(k == 1, c("c_name")).otherwise("")).alias("day"))


@query("SELECT p_partkey, p_size % 4 IN (0, 1) AS filings, p_size % 4 IN (0, 2) AS archive FROM part")
def p17_extra_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = c("p_size") % 4
    label = F.when(s == 0, "storage").when(s == 1, " n/a").when(s == 2, "Finishes").otherwise("5")
    return read(spark, sf_dir, "part").select("p_partkey", importers.not_a_dwelling(label, X.NOT_DWELLINGS_EXTRA_FILINGS).alias("filings"), importers.not_a_dwelling(label, X.NOT_DWELLINGS_EXTRA_ARCHIVE).alias("archive"))


# Keys, upserts and tables.


@query("SELECT c_custkey AS id, CASE WHEN c_custkey % 2 = 0 THEN c_name ELSE 'new' END AS name FROM customer UNION ALL SELECT -1, 'new'")
def k01_insert_or_ignore(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read(spark, sf_dir, "customer").select(c("c_custkey").alias("id"), c("c_name").alias("name"))
    new = d.select("id", F.lit("new").alias("name"), F.lit(1).alias("arrival"))
    more = new.union(new.select("id", F.lit("later"), F.lit(2))).union(spark.createDataFrame([(-1, "new", 1)], "id long, name string, arrival int"))
    return keys.insert_or_ignore(d.where("id % 2 = 0"), more, ["id"], "arrival").select("id", "name")


@query("SELECT c_custkey AS id, CASE WHEN c_custkey % 2 = 0 THEN 'later' ELSE c_name END AS name FROM customer")
def k03_insert_or_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read(spark, sf_dir, "customer").select(c("c_custkey").alias("id"), c("c_name").alias("name"))
    new = d.where("id % 2 = 0").select("id", F.lit("new").alias("name"), F.lit(1).alias("arrival"))
    return keys.insert_or_replace(d, new.union(new.select("id", F.lit("later"), F.lit(2))), ["id"], "arrival").select("id", "name")


@query("SELECT c_mktsegment AS source, count(*) AS listings_count, count(*) FILTER (WHERE c_custkey % 3 = 0) AS new_count, count(*) FILTER (WHERE c_custkey % 3 > 0) AS updated_count FROM customer WHERE c_mktsegment = 'BUILDING' GROUP BY 1")
def k13_pull_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read(spark, sf_dir, "customer").select(c("c_mktsegment").alias("source"), F.when(c("c_custkey") % 3 == 0, "new").otherwise("updated").alias("action"))
    return upsert.pull_log(d, "BUILDING", NOW).drop("pulled_at")


@query("SELECT user_id::VARCHAR AS source_id, arg_max(value, {'t': ts, 'e': event_id}) AS price, '2026-01-02' AS snapshot_date FROM events GROUP BY user_id")
def w06_history_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read(spark, sf_dir, "events").select(text(c("user_id")).alias("source_id"), c("value").alias("price"), F.lit(None).cast("string").alias("lease_terms"), F.struct("ts", "event_id").alias("arrival"))
    return upsert.history_rows(d, "s", "2026-01-02").select("source_id", "price", "snapshot_date")


@query("SELECT s_suppkey, s_name, NULL::DOUBLE AS price, NULL::VARCHAR AS note FROM supplier")
def d15_schema_evolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return upsert.with_columns_of(read(spark, sf_dir, "supplier").select("s_suppkey", "s_name"), {"s_name": "string", "price": "double", "note": "string"})


@query("SELECT c_custkey AS bbl, CASE WHEN c_custkey % 2 = 0 THEN c_nationkey END::BIGINT AS dist, CASE WHEN c_custkey % 2 = 0 THEN '2026-01-02 00:00:00' ELSE 'old' END AS last_seen FROM customer")
def d05_enrichment_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read(spark, sf_dir, "customer").select(c("c_custkey").alias("bbl"), c("c_nationkey").alias("dist"))
    current = d.select("bbl", F.lit(None).cast("long").alias("dist"), F.lit("old").alias("first_seen"), F.lit("old").alias("last_seen"))
    return upsert.partial_upsert(current, d.where("bbl % 2 = 0").withColumn("has", F.lit(True)), "bbl", ["dist"], {"dist": "has"}, NOW).select("bbl", "dist", "last_seen")


@query("SELECT user_id::VARCHAR AS premise, event_type AS unit, arg_min(event_id, event_id)::VARCHAR AS unit_id, arg_min(event_id, event_id)::VARCHAR AS label, max(strftime(ts, '%Y-%m-%d')) AS last_seen FROM events GROUP BY ALL")
def d11_kept_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.date_format("ts", "yyyy-MM-dd")
    d = read(spark, sf_dir, "events").select(text(c("user_id")).alias("premise"), c("event_type").alias("unit"), text(c("event_id")).alias("unit_id"), text(c("event_id")).alias("label"), day.alias("first_seen"), day.alias("last_seen"), c("event_id").alias("arrival"))
    return upsert.unit_upsert(d.limit(0).drop("arrival"), d, ["premise", "unit"], "unit_id", "label", keep_label=True).drop("first_seen")


# Joins, reports and exports.


@query(f"SELECT doc_id FROM ({DOC_UNITS_SQL}) WHERE n = 1")
def j03_canonical_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return units.canonical_listings(_doc_units(spark, sf_dir)).select("doc_id")


@query("SELECT event_id::VARCHAR AS observation_id, concat('u', user_id) AS unit_id, value AS price, 0.5e0 AS resolution_confidence FROM events WHERE event_id % 3 = 0 AND event_id % 2 = 0")
def j16_unit_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = c("event_id")
    e = read(spark, sf_dir, "events")
    m = e.select(text(k).alias("observation_id"), F.when(k % 2 == 0, "unit").otherwise("building").alias("entity_type"), F.when(k % 3 == 0, "resolved").otherwise("unresolved").alias("status"), F.concat(F.lit("u"), text(c("user_id"))).alias("entity_id"), F.lit(0.5).alias("confidence"), F.lit("m").alias("method"), F.lit(NOW).alias("matched_at"))
    none = F.lit(None).cast("string")
    o = e.select(text(k).alias("observation_id"), c("value").alias("price"), *[none.alias(n) for n in ("source", "source_ref", "observed_at", "observation_kind", "address", "unit_label", "bedrooms", "bathrooms", "status", "evidence_grade")])
    return export.unit_observations(m, o).select("observation_id", "unit_id", "price", "resolution_confidence")


@query("SELECT c_custkey::VARCHAR AS bbl, n_name AS area FROM customer LEFT JOIN (SELECT *, concat('36061', lpad(n_nationkey::VARCHAR, 6, '0')) AS geoid FROM nation) ON geoid = CASE WHEN c_custkey % 9 > 0 THEN concat('36061', lpad(c_nationkey::VARCHAR, 6, '0')) END")
def j26_by_area(spark: SparkSession, sf_dir: str) -> DataFrame:
    areas = read(spark, sf_dir, "nation").select(F.concat(F.lit("36061"), F.lpad(text(c("n_nationkey")), 6, "0")).alias("geoid"), c("n_name").alias("area"))
    b = read(spark, sf_dir, "customer").select(text(c("c_custkey")).alias("id"), F.lit("1000010001").alias("bbl"), F.when(c("c_custkey") % 9 > 0, text(c("c_nationkey"))).otherwise("?").alias("census_tract"))
    return enrich.by_area(b, areas).select(c("id").alias("bbl"), "area")


@query("SELECT c_custkey::VARCHAR AS source_ref, lower(c_mktsegment) AS source FROM customer WHERE c_custkey % 3 > 0")
def j27_classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = c("c_custkey")
    d = read(spark, sf_dir, "customer")
    archive = d.select(text(k).alias("unit_id"), F.when(k % 3 == 0, merges.SYNTHETIC).otherwise(F.concat(F.lit('["'), c("c_mktsegment"), F.lit('"]'))).alias("source_systems"))
    return merges.classified(d.select(text(k).alias("source_ref"), F.lit("archive").alias("source")), archive).select("source_ref", "source")


@query(f"SELECT b.c_custkey, s.s_name AS building FROM (SELECT l.c_custkey, coalesce((SELECT min(bbl::VARCHAR) FROM ({INDEX_SQL}) i WHERE i.a = l.a AND i.z = l.z), (SELECT min(bbl::VARCHAR) FROM ({INDEX_SQL}) i WHERE i.a = l.a)) AS bbl FROM ({LOOKUP_SQL}) l) b JOIN supplier s ON s.s_suppkey::VARCHAR = b.bbl")
def j29_proof(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = resolve.first_bbl(_lookups(spark, sf_dir), _index(spark, sf_dir).withColumnRenamed("normalized", "norm_address"))
    facts = read(spark, sf_dir, "supplier").select(text(c("s_suppkey")).alias("bbl"), c("s_name").alias("building"))
    return found.join(facts, "bbl").select("c_custkey", "building")


@query("SELECT DISTINCT c_custkey::VARCHAR AS bbl FROM customer WHERE c_custkey NOT IN (SELECT s_suppkey FROM supplier)")
def e23_missing_buildings(spark: SparkSession, sf_dir: str) -> DataFrame:
    cu = read(spark, sf_dir, "customer").select(text(c("c_custkey")).alias("bbl"))
    return resolve.missing_buildings(cu.union(cu), read(spark, sf_dir, "supplier").select(text(c("s_suppkey")).alias("bbl")))


@query("SELECT concat('1', lpad(s_suppkey::VARCHAR, 5, '0'), '0001') AS bbl, concat(h, ' MAIN ST') AS norm_address, 'MANHATTAN' AS borough FROM (SELECT s_suppkey, unnest(CASE WHEN s_suppkey % 2 = 0 THEN generate_series(s_suppkey + 1, s_suppkey + 5, 2) ELSE generate_series(s_suppkey + 1, s_suppkey + 4) END) AS h FROM supplier WHERE s_suppkey % 3 > 0) WHERE h <> 9")
def e02_crosswalk_from_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = c("s_suppkey")
    rows = read(spark, sf_dir, "supplier").select(F.lit("1").alias("boro"), text(k).alias("block"), F.lit("1").alias("lot"), text(k + 1).alias("lhnd"), text(F.when(k % 2 == 0, k + 5).otherwise(k + 4)).alias("hhnd"), F.when(k % 2 == 0, "O").otherwise("").alias("parity"), F.lit("Main Street").alias("stname"), F.when(k % 3 > 0, "").otherwise("X").alias("addrtype"), F.lit("10001").alias("zipcode"), k.alias("arrival"))
    taken = rows.select(F.lit("9 MAIN ST").alias("norm_address"), ids.file_bbl(c("boro"), c("block"), c("lot")).alias("bbl"))
    return resolve.crosswalk_from_ranges(rows.union(rows), taken).select("bbl", "norm_address", "borough")


@query("SELECT c_custkey::VARCHAR AS bbl FROM customer WHERE c_custkey % 4 > 0 AND starts_with(c_custkey::VARCHAR, '1') ORDER BY bbl LIMIT 40")
def e22_with_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = c("c_custkey")
    b = read(spark, sf_dir, "customer").select(text(k).alias("bbl"), F.when(k % 4 > 0, 40.5).alias("latitude"), F.lit(-73.9).alias("longitude"))
    return enrich.with_points(b, 1, 40).select("bbl")


@query("SELECT doc_id, concat('pf_', substr(sha1(concat('__no_address__', doc_id)), 1, 16)) AS portfolio_id FROM documents WHERE doc_id % 3 > 0")
def e08_membership(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = c("doc_id")
    b = read(spark, sf_dir, "documents").select(text(k).alias("bbl"), k.alias("position"), F.when(k % 3 > 0, "x").alias("owner_name"), F.lit(None).cast("string").alias("owner_business_address"))
    return portfolios.build_portfolios(b)[1].select(c("bbl").cast("long").alias("doc_id"), "portfolio_id")


@query("SELECT 'nothing' AS name, NULL::BIGINT AS n UNION ALL SELECT 'regions', count(*) FROM region")
def g18_optional_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    read(spark, sf_dir, "region").createOrReplaceTempView("lotline_regions")
    found = [("nothing", coverage.optional_count(spark, "lotline_no_such_table")), ("regions", coverage.optional_count(spark, "lotline_regions"))]
    return spark.createDataFrame(found, "name string, n long")


@query("SELECT n, sources, size FROM (SELECT count(*) AS n, count(DISTINCT source) AS sources, count(*)::INTEGER AS size FROM documents GROUP BY text HAVING count(*) >= 2)")
def o04_all_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = units.find_duplicates(_doc_units(spark, sf_dir), cross_source_only=False)
    return d.select("n", "sources", F.size("members").alias("size"))


@query("SELECT o_custkey, o_orderkey, 1 + row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS n FROM orders")
def w09_ordinals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each customer's sheet, numbered from 2 on."""
    return keys.ordinals(read(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate"), ["o_custkey"], ["o_orderdate", "o_orderkey"], "n", first=2).drop("o_orderdate")


@query("SELECT l_suppkey::VARCHAR AS bbl, count(*) AS sr311, max(strftime(l_shipdate, '%Y-%m-%d')) AS sr311_last, count(*) FILTER (WHERE l_linestatus = 'O') AS sr311_open FROM lineitem GROUP BY 1")
def g02_open_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lotline.sources import records

    e = read(spark, sf_dir, "lineitem").select(text(c("l_suppkey")).alias("bbl"), F.date_format("l_shipdate", "yyyy-MM-dd").alias("event_date"), F.when(c("l_linestatus") == "O", "Open").otherwise("closed").alias("party"))
    return records.rolled(e, "311")


# Merges.


@query("SELECT 'a' AS source, c_custkey::VARCHAR AS source_ref, c_name AS unit FROM customer UNION ALL SELECT 'b', s_suppkey::VARCHAR, NULL FROM supplier")
def m01_extract_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = lambda ref, unit: {"address": F.lit("x"), "unit": unit, "zip": F.lit(None).cast("string"), "source_ref": ref}
    return merges.extract_all(("a", read(spark, sf_dir, "customer"), rules(c("c_custkey"), c("c_name"))), ("b", read(spark, sf_dir, "supplier"), rules(c("s_suppkey"), F.lit(None).cast("string")))).select("source", "source_ref", "unit")


def _archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An archive of all customers' units: every third is inferred."""
    k = c("c_custkey")
    return read(spark, sf_dir, "customer").select(text(k).alias("unit_id"), F.when(k % 3 == 0, merges.SYNTHETIC).otherwise(F.concat(F.lit('["'), c("c_mktsegment"), F.lit('"]'))).alias("source_systems"))


@query(f"SELECT bbl, source_ref, lower(c_mktsegment) AS source, concat('U', CAST(source_ref AS BIGINT) % 10) AS normalized FROM ({M02_SQL}) r JOIN customer ON c_custkey = CAST(source_ref AS BIGINT) WHERE route = 'units' AND c_custkey % 3 > 0")
def m03_merge_known(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = merges.merge_known(_routed(spark, sf_dir), _archive(spark, sf_dir), "archive", NOW)
    return d.select("bbl", "source_ref", "source", c("unit_normalized").alias("normalized"))


M07_SQL = f"""
WITH r AS ({M02_SQL}), known AS (SELECT bbl FROM r WHERE route = 'units' AND CAST(source_ref AS BIGINT) % 3 > 0),
single AS (SELECT s_suppkey::VARCHAR AS bbl FROM supplier WHERE s_suppkey % 3 = 1 AND s_suppkey::VARCHAR NOT IN (SELECT bbl FROM known)),
tie AS (SELECT source_ref, min(x.bbl) AS bbl FROM (SELECT source_ref, unnest(string_split(candidate_bbls, ',')) AS bbl FROM r WHERE route = 'ambiguous') x WHERE CAST(x.bbl AS BIGINT) % 3 > 0 GROUP BY source_ref HAVING count(*) = 1),
condo AS (SELECT s_suppkey::VARCHAR AS bbl FROM supplier WHERE s_suppkey::VARCHAR NOT IN (SELECT bbl FROM known UNION ALL SELECT bbl FROM single UNION ALL SELECT bbl FROM tie))
SELECT 'routed' AS step, count(*) AS n FROM r UNION ALL SELECT 'known', count(*) FROM known UNION ALL SELECT 'single_family', count(*) FROM single UNION ALL SELECT 'tiebreak', count(*) FROM tie UNION ALL SELECT 'condo_lots', count(*) FROM condo
"""


@query(M07_SQL)
def m07_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All five steps over an archive that isn't empty; a third of the buildings has no homes, so that ties break."""
    k = c("c_custkey")
    raw = _lookups(spark, sf_dir).withColumn("label", F.when(k % 9 > 0, F.concat(F.lit("u"), text(k % 10))))
    archives = [("archive", raw, {"address": c("address"), "unit": c("label"), "zip": c("zipcode"), "source_ref": k})]
    lots = _index(spark, sf_dir).select(c("bbl").alias("unit_lot_bbl"), F.concat(F.lit("U-"), F.substring("bbl", -1, 1)).alias("unit_designation"))
    buildings = read(spark, sf_dir, "supplier").select(text(c("s_suppkey")).alias("bbl"), (c("s_suppkey") % 3).alias("units_res"), c("s_name").alias("primary_address"))
    out = merges.run(archives, _index(spark, sf_dir), lots, buildings, spark.createDataFrame([], "bbl string"), _archive(spark, sf_dir), "archive", NOW)
    return coverage.catalog_status(**out).withColumnRenamed("metric", "step")


# Landed files and runs.


@query("SELECT n_nationkey::VARCHAR AS n_nationkey, n_name FROM nation")
def s07_csv_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = scratch(spark, "csv")
    read(spark, sf_dir, "nation").coalesce(1).write.option("header", "true").csv(at)
    return landing.csv_rows(spark, at, required=["n_name"]).select("n_nationkey", "n_name")


@query("SELECT n_nationkey::VARCHAR AS a, n_name AS b, n_regionkey::VARCHAR AS c, NULL::VARCHAR AS d FROM nation")
def s09_fixed_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = scratch(spark, "csv")
    read(spark, sf_dir, "nation").coalesce(1).write.option("header", "true").csv(at)
    return landing.fixed_csv(spark, at, ["a", "b", "c", "d"])


@query("SELECT o_orderkey::VARCHAR AS id, o_orderpriority AS priority, NULL::VARCHAR AS absent FROM orders WHERE o_orderstatus = 'F'")
def s02_feed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = scratch(spark, "feed")
    o = read(spark, sf_dir, "orders").select(F.struct(text(c("o_orderkey")).alias("id"), c("o_orderpriority").alias("priority"), c("o_orderstatus").alias("status")).alias("r"), F.floor(c("o_orderkey") / 1000).alias("page"))
    o.groupBy("page").agg(F.to_json(F.collect_list("r")).alias("value")).write.partitionBy("page").text(at)  # a page a file
    return landing.feed_rows(spark, f"{at}/*", ["id", "priority", "status", "absent"], where=c("status") == "F").select("id", "priority", "absent")


@query("SELECT event_id, '1' AS pages FROM events")
def t03_offset_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A feed read in pages, each once, until a short one."""
    e = read(spark, sf_dir, "events").select("event_id")
    at = scratch(spark, "pages")
    incremental.positioned(e).write.parquet(f"{at}/staged")
    staged = spark.read.parquet(f"{at}/staged")
    size = staged.count() // 3 + 1
    sink = lambda d: d.write.mode("append").parquet(f"{at}/landed")
    log = list(incremental.run_offset_pages(incremental.Positions(staged).page, sink, 0, size, 9))
    assert [x[2] < size for x in log] == [False, False, True]
    return spark.read.parquet(f"{at}/landed").groupBy("event_id").agg(F.count(F.lit(1)).cast("string").alias("pages"))


@query("SELECT max(event_id) - 199 AS least, 200 AS n FROM events")
def t04_keyset_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four pages from the newest event on; the cursor after the last is the least of them."""
    e = read(spark, sf_dir, "events").select("event_id", F.lit("d").alias("day"))
    at = scratch(spark, "pages")
    sink = lambda d: d.write.mode("append").parquet(at)
    (*_, last) = incremental.run_keyset_pages(lambda cursor, n: keys.keyset_after(e, "day", "event_id", cursor, n), sink, None, ("day", "event_id"), 50, 4)
    return spark.read.parquet(at).agg(F.min("event_id").alias("least"), F.count(F.lit(1)).cast("int").alias("n")).where(c("least") == last[1])


@query("SELECT event_id, event_type FROM events")
def d14_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = read(spark, sf_dir, "events").select("event_id", "event_type", F.to_json(F.struct("event_id", "user_id", "event_type", "value")).alias("payload"))
    staged = incremental.stage(raw.union(raw), raw.limit(0).withColumn("row_id", F.lit("")))
    return staged.where("resolved_at IS NULL").select("event_id", "event_type")


@query("SELECT l_returnflag AS path, count(*) AS n FROM lineitem GROUP BY 1")
def g21_paths_of_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.path_counts(read(spark, sf_dir, "lineitem"), c("l_returnflag"))
