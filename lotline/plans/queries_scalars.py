"""Scalar functions over the driver's tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lotline.functions import dates, geo, ids, numbers
from lotline.functions import text as X
from lotline.functions.documents import groups, json_field
from lotline.operators import enrich
from lotline.operators.importers import not_a_dwelling
from lotline.operators.resolve import house_numbers
from lotline.operators.units import completeness
from lotline.operators.upsert import names
from lotline.plans.catalog import query, read

c = F.col


# The rules' words, written out anew for the SQL.
SQL_NOISE = [r"\b\d+\s?BEDS?\b", r"\bSTUDIO\b", r"\b\d+\s?BR\b", r"\b\d+\s?BATH\w*\b", r"\bNO FEE\b", r"\bFURNISHED\b", r"\bDUPLEX\b"]
SQL_WORDS = "FIRST 1 SECOND 2 THIRD 3 FOURTH 4 FIFTH 5 SIXTH 6 SEVENTH 7 EIGHTH 8 NINTH 9 TENTH 10 ELEVENTH 11 TWELFTH 12 EAST E WEST W NORTH N SOUTH S SAINT ST FT FORT PLZ PLAZA".split()
SQL_TYPES = "STREET ST AVENUE AVE BOULEVARD BLVD PLACE PL ROAD RD DRIVE DR LANE LN TERRACE TERR PARKWAY PKWY COURT CT SQUARE SQ HIGHWAY HWY TURNPIKE TPKE".split()


def _sql_address(a: str) -> str:
    """The address rules in SQL, for ASCII text."""
    e = f"regexp_replace(upper(coalesce({a}, '')), '^\\s+|\\s+$', '', 'g')"
    e = f"regexp_replace({e}, '[,.]', ' ', 'g')"
    for noise in SQL_NOISE:
        e = f"regexp_replace({e}, '{noise}', ' ', 'g')"
    for word, to in zip(SQL_WORDS[::2], SQL_WORDS[1::2], strict=True):
        e = f"regexp_replace({e}, '\\b{word}\\b', '{to}', 'g')"
    for part, to in zip(SQL_TYPES[::2], SQL_TYPES[1::2], strict=True):
        e = f"replace({e}, ' {part}', ' {to}')"
    e = f"regexp_replace({e}, '\\b(?:APARTMENT|APT|UNIT|STE|SUITE|FL|FLOOR|RM|ROOM)\\b.*$|#.*$', '')"
    e = f"regexp_replace({e}, '(\\d+)(?:ST|ND|RD|TH)\\b', '\\1', 'g')"
    e = f"regexp_replace({e}, '\\b(ST|AVE|BLVD|PL|RD|DR|LN|TERR|PKWY|CT|SQ|HWY|TPKE|PLAZA|CIRCLE|PARK|WALK|ROW)\\s+\\d+[A-Z]?$', '\\1')"
    return f"trim(regexp_replace({e}, '\\s+', ' ', 'g'))"


def _sql_unit(u: str) -> str:
    e = f"regexp_replace(upper(coalesce({u}, '')), '\\b(?:APT|APARTMENT|UNIT|STE|SUITE|FL|FLOOR|RM|ROOM|NO)\\b\\.?', '', 'g')"
    e = f"regexp_replace({e}, '[^A-Z0-9]', '', 'g')"
    return f"(CASE WHEN regexp_full_match({e}, '[0-9]+') THEN CAST(CAST({e} AS BIGINT) AS VARCHAR) ELSE {e} END)"


def address() -> Column:
    return F.concat(c("p_partkey").cast("string"), F.lit(" West "), (c("p_size") + 1).cast("string"), F.lit("th Street, Apt "), c("p_brand"))


ADDRESS_SQL = "concat(p_partkey, ' West ', p_size + 1, 'th Street, Apt ', p_brand)"


@query(f"SELECT p_partkey, a AS address, CASE WHEN length(n) >= 5 AND regexp_matches(n, '^\\d') AND regexp_matches(n, '[A-Z]') THEN n ELSE '' END AS normalized FROM (SELECT p_partkey, a, {_sql_address('a')} AS n FROM (SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN {ADDRESS_SQL} WHEN 1 THEN concat(p_partkey, ' Saint Nicholas Avenue ', p_size) WHEN 2 THEN concat('Unit ', p_size) ELSE concat(p_partkey, ' Fifth  Avenue, #', p_size, ' no fee 2 beds') END AS a FROM part))")
def f01_normalize_address(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = c("p_partkey")
    a = (
        F.when(k % 4 == 0, address())
        .when(k % 4 == 1, F.concat(k.cast("string"), F.lit(" Saint Nicholas Avenue "), c("p_size").cast("string")))
        .when(k % 4 == 2, F.concat(F.lit("Unit "), c("p_size").cast("string")))
        .otherwise(F.concat(k.cast("string"), F.lit(" Fifth  Avenue, #"), c("p_size").cast("string"), F.lit(" no fee 2 beds")))
    )
    d = read(spark, sf_dir, "part").select("p_partkey", a.alias("address"))
    return d.withColumn("normalized", X.normalize_address(c("address")))


@query("SELECT p_partkey, lo, hi, parity, unnest(CASE WHEN parity IN ('O', 'E') AND lo % 2 = hi % 2 THEN generate_series(lo, hi, 2) ELSE generate_series(lo, hi) END)::VARCHAR AS number FROM (SELECT p_partkey, p_partkey AS lo, p_partkey + p_size AS hi, CASE WHEN p_partkey % 3 = 0 THEN '' WHEN p_partkey % 2 = 0 THEN 'E' ELSE 'O' END AS parity FROM part)")
def f02_range_expand(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = c("p_partkey")
    d = read(spark, sf_dir, "part").select("p_partkey", k.alias("lo"), (k + c("p_size")).alias("hi"), F.when(k % 3 == 0, "").when(k % 2 == 0, "E").otherwise("O").alias("parity"))
    return d.withColumn("number", F.explode(house_numbers(c("lo").cast("string"), c("hi").cast("string"), c("parity"))))


@query(f"SELECT p_partkey, u AS label, {_sql_unit('u')} AS unit FROM (SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN concat('Apt. ', p_size, 'b') WHEN 1 THEN concat('#00', p_size) WHEN 2 THEN concat('Floor ', p_size, ' Rm 2') WHEN 3 THEN p_brand ELSE nullif('x', 'x') END AS u FROM part)")
def f03_normalize_unit(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, s = c("p_partkey"), c("p_size").cast("string")
    label = F.when(k % 5 == 0, F.concat(F.lit("Apt. "), s, F.lit("b"))).when(k % 5 == 1, F.concat(F.lit("#00"), s)).when(k % 5 == 2, F.concat(F.lit("Floor "), s, F.lit(" Rm 2"))).when(k % 5 == 3, c("p_brand"))
    return read(spark, sf_dir, "part").select("p_partkey", label.alias("label")).withColumn("unit", X.normalize_unit(c("label")))


@query(f"SELECT p_partkey, CASE WHEN unit <> '' THEN concat(addr, '::', unit, '::beds=', beds) END AS unit_key, coalesce(CASE WHEN unit <> '' THEN concat(addr, '::', unit, '::beds=', beds) END, concat('singleton::', p_brand, '::', p_partkey)) AS group_key FROM (SELECT p_partkey, p_brand, {_sql_address(ADDRESS_SQL)} AS addr, {_sql_unit('CASE WHEN p_size % 3 > 0 THEN p_size::VARCHAR END')} AS unit, CASE WHEN p_size % 2 = 0 THEN (p_size % 5)::VARCHAR ELSE '' END AS beds FROM part)")
def f05_unit_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    beds = F.when(c("p_size") % 2 == 0, (c("p_size") % 5).cast("double"))
    unit = F.when(c("p_size") % 3 > 0, c("p_size").cast("string"))
    d = read(spark, sf_dir, "part").withColumn("unit_key", X.unit_key(address(), unit, beds))
    return d.select("p_partkey", "unit_key", X.group_key(c("unit_key"), c("p_brand"), c("p_partkey").cast("string")).alias("group_key"))


@query("SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN concat(c_name, ' REALTY') WHEN 1 THEN upper(c_name) WHEN 2 THEN upper(c_name) ELSE '' END AS owner FROM (SELECT c_custkey, upper(c_name) AS c_name FROM customer)")
def f07_owner_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = c("c_custkey")
    raw = F.when(k % 4 == 0, F.concat(c("c_name"), F.lit(" Realty, LLC Inc."))).when(k % 4 == 1, F.concat(c("c_name"), F.lit("  L.L.C."))).when(k % 4 == 2, c("c_name"))
    return read(spark, sf_dir, "customer").select("c_custkey", X.normalize_owner_name(raw).alias("owner"))


@query("SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN concat('__no_address__', c_custkey) ELSE concat(c_nationkey, ' E 3 AVE FL 2 ', c_mktsegment) END AS cluster FROM customer")
def f08_cluster_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    office = F.when(c("c_custkey") % 3 > 0, F.concat(c("c_nationkey").cast("string"), F.lit(" East 3 Avenue, Floor 2, "), c("c_mktsegment")))
    return read(spark, sf_dir, "customer").select("c_custkey", X.cluster_key(c("c_custkey").cast("string"), office).alias("cluster"))


@query("SELECT l_orderkey, l_linenumber, CASE WHEN b BETWEEN 1 AND 5 THEN printf('%d%05d%04d', b, l_orderkey, l_partkey) END AS bbl, printf('%d%05d%04d', b, l_orderkey, l_partkey) AS unchecked_bbl, CASE WHEN b BETWEEN 1 AND 5 AND l_orderkey < 100000 AND l_partkey < 10000 THEN printf('%d%05d%04d', b, l_orderkey, l_partkey) END AS file_bbl FROM (SELECT *, l_suppkey % 7 AS b FROM lineitem)")
def f10_make_bbl(spark: SparkSession, sf_dir: str) -> DataFrame:
    b, k, p = (c("l_suppkey") % 7).cast("string"), c("l_orderkey").cast("string"), c("l_partkey").cast("string")
    d = read(spark, sf_dir, "lineitem")
    made = ids.assembled_bbl(b, k, p)
    return d.select("l_orderkey", "l_linenumber", made.alias("bbl"), ids.assembled_bbl(b, k, p, ranged=False).alias("unchecked_bbl"), F.when(F.length(made) == 10, ids.file_bbl(b, k, p)).alias("file_bbl"))


@query("SELECT o_orderkey, printf('%010d', 1000000000 + o_orderkey * 300000) AS bbl, CASE WHEN 1000000000 + o_orderkey * 300000 BETWEEN 1000000000 AND 5999999999 THEN printf('%010d', 1000000000 + o_orderkey * 300000) END AS catalog_bbl FROM orders")
def f11_float_bbl(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.concat((F.lit(1_000_000_000) + c("o_orderkey") * 300_000).cast("string"), F.lit(".00000000"))
    return read(spark, sf_dir, "orders").select("o_orderkey", ids.float_bbl(raw).alias("bbl"), ids.catalog_bbl(raw).alias("catalog_bbl"))


@query("SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' AND o_orderkey % 2 = 0 THEN NULL WHEN o_orderstatus = 'P' THEN o_orderpriority WHEN o_orderkey % 2 = 0 THEN o_orderstatus ELSE concat(o_orderstatus, ' / ', o_orderpriority) END AS label, concat('Class ', o_orderstatus, ' ', repeat('x', 292), '…') AS detail FROM orders")
def f15_label_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    status, priority = F.when(c("o_orderstatus") != "P", c("o_orderstatus")).otherwise(""), F.when(c("o_orderkey") % 2 != 0, c("o_orderpriority"))
    text = F.concat(F.lit(" "), F.repeat(F.lit("x"), 400))
    return read(spark, sf_dir, "orders").select("o_orderkey", X.join_labels(status, priority).alias("label"), X.violation_detail(c("o_orderstatus"), text).alias("detail"))


@query("SELECT p_partkey, label, upper(regexp_replace(label, '[^a-zA-Z0-9]', '', 'g')) AS unit_key FROM (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS label FROM part) WHERE label <> ''")
def f32_split_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read(spark, sf_dir, "part").select("p_partkey", F.explode(X.split_labels(F.replace("p_name", F.lit(" "), F.lit(" ; ")))).alias("label"))
    return d.withColumn("unit_key", X.normalize_designation(c("label")))


@query("SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS sliced, CASE WHEN o_orderkey % 3 = 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN o_orderkey % 3 = 1 THEN strftime(o_orderdate, '%Y%m%d') END AS slashed FROM orders")
def f40_iso_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = c("o_orderdate")
    raw = F.when(c("o_orderkey") % 3 == 0, F.date_format(d, "M/d/yyyy")).when(c("o_orderkey") % 3 == 1, F.date_format(d, "yyyyMMdd")).otherwise("")
    return read(spark, sf_dir, "orders").select("o_orderkey", dates.iso_date(F.date_format(d, "yyyy-MM-dd'T'HH:mm:ss")).alias("sliced"), dates.slashed_date(raw).alias("slashed"))


@query("SELECT event_id, CASE WHEN event_id % 2 = 0 THEN CAST(epoch(date_trunc('second', ts)) AS BIGINT) ELSE 0 END AS seen FROM events")
def f43_seen_seconds(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.when(c("event_id") % 2 == 0, dates.timestamp_text(c("ts"))).otherwise("yesterday")
    return read(spark, sf_dir, "events").select("event_id", dates.seen_seconds(raw).alias("seen"))


@query("SELECT c_custkey, CAST(trunc(c_acctbal) AS BIGINT) AS truncated, CASE WHEN c_acctbal > 0 THEN c_acctbal END AS positive, CASE WHEN c_custkey % 2 = 0 THEN c_nationkey END AS strict FROM customer")
def f50_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.when(c("c_custkey") % 2 == 0, F.concat(F.lit(" "), c("c_nationkey").cast("string"))).otherwise(F.concat(c("c_nationkey").cast("string"), F.lit(".0")))
    return read(spark, sf_dir, "customer").select("c_custkey", numbers.truncated(c("c_acctbal").cast("string")).alias("truncated"), numbers.positive(c("c_acctbal")).alias("positive"), numbers.strict_int(text).alias("strict"))


def point() -> tuple[Column, Column]:
    """A latitude and a longitude of a customer's key."""
    return F.lit(40.5) + (c("c_custkey") % 400) / F.lit(1000.0), F.lit(-74.2) + (c("c_custkey") % 433) / F.lit(1000.0)


@query("SELECT c_custkey, CAST(round_even(12742000 * asin(sqrt(pow(sin(radians(40.7 - lat) / 2), 2) + cos(radians(lat)) * cos(radians(40.7)) * pow(sin(radians(-74.0 - lng) / 2), 2))), 0) AS INTEGER) AS metres FROM (SELECT c_custkey, 40.5 + (c_custkey % 400) / 1000.0::DOUBLE AS lat, -74.2 + (c_custkey % 433) / 1000.0::DOUBLE AS lng FROM customer)")
def f53_haversine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "customer").select("c_custkey", numbers.half_even(geo.haversine(*point(), F.lit(40.7), F.lit(-74.0))).alias("metres"))


RING = [(-74.1, 40.55), (-73.9, 40.6), (-73.85, 40.8), (-74.05, 40.85), (-74.15, 40.7)]


def _sql_ring() -> str:
    f = lambda v: f"({v}e0)"
    edges = [f"CASE WHEN ({f(y1)} > lat) <> ({f(y2)} > lat) AND lng < ({f(x2)} - {f(x1)}) * (lat - {f(y1)}) / ({f(y2)} - {f(y1)} + 1e-16) + {f(x1)} THEN 1 ELSE 0 END" for (x1, y1), (x2, y2) in ((p, RING[i - 1]) for i, p in enumerate(RING))]
    return f"({' + '.join(edges)}) % 2 = 1"


@query(f"SELECT c_custkey, {_sql_ring()} AS inside FROM (SELECT c_custkey, 40.5e0 + (c_custkey % 400) / 1000e0 AS lat, -74.2e0 + (c_custkey % 433) / 1000e0 AS lng FROM customer)")
def f55_point_in_polygon(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read(spark, sf_dir, "customer").select("c_custkey", point()[0].alias("lat"), point()[1].alias("lng"))
    return enrich.inside(d, F.array(geo.ring_literal(RING)), "inside", "lat", "lng").select("c_custkey", "inside")


@query("SELECT c_custkey, CASE WHEN b BETWEEN 1 AND 5 AND c_custkey % 11 > 0 THEN concat('36', CASE b WHEN 1 THEN '061' WHEN 2 THEN '005' WHEN 3 THEN '047' WHEN 4 THEN '081' ELSE '085' END, lpad(c_custkey::VARCHAR, 6, '0')) END AS geoid FROM (SELECT c_custkey, c_nationkey % 7 AS b FROM customer)")
def f56_census_geoid(spark: SparkSession, sf_dir: str) -> DataFrame:
    tract = F.when(c("c_custkey") % 11 > 0, c("c_custkey").cast("string")).otherwise("n/a")
    return read(spark, sf_dir, "customer").select("c_custkey", geo.census_geoid((c("c_nationkey") % 7).cast("string"), tract).alias("geoid"))


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, coalesce(json_extract_string(props, '$.none'), 'unknown') AS other FROM events")
def f61_json_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read(spark, sf_dir, "events")
    return d.select("event_id", json_field(c("props"), "k long", "k").alias("k"), json_field(c("props"), "none string", "none", "unknown").alias("other"))


def _sql_uuid(name: str) -> str:
    h = f"sha1(from_hex('{ids.URL_NAMESPACE}') || encode({name}))"
    return f"concat(substr({h}, 1, 12), '5', substr({h}, 14, 3), CASE substr({h}, 17, 1) WHEN '0' THEN '8' WHEN '4' THEN '8' WHEN '8' THEN '8' WHEN 'c' THEN '8' WHEN '1' THEN '9' WHEN '5' THEN '9' WHEN '9' THEN '9' WHEN 'd' THEN '9' WHEN '2' THEN 'a' WHEN '6' THEN 'a' WHEN 'a' THEN 'a' WHEN 'e' THEN 'a' ELSE 'b' END, substr({h}, 18, 15))"


@query(f"SELECT c_custkey, concat('unit_', substr(sha256(concat(c_custkey, '\\x1f', c_name)), 1, 20)) AS unit_id, substr(sha1(c_name), 1, 16) AS key_id, concat('pf_', substr(sha1(c_mktsegment), 1, 16)) AS portfolio_id, {_sql_uuid('concat(c_name, $$|$$, c_mktsegment)')} AS uuid FROM customer")
def f65_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read(spark, sf_dir, "customer")
    return d.select("c_custkey", ids.catalog_id("unit", c("c_custkey"), c("c_name")).alias("unit_id"), ids.unit_id(c("c_name")).alias("key_id"), ids.portfolio_id(c("c_mktsegment")).alias("portfolio_id"), ids.name_uuid(c("c_name"), c("c_mktsegment")).alias("uuid"))


@query("SELECT page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title, len(regexp_extract_all(html, 'href=\"([^\"]*)\"', 1)) AS links, len(list_distinct(regexp_extract_all(html, 'href=\"([^\"]*)\"', 1))) AS distinct_links, length(trim(regexp_replace(regexp_replace(html, '<[^>]+>', ' ', 'g'), '[ \\t\\n\\r]+', ' ', 'g'))) AS text_chars FROM pages")
def s11_html_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    links = groups(c("html"), 'href="([^"]*)"', "href")
    title = F.coalesce(F.get(groups(c("html"), "<title>([^<]*)</title>", "title"), F.lit(0))["title"], F.lit(""))
    body = X.strip_tags(c("html"))
    return read(spark, sf_dir, "pages").select("page_id", title.alias("title"), F.size(links).cast("long").alias("links"), F.size(F.array_distinct(links)).cast("long").alias("distinct_links"), F.length(body).cast("long").alias("text_chars"))


@query("SELECT page_id, unnest(list_distinct(regexp_extract_all(html, 'href=\"([^\"]*)\"', 1))) AS link FROM pages")
def s13_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "pages").select("page_id", F.explode(F.array_distinct(groups(c("html"), 'href="([^"]*)"', "href"))).alias("link")).select("page_id", "link.href").withColumnRenamed("href", "link")


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN 'missing' WHEN strftime(o_orderdate, '%Y-%m-%d') >= '1996-01-01' THEN 'unexpired' ELSE 'expired' END AS timing FROM orders")
def p26_timing(spark: SparkSession, sf_dir: str) -> DataFrame:
    expires = F.when(c("o_orderkey") % 7 > 0, F.date_format("o_orderdate", "yyyy-MM-dd"))
    return read(spark, sf_dir, "orders").select("o_orderkey", dates.timing(expires, "1996-01-01").alias("timing"))


@query("SELECT doc_id, coalesce(nullif(trim(CASE WHEN doc_id % 3 = 0 THEN '  ' ELSE lang END), ''), 'unknown') AS lang, coalesce(CASE WHEN doc_id % 2 = 0 THEN source END, CASE WHEN doc_id % 5 > 0 THEN lang END, '') AS first_filled FROM documents")
def p25_blank_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = c("doc_id")
    return read(spark, sf_dir, "documents").select("doc_id", X.blank_as(F.when(k % 3 == 0, "  ").otherwise(c("lang")), "unknown").alias("lang"), X.first_filled(F.when(k % 2 == 0, c("source")).otherwise(" "), F.when(k % 5 > 0, c("lang"))).alias("first_filled"))


@query("SELECT p_partkey, p_size % 5 IN (0, 1) OR p_size % 5 = 2 AS common FROM part")
def p15_not_a_dwelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = c("p_size") % 5
    label = F.when(s == 0, " public hall").when(s == 1, "Roof ").when(s == 2, "2nd floor").when(s == 3, "PUBLIC-HALL").otherwise(c("p_brand"))
    return read(spark, sf_dir, "part").select("p_partkey", not_a_dwelling(label, floors=True).alias("common"))


@query("SELECT p_partkey, p_type ILIKE '%brass%' OR p_brand = 'Brand#11' AS marked FROM part WHERE p_type ILIKE '%steel%' OR p_size BETWEEN 1 AND 10")
def p13_case_blind_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read(spark, sf_dir, "part").where(names(c("p_type"), "steel") | c("p_size").between(1, 10))
    return d.select("p_partkey", (names(c("p_type"), "BRASS") | (c("p_brand") == "Brand#11")).alias("marked"))


@query("SELECT n_nationkey, n_name FROM nation WHERE n_regionkey = 3 AND starts_with(n_nationkey::VARCHAR, '2')")
def p03_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read(spark, sf_dir, "nation")
    both = ids.all_of(ids.borough_filter(ids.borough_code("brooklyn"), c("n_regionkey").cast("string")), None, ids.in_borough(c("n_nationkey").cast("string"), 2))
    return d.where(both).select("n_nationkey", "n_name")


@query("SELECT d.doc_id, (CASE WHEN text <> '' THEN 1 ELSE 0 END + CASE WHEN d.doc_id % 3 > 0 THEN 1 ELSE 0 END + CASE WHEN l.quality IS NOT NULL THEN 1 ELSE 0 END) AS filled FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id")
def g28_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read(spark, sf_dir, "documents").join(read(spark, sf_dir, "labels"), "doc_id", "left")
    d = d.withColumn("tag", F.when(c("doc_id") % 3 == 1, c("lang")).when(c("doc_id") % 3 == 2, "0").otherwise(""))
    return d.select("doc_id", completeness(["text", "tag", "quality"]).alias("filled"))
