"""Joins, aggregates, windows, paging and set operations over the driver's tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotline.functions import numbers
from lotline.operators import coverage, export, keys, rollup
from lotline.operators.coverage import distribution
from lotline.plans.catalog import query, read

c = F.col
money = lambda x: F.sum(c(x).cast("decimal(18,2)")).cast("double")


@query("SELECT l_suppkey, count(*) AS sales, max(strftime(o_orderdate, '%Y-%m-%d')) AS sales_last FROM orders JOIN lineitem ON o_orderkey = l_orderkey WHERE o_orderstatus IN ('F', 'O') GROUP BY l_suppkey")
def j01_sale_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    master = read(spark, sf_dir, "orders").where(c("o_orderstatus").isin("F", "O")).select(c("o_orderkey").alias("document_id"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("event_date"))
    legals = read(spark, sf_dir, "lineitem").select(c("l_orderkey").alias("document_id"), "l_suppkey")
    return rollup.event_rollup(rollup.sales(master, legals), "sales", "sales_last", "l_suppkey")


@query("SELECT o_custkey, o_orderkey, o_orderpriority FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY CASE o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 2 WHEN '5-LOW' THEN 3 ELSE 4 END, o_orderkey) AS n FROM orders) WHERE n = 1")
def j02_best_contact(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = c("o_orderpriority")
    rank = F.when(p == "1-URGENT", 1).when(p == "2-HIGH", 2).when(p == "5-LOW", 3).otherwise(4)
    return keys.best(read(spark, sf_dir, "orders"), ["o_custkey"], [rank, c("o_orderkey")]).select("o_custkey", "o_orderkey", "o_orderpriority")


@query("SELECT c_mktsegment AS source, count(*) AS listings, count(o.o_custkey) AS resolved FROM customer LEFT JOIN (SELECT DISTINCT o_custkey FROM orders WHERE o_orderstatus = 'P') o ON o.o_custkey = c_custkey GROUP BY c_mktsegment")
def j09_left_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    cu = read(spark, sf_dir, "customer").select(c("c_custkey").alias("source_id"), c("c_mktsegment").alias("source"))
    hit = read(spark, sf_dir, "orders").where("o_orderstatus = 'P'").select(c("o_custkey").alias("source_id")).join(cu, "source_id")
    return coverage.listing_coverage(cu.withColumns({"zipcode": F.lit(" "), "status": F.lit("active")}), hit).select("source", "listings", "resolved")


@query("SELECT c_nationkey AS bbl, count(*) AS unit_claims, count(DISTINCT CASE WHEN o_orderstatus = 'F' THEN o_orderkey END) AS official_units FROM customer LEFT JOIN orders ON o_custkey = c_custkey AND o_orderstatus <> 'P' LEFT JOIN lineitem ON l_orderkey = o_orderkey AND l_returnflag = 'R' GROUP BY c_nationkey")
def j10_fanout_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    l = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_returnflag")  # noqa: E741
    d = read(spark, sf_dir, "customer").join(o, (c("o_custkey") == c("c_custkey")) & (c("o_orderstatus") != "P"), "left")
    d = d.join(l, (c("l_orderkey") == c("o_orderkey")) & (c("l_returnflag") == "R"), "left")
    return coverage.claim_counts(d.select(c("c_nationkey").alias("bbl"), c("o_orderkey").alias("unit_id"), F.when(c("o_orderstatus") == "F", "source_document").alias("grade")))


@query("""
WITH hpd AS (SELECT s_nationkey AS k, bool_or(s_acctbal > 5000) AS unexpired FROM supplier GROUP BY 1), lots AS (SELECT n_nationkey AS k, n_regionkey AS u FROM nation WHERE n_regionkey > 0), counts AS (SELECT c_nationkey AS k, count(*) AS n, count(DISTINCT CASE WHEN c_mktsegment = 'BUILDING' THEN c_custkey END) AS d FROM customer GROUP BY 1)
SELECT k::VARCHAR AS bbl, u AS units_res, coalesce(n, 0) AS unit_claims, coalesce(d, 0) AS official_units, CASE WHEN unexpired AND u > 0 THEN 'hpd_unexpired_pluto_residential' WHEN unexpired THEN 'hpd_unexpired_no_positive_pluto_count' WHEN unexpired IS NOT NULL AND u > 0 THEN 'hpd_expired_pluto_residential' WHEN u > 0 THEN 'pluto_residential_not_hpd_unexpired' ELSE 'hpd_only_no_pluto_lot' END AS membership_status
FROM (SELECT k FROM hpd UNION SELECT k FROM lots) LEFT JOIN hpd USING (k) LEFT JOIN lots USING (k) LEFT JOIN counts USING (k)
""")
def j11_left_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    regs = read(spark, sf_dir, "supplier").select(c("s_nationkey").cast("string").alias("bbl"), F.when(c("s_acctbal") > 5000, "unexpired").otherwise("expired").alias("timing"))
    lots = read(spark, sf_dir, "nation").select(c("n_nationkey").cast("string").alias("bbl"), c("n_regionkey").alias("units_res"))
    claims = read(spark, sf_dir, "customer").select(c("c_nationkey").cast("string").alias("bbl"), c("c_custkey").alias("unit_id"), F.when(c("c_mktsegment") == "BUILDING", "source_document").otherwise("other").alias("grade"))
    return coverage.registration_coverage(regs, lots, claims)


@query("SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 100000)")
def j17_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders").where("o_totalprice > 100000").select(c("o_custkey").alias("c_custkey"))
    return read(spark, sf_dir, "customer").select("c_custkey", "c_name").join(o, "c_custkey", "left_anti")


@query("SELECT s_suppkey, s_name FROM supplier WHERE s_suppkey IN (SELECT l_suppkey FROM lineitem WHERE l_quantity >= 50)")
def j19_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    l = read(spark, sf_dir, "lineitem").where("l_quantity >= 50").select(c("l_suppkey").alias("s_suppkey"))  # noqa: E741
    return read(spark, sf_dir, "supplier").select("s_suppkey", "s_name").join(l, "s_suppkey", "left_semi")


@query("SELECT p_partkey FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 45)")
def j20_not_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    read(spark, sf_dir, "lineitem").where("l_returnflag = 'R' AND l_quantity > 45").select("l_partkey").createOrReplaceTempView("returned_parts")
    read(spark, sf_dir, "part").createOrReplaceTempView("all_parts")
    return spark.sql("SELECT p_partkey FROM all_parts WHERE p_partkey NOT IN (SELECT l_partkey FROM returned_parts WHERE l_partkey IS NOT NULL)")


@query("SELECT o_custkey, count(*) AS permits, max(CASE WHEN o_orderkey % 5 > 0 THEN strftime(o_orderdate, '%Y-%m-%d') END) AS permit_last, count(*) FILTER (WHERE o_orderstatus = 'O') AS permits_open FROM orders GROUP BY o_custkey")
def g01_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "orders").withColumn("event_date", F.when(c("o_orderkey") % 5 > 0, F.date_format("o_orderdate", "yyyy-MM-dd")))
    return rollup.event_rollup(e, "permits", "permit_last", "o_custkey", open_=F.lower("o_orderstatus") == "o")


@query("SELECT o_custkey, o_orderpriority FROM (SELECT o_custkey, o_orderpriority, row_number() OVER (PARTITION BY o_custkey ORDER BY n DESC, first) AS r FROM (SELECT o_custkey, o_orderpriority, count(*) AS n, min(o_orderkey) AS first FROM orders GROUP BY ALL)) WHERE r = 1")
def g05_modal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keys.most_frequent(read(spark, sf_dir, "orders"), ["o_custkey"], "o_orderpriority", "o_orderkey", "o_orderpriority_").withColumnRenamed("o_orderpriority_", "o_orderpriority")


@query("SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def g17_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distribution(read(spark, sf_dir, "events"), "event_type")


@query("SELECT count(*) AS rows, count(DISTINCT o_custkey) AS customers, count(DISTINCT (o_custkey, o_orderpriority)) AS pairs, CAST(coalesce(sum(CAST(o_totalprice AS DECIMAL(18,2))), 0) AS DOUBLE) AS total, round(count(*) FILTER (WHERE o_orderstatus = 'F') / count(*), 6) AS filled, 0e0 AS of_none FROM orders")
def g16_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read(spark, sf_dir, "orders").agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("o_custkey").alias("customers"), F.count_distinct("o_custkey", "o_orderpriority").alias("pairs"), F.coalesce(money("o_totalprice"), F.lit(0.0)).alias("total"), F.count_if(c("o_orderstatus") == "F").alias("f"))
    return d.select("rows", "customers", "pairs", "total", numbers.ratio(c("f"), c("rows"), 6).alias("filled"), numbers.ratio(c("f"), F.lit(0)).alias("of_none"))


@query("SELECT o_custkey, array_to_string(list_sort(list_distinct(list(o_orderpriority))), ', ') AS priorities, count(DISTINCT o_orderpriority) = 1 AS one FROM orders GROUP BY o_custkey")
def g27_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = F.collect_set("o_orderpriority")
    return read(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.array_join(F.array_sort(found), ", ").alias("priorities"), (F.size(found) == 1).alias("one"))


@query("SELECT user_id, event_type, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS n FROM events) WHERE n = 1")
def w03_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read(spark, sf_dir, "events").withColumn("at", F.struct("ts", "event_id"))
    return keys.last_wins(d, ["user_id", "event_type"], "at").select("user_id", "event_type", "event_id", "value")


@query("SELECT user_id, event_type, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS n FROM events) WHERE n = 1")
def w04_first_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read(spark, sf_dir, "events").withColumn("at", F.struct("ts", "event_id"))
    return keys.first_wins(d, ["user_id", "event_type"], "at").select("user_id", "event_type", "event_id", "value")


@query("SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS first_seen, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS last_seen FROM events GROUP BY user_id")
def w05_seen_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read(spark, sf_dir, "events").select("user_id", c("ts").alias("first_seen"), c("ts").alias("last_seen"))
    out = keys.seen_bounds(d, ["user_id"])
    text = lambda n: F.date_format(n, "yyyy-MM-dd HH:mm:ss").alias(n)
    return out.select("user_id", text("first_seen"), text("last_seen"))


DELTA_SQL = "SELECT user_id, event_id, value, lag(value) OVER w AS before, value - lag(value) OVER w AS change FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)"


@query(DELTA_SQL)
def w06_price_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keys.changes(read(spark, sf_dir, "events"), ["user_id"], ["ts", "event_id"], "value").select("user_id", "event_id", "value", "before", "change")


@query(f"SELECT user_id, count(*) AS drops, min(change) AS largest FROM ({DELTA_SQL}) WHERE change < 0 AND value < 50 GROUP BY user_id")
def w07_price_drops(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = keys.changes(read(spark, sf_dir, "events"), ["user_id"], ["ts", "event_id"], "value")
    return d.where("change < 0 AND value < 50").groupBy("user_id").agg(F.count(F.lit(1)).alias("drops"), F.min("change").alias("largest"))


@query("SELECT conv_id, turn, role, last_value(CASE WHEN role = 'user' THEN md5(text) END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS last_user FROM conversations")
def w10_carry_forward(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read(spark, sf_dir, "conversations").withColumn("asked", F.when(c("role") == "user", F.md5(c("text").cast("binary"))))
    return keys.carry_forward(d, ["conv_id"], ["turn"], "asked", "last_user").select("conv_id", "turn", "role", "last_user")


@query("SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS at FROM events WHERE ts < (SELECT ts FROM events WHERE event_id = 500) OR (ts = (SELECT ts FROM events WHERE event_id = 500) AND event_id < 500) ORDER BY ts DESC, event_id DESC LIMIT 200")
def p10_keyset(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read(spark, sf_dir, "events")
    at = d.where("event_id = 500").select("ts").first()
    page = keys.keyset_after(d, "ts", "event_id", (at["ts"], 500) if at else None, 200)
    return page.select("event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("at"))


@query("SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_orderkey <= 5000 ORDER BY l_orderkey DESC, l_linenumber DESC, l_partkey DESC LIMIT 300")
def p11_keyset_inclusive(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read(spark, sf_dir, "lineitem").withColumn("row", F.struct("l_linenumber", "l_partkey"))
    return keys.keyset_through(d, "l_orderkey", "row", 5000, 300).select("l_orderkey", "l_linenumber")


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey > 700 ORDER BY o_orderkey LIMIT 250")
def p12_keyset_ascending(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keys.keyset_above(read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), "o_orderkey", 700, 250)


@query("SELECT 'customer' AS kind, c_custkey AS id, c_name AS name, c_mktsegment AS segment FROM customer UNION ALL SELECT 'supplier', s_suppkey, s_name, NULL FROM supplier")
def u03_union_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    cu = read(spark, sf_dir, "customer").select(F.lit("customer").alias("kind"), c("c_custkey").alias("id"), c("c_name").alias("name"), c("c_mktsegment").alias("segment"))
    su = read(spark, sf_dir, "supplier").select(c("s_name").alias("name"), F.lit("supplier").alias("kind"), c("s_suppkey").alias("id"))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [cu, su])


@query("SELECT DISTINCT c_nationkey AS nation FROM customer WHERE c_acctbal > 9000 EXCEPT SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000")
def u04_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = read(spark, sf_dir, "customer").where("c_acctbal > 9000").select(c("c_nationkey").alias("nation")).distinct()
    return a.join(read(spark, sf_dir, "supplier").where("s_acctbal > 5000").select(c("s_nationkey").alias("nation")), "nation", "left_anti")


@query("SELECT o_orderkey::VARCHAR AS o_orderkey, o_orderstatus, l_linenumber::VARCHAR AS l_linenumber, coalesce(CASE WHEN l_linenumber > 1 THEN l_returnflag END, '') AS flag FROM orders JOIN lineitem ON l_orderkey = o_orderkey ORDER BY orders.o_orderkey, lineitem.l_linenumber")
def k05_export_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    l = read(spark, sf_dir, "lineitem").select(c("l_orderkey").alias("o_orderkey"), "l_linenumber", F.when(c("l_linenumber") > 1, c("l_returnflag")).alias("flag"))  # noqa: E741
    return export.rows_in_order(o.join(l, "o_orderkey"), ["o_orderkey", "o_orderstatus", "l_linenumber", "flag"], ["o_orderkey", "l_linenumber"])


@query("SELECT o_orderstatus AS path, count(*) AS n FROM orders GROUP BY 1")
def g21_path_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.path_counts(read(spark, sf_dir, "orders"), c("o_orderstatus"))


@query("SELECT count(*) FILTER (WHERE o_orderkey % 3 > 0) AS attempted, count(*) FILTER (WHERE o_orderkey % 3 > 0 AND o_orderstatus = 'F') AS resolved, count(*) FILTER (WHERE o_orderkey % 3 > 0 AND o_orderstatus = 'F') / count(*) FILTER (WHERE o_orderkey % 3 > 0) AS rate FROM orders")
def g20_resolve_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.resolve_rate(read(spark, sf_dir, "orders"), c("o_orderkey") % 3 > 0, c("o_orderstatus") == "F")


@query("SELECT l_returnflag AS source, count(*) AS observations, count(*) FILTER (WHERE l_linenumber = 1) AS resolved, count(*) FILTER (WHERE l_linenumber = 2) AS unresolved, count(*) FILTER (WHERE l_linenumber = 3) AS ambiguous, count(*) FILTER (WHERE l_linenumber > 3) AS not_a_dwelling FROM lineitem GROUP BY 1")
def g22_importer_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = c("l_linenumber")
    status = F.when(n == 1, "resolved").when(n == 2, "unresolved").when(n == 3, "ambiguous").otherwise("not_a_dwelling")
    return rollup.status_counts(read(spark, sf_dir, "lineitem").select(c("l_returnflag").alias("source"), status.alias("status")))
