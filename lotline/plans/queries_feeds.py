"""Every record feed and every listing feed over the driver's tables: rows, JSON pages and HTML pages are put together from columns, read by the feed, and compared with the columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lotline.plans.catalog import query, read
from lotline.plans.queries_entities import INDEX_SQL, LOOKUP_SQL, _index
from lotline.sources import listings, records

c = F.col
text = lambda x: x.cast("string")
day = lambda x: F.date_format(x, "yyyy-MM-dd")

# The building of a line, its borough's name, and its ship date, in SQL.
LOT = "CASE WHEN l_suppkey % 7 BETWEEN 1 AND 5 THEN printf('%d%05d%04d', l_suppkey % 7, l_orderkey, l_linenumber) END"
DAY = "strftime(l_shipdate, '%Y-%m-%d')"
OWN_OR_NAMED = "CASE WHEN l_orderkey % 4 = 0 THEN printf('%010d', 1000000000 + l_orderkey) WHEN l_suppkey % 7 BETWEEN 1 AND 5 THEN printf('%d%05d%04d', l_suppkey % 7, l_orderkey, l_linenumber) END"


def _lines(spark: SparkSession, sf_dir: str, **columns: Column) -> DataFrame:
    k = c("l_suppkey") % 7
    name = F.when(k == 1, "Manhattan").when(k == 2, "BRONX").when(k == 3, " brooklyn ").when(k == 4, "QUEENS").when(k == 5, "STATEN ISLAND").otherwise("?")
    own = F.when(c("l_orderkey") % 4 == 0, text(c("l_orderkey") + 1_000_000_000)).otherwise("n/a")
    d = read(spark, sf_dir, "lineitem").withColumns({"boroid": text(k), "named": name, "block": text(c("l_orderkey")), "lot": text(c("l_linenumber")), "own": own, "day": day("l_shipdate")})
    return d.select("boroid", "block", "lot", *[x.alias(n) for n, x in columns.items()])


def _counted(events: DataFrame) -> DataFrame:
    return events.groupBy("bbl", "event_date", "party", "detail").agg(F.count(F.lit(1)).alias("n"))


def counted_sql(bbl: str, date: str, party: str, detail: str, rows: str = "lineitem") -> str:
    return f"SELECT bbl, event_date, party, detail, count(*) AS n FROM (SELECT {bbl} AS bbl, {date} AS event_date, {party} AS party, {detail} AS detail FROM {rows}) WHERE bbl IS NOT NULL GROUP BY ALL"


@query("SELECT printf('%010d', 1000000000 + p_partkey) AS bbl, CASE p_partkey % 3 WHEN 0 THEN 'MANHATTAN' WHEN 1 THEN 'BROOKLYN' ELSE 'elsewhere' END AS borough, p_partkey AS block, p_size::BIGINT AS lot, p_name AS address, CASE WHEN p_size % 4 > 0 THEN 1900 + p_size END::BIGINT AS year_built, p_size::BIGINT AS units_res, p_brand AS building_class, 40.5e0 AS latitude FROM part WHERE p_partkey % 9 > 0")
def r01_lots(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, s = c("p_partkey"), c("p_size")
    d = read(spark, sf_dir, "part").select(F.when(k % 9 > 0, F.concat(text(k + 1_000_000_000), F.lit(".00000000"))).otherwise("x").alias("bbl"), F.when(k % 3 == 0, "MN").when(k % 3 == 1, "BK").otherwise("elsewhere").alias("borough"), text(k).alias("block"), text(s).alias("lot"), c("p_name").alias("address"), F.lit("1").alias("zipcode"), F.when(s % 4 > 0, F.concat(text(s + 1900), F.lit(".0"))).otherwise("0").alias("yearbuilt"), F.concat(text(s), F.lit(".0")).alias("unitsres"), F.lit("").alias("unitstotal"), c("p_brand").alias("bldgclass"), F.lit("40.5").alias("latitude"), F.lit("?").alias("longitude"), F.lit("101").alias("cd"), F.lit("33").alias("ct2010"))
    return records.pluto(d).select("bbl", "borough", "block", "lot", "address", "year_built", "units_res", "building_class", "latitude")


@query(counted_sql(LOT, f"CASE WHEN l_orderkey % 3 > 0 THEN '2020-02-03' ELSE {DAY} END", "l_linestatus", "CASE WHEN l_returnflag = 'R' THEN 'a b' ELSE concat('Class ', l_returnflag, ' a b') END"))
def r02_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _counted(records.violations(_lines(spark, sf_dir, novissueddate=F.when(c("l_orderkey") % 3 > 0, F.lit("2020-02-03T00:00:00.000")).otherwise(""), inspectiondate=c("day"), **{"class": F.when(c("l_returnflag") != "R", c("l_returnflag"))}, novdescription=F.lit(" a b "), currentstatus=c("l_linestatus"))))


@query(counted_sql(OWN_OR_NAMED, DAY, "l_linestatus", "CASE WHEN l_returnflag = 'R' THEN 'HEAT' ELSE concat('HEAT / ', l_returnflag) END"))
def r03_complaints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _counted(records.complaints(_lines(spark, sf_dir, bbl=c("own"), borough=c("named"), received_date=F.concat(c("day"), F.lit("T01:02:03")), major_category=F.lit("HEAT"), minor_category=F.when(c("l_returnflag") != "R", c("l_returnflag")), problem_code=F.lit(""), complaint_status=c("l_linestatus"))))


R04_SQL = """
WITH contact AS (SELECT l_orderkey, CASE WHEN l_partkey % 3 = 0 THEN concat('Corp ', l_partkey) ELSE concat('F', l_suppkey, ' L') END AS owner_name, concat(l_partkey, ' Broad St #', l_suppkey, ', NY 1') AS office,
  row_number() OVER (PARTITION BY l_orderkey ORDER BY CASE l_linenumber WHEN 3 THEN 1 WHEN 2 THEN 3 WHEN 1 THEN 5 ELSE 6 END, l_linenumber * 1000000000000 + l_partkey * 1000000 + l_suppkey) AS n FROM lineitem),
reg AS (SELECT o_custkey, owner_name, office, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS n FROM orders JOIN contact ON l_orderkey = o_orderkey AND contact.n = 1)
SELECT printf('%d%05d0001', o_custkey % 6, o_custkey) AS bbl, owner_name, office AS owner_business_address FROM reg WHERE n = 1
"""


@query(R04_SQL)
def r04_registrations(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = c("o_custkey")
    regs = read(spark, sf_dir, "orders").select(text(c("o_orderkey")).alias("registrationid"), text(k % 6).alias("boroid"), text(k).alias("block"), F.lit("1").alias("lot"), c("o_orderkey").alias("arrival"))
    n, p, s = c("l_linenumber"), c("l_partkey"), c("l_suppkey")
    kind = F.when(n == 1, "Agent").when(n == 2, "CorporateOwner").when(n == 3, "HeadOfficer").otherwise("Lessee")
    contacts = read(spark, sf_dir, "lineitem").select(text(c("l_orderkey")).alias("registrationid"), kind.alias("type"), (n * 1_000_000_000_000 + p * 1_000_000 + s).alias("arrival"), F.when(p % 3 == 0, F.concat(F.lit("Corp "), text(p))).alias("corporationname"), F.concat(F.lit("F"), text(s)).alias("firstname"), F.lit("L").alias("lastname"), text(p).alias("businesshousenumber"), F.lit("Broad St").alias("businessstreetname"), text(s).alias("businessapartment"), F.lit("").alias("businesscity"), F.lit("NY").alias("businessstate"), F.lit("1").alias("businesszip"))
    return records.registrations(regs, contacts)


NAMED = "CASE WHEN l_suppkey % 7 BETWEEN 1 AND 5 THEN printf('%d%05d%04d', l_suppkey % 7, l_orderkey, l_linenumber) END"


@query(counted_sql(NAMED, f"CASE WHEN l_orderkey % 3 > 0 THEN {DAY} ELSE '2020-02-03' END", "NULL::VARCHAR", "concat('A1 / ', l_returnflag)"))
def r05_permits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _counted(records.permits(_lines(spark, sf_dir, borough=c("named"), issuance_date=F.when(c("l_orderkey") % 3 > 0, F.date_format("l_shipdate", "M/d/yyyy")), filing_date=F.lit("02/03/2020"), job_type=F.lit("A1"), permit_type=F.lit(None).cast("string"), work_type=c("l_returnflag"))))


FIRST_BBL = f"(SELECT l.c_custkey, coalesce((SELECT min(bbl::VARCHAR) FROM ({INDEX_SQL}) i WHERE i.a = l.a AND i.z = l.z), (SELECT min(bbl::VARCHAR) FROM ({INDEX_SQL}) i WHERE i.a = l.a)) AS bbl FROM ({LOOKUP_SQL}) l)"


def _crosswalk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _index(spark, sf_dir).withColumnRenamed("normalized", "norm_address")


def _found(spark: SparkSession, sf_dir: str, **columns: Column) -> DataFrame:
    k = c("c_custkey")
    d = read(spark, sf_dir, "customer").withColumns({"house": text(F.floor(k / 20) + 1), "zip": F.when(k % 4 > 0, text(k % 7)), "odd": k % 2 == 1})
    return d.select(*[x.alias(n) for n, x in columns.items()])


@query(f"SELECT bbl, '2020-02-03' AS event_date, CASE WHEN c_custkey % 2 = 1 THEN 'ACTIVE' ELSE 'CLOSED' END AS party, CASE WHEN c_custkey % 2 = 1 THEN 'category 4B / ACTIVE' ELSE 'CLOSED' END AS detail, count(*) AS n FROM {FIRST_BBL} WHERE bbl IS NOT NULL AND starts_with(bbl, '1') GROUP BY ALL")
def r06_buildings_complaints(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _found(spark, sf_dir, house_number=c("house"), house_street=F.lit("Main Street"), zip_code=c("zip"), date_entered=F.lit("2/3/2020"), complaint_category=F.when(c("odd"), "4B").otherwise(""), status=F.when(c("odd"), "ACTIVE").otherwise("CLOSED"))
    return _counted(records.dob_complaints(d, _crosswalk(spark, sf_dir), 1))


@query(counted_sql(OWN_OR_NAMED, DAY, "NULL::VARCHAR", "concat('Final / ', l_returnflag)"))
def r07_certificates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _counted(records.cofo(_lines(spark, sf_dir, bbl=c("own"), borough=c("named"), c_o_issue_date=F.concat(c("day"), F.lit("T00:00")), issue_type=F.lit("Final"), job_type=c("l_returnflag"))))


@query(f"SELECT bbl, '2020-02-03' AS event_date, NULL::VARCHAR AS party, CASE WHEN c_custkey % 2 = 1 THEN 'Residential / apt 5' ELSE 'Residential' END AS detail, count(*) AS n FROM {FIRST_BBL} WHERE bbl IS NOT NULL AND c_custkey % 10 > 0 GROUP BY ALL")
def r08_evictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _found(spark, sf_dir, eviction_address=F.when(c("c_custkey") % 10 > 0, F.concat(c("house"), F.lit(" MAIN STREET #2"))).otherwise(""), eviction_zip=c("zip"), executed_date=F.lit("2020-02-03T00"), eviction_apt_num=F.when(c("odd"), "5"), residential_commercial_ind=F.lit("Residential"))
    return _counted(records.evictions(d, _crosswalk(spark, sf_dir)))


@query(counted_sql(OWN_OR_NAMED, DAY, "l_linestatus", "concat('Tenant Action / ', l_linestatus)"))
def r09_litigation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _counted(records.litigation(_lines(spark, sf_dir, bbl=c("own"), caseopendate=c("day"), casetype=F.lit("Tenant Action"), casestatus=c("l_linestatus"))))


@query(f"SELECT {LOT} AS bbl, strftime(o_orderdate, '%Y-%m-%d') AS event_date, CASE WHEN o_orderkey % 5 > 0 THEN o_totalprice END AS amount, CASE WHEN o_orderstatus = 'F' THEN 'DEED' ELSE 'DEEDO' END AS detail FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE o_orderstatus IN ('F', 'O') AND l_suppkey % 7 = 2")
def r10_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = c("o_orderstatus")
    master = read(spark, sf_dir, "orders").select(text(c("o_orderkey")).alias("document_id"), F.when(s == "F", "DEED").when(s == "O", "DEEDO").otherwise("MTGE").alias("doc_type"), F.when(c("o_orderkey") % 5 > 0, text(c("o_totalprice"))).otherwise("0").alias("document_amt"), F.lit("").alias("recorded_datetime"), F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm").alias("document_date"))
    legals = _lines(spark, sf_dir, document_id=text(c("l_orderkey")), borough=c("boroid")).drop("boroid")
    return records.acris_sales(master, legals, 2).select("bbl", "event_date", "amount", "detail")


@query(f"SELECT coalesce(CASE WHEN c_custkey % 3 = 0 THEN printf('%010d', 2000000000 + c_custkey) END, bbl) AS bbl, '2020-02-03' AS event_date, 'Open' AS party, 'NOISE' AS detail, count(*) AS n FROM {FIRST_BBL} WHERE coalesce(CASE WHEN c_custkey % 3 = 0 THEN 'x' END, bbl) IS NOT NULL GROUP BY ALL")
def r11_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = c("c_custkey")
    d = _found(spark, sf_dir, bbl=F.when(k % 3 == 0, text(k + 2_000_000_000)).otherwise("0"), incident_address=F.concat(c("house"), F.lit(" Main St")), incident_zip=c("zip"), created_date=F.lit("2020-02-03T01"), complaint_type=F.lit("NOISE"), status=F.lit(" Open "))
    return _counted(records.requests(d, _crosswalk(spark, sf_dir)))


@query("SELECT printf('%010d', 1000000000 + p_partkey) AS bbl, CASE WHEN p_size % 3 = 0 THEN p_size END::INTEGER AS rent_stab_units, CASE p_size % 3 WHEN 0 THEN 'registered' WHEN 1 THEN 'j51-proxy (2025)' ELSE '421a-proxy (2026)' END AS rent_stab_status, 2017 AS rent_stab_year FROM part WHERE p_partkey % 8 > 0")
def r12_rent_stabilization(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, s = c("p_partkey"), c("p_size")
    d = read(spark, sf_dir, "part").select(text(k + 1_000_000_000).alias("ucbbl"), F.when((k % 8 > 0) & (s % 3 == 0), F.concat(F.lit(" "), text(s))).when(k % 8 > 0, "0").otherwise("12.5").alias("unitsstab2017"), F.when((k % 8 > 0) & (s % 3 == 1), " 2025 ").otherwise("").alias("j51"), F.when((k % 8 > 0) & (s % 3 == 2), "2026").alias("a421"))
    return records.rent_stabilization(d)


# Listing feeds.
FIELDS = ["source_id", "address", "unit_number", "bedrooms", "bathrooms", "price", "sqft", "borough", "zipcode"]


def _parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "part").select(c("p_partkey").alias("k"), c("p_size").alias("s"), "p_name", "p_brand")


def listing_sql(**columns: str) -> str:
    kinds = {"bedrooms": "DOUBLE", "bathrooms": "DOUBLE", "price": "DOUBLE", "sqft": "DOUBLE"}
    return "SELECT " + ", ".join(f"CAST({columns.get(f, 'NULL')} AS {kinds.get(f, 'VARCHAR')}) AS {f}" for f in FIELDS) + " FROM (SELECT p_partkey AS k, p_size AS s, p_name, p_brand FROM part)" + (f" WHERE {columns['where']}" if "where" in columns else "")


json = lambda **x: F.to_json(F.struct(*[v.alias(n) for n, v in x.items()]))
nest = lambda **x: F.struct(*[v.alias(n) for n, v in x.items()])
lit = F.lit
k, s = (lambda: c("k")), (lambda: c("s"))


def num(x: Column) -> Column:
    return x.cast("double")


@query(listing_sql(source_id="concat('appfolio-sub-', k)", address="concat(k, ' Oak Avenue')", unit_number="concat(s, 'A')", bedrooms="s % 4", bathrooms="1.5", price="1000 + s", sqft="1200", borough="'Brooklyn'", zipcode="'11206'"))
def l01_appfolio(spark: SparkSession, sf_dir: str) -> DataFrame:
    item = json(listing_id=text(k()), address=F.concat(text(k()), lit(" Oak Avenue - "), text(s()), lit("A, Brooklyn, NY 11206")), unit_specs=F.concat(text(s() % 4), lit(" bd, 1.5 ba, 1,200 Sq. Ft. [x]")), rent_range=F.concat(lit("$1,0"), F.lpad(text(s()), 2, "0"), lit(" - $9,999")), latitude=lit(40.5), longitude=lit(-73.9))
    pages = _parts(spark, sf_dir).select(F.concat(lit("<html><script>x = {markers: ["), item, lit("], zoom: 3}</script>")).alias("text"), lit("label").alias("label"), lit("sub").alias("subdomain"))
    return listings.appfolio(pages).select(*FIELDS)


@query(listing_sql(source_id="k", address="concat(k, ' Oak Street')", unit_number="concat(s, 'B')", bedrooms="s % 3", bathrooms="2", price="CASE WHEN k % 2 = 0 THEN 2000 + s ELSE 3000 + s END", sqft="700", borough="CASE WHEN k % 4 = 0 THEN 'Manhattan' ELSE 'Yonkers' END", zipcode="'10001'", where="k % 5 > 0"))
def l02_avalonbay(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = lambda x: nest(prices=nest(price=num(x)))
    item = nest(unitId=text(k()), communityName=lit("c"), bedroomNumber=num(s() % 3), bathroomNumber=lit(2.0), squareFeet=lit(700.0), address=nest(addressLine1=F.concat(text(k()), lit(" Oak Street, Apt "), text(s()), lit("B")), city=F.when(k() % 4 == 0, "New York").otherwise("Yonkers"), state=F.when(k() % 5 > 0, "NY").otherwise("NJ"), zip=lit("10001")), startingAtPricesUnfurnished=F.when(k() % 2 == 0, price(2000 + s())), startingAtPricesFurnished=price(3000 + s()))
    return listings.avalonbay(_parts(spark, sf_dir).select(json(items=F.array(item)).alias("text"))).select(*FIELDS)


@query(listing_sql(source_id="k", address="p_name", unit_number="CASE WHEN k % 2 = 0 THEN 'PH' ELSE 'Loft' END", bedrooms="s % 3", bathrooms="CASE WHEN s % 2 = 0 THEN 1 ELSE 2.5 END", price="2000 + s", sqft="CASE WHEN s % 2 = 0 THEN 500 ELSE 900 END", borough="'Queens'", zipcode="'1'", where="k % 5 IN (0, 1) AND k % 7 > 0"))
def l03_corcoran(spark: SparkSession, sf_dir: str) -> DataFrame:
    item = nest(listingId=text(k()), listingStatus=F.when(k() % 5 == 0, " Active").when(k() % 5 == 1, "").otherwise("Sold"), closedRentedDate=F.when(k() % 7 == 0, "2026-01-01"), address1=c("p_name"), address2=F.when(k() % 2 == 0, "PH").otherwise(""), unitType=lit("Loft"), bedrooms=num(s() % 3), bathrooms=lit(1.0), totalBathrooms=F.when(s() % 2 == 0, 0.0).otherwise(2.5), price=num(2000 + s()), squareFootage=F.when(s() % 2 == 0, 0.0).otherwise(900.0), squareFeetInterior=lit(500.0), boroughName=lit("Queens"), zipCode=lit("1"))
    return listings.corcoran(_parts(spark, sf_dir).select(json(items=F.array(item)).alias("text"))).select(*FIELDS)


@query(listing_sql(source_id="concat('durst-b', k, '-', 10 + n)", address="'5 Main'", unit_number="CASE WHEN n = 0 THEN concat('U', s) ELSE '11' END", bedrooms="CASE WHEN n = 0 THEN s % 3 + 1 ELSE s % 3 + 1 END", bathrooms="1", price="CASE WHEN n = 0 THEN 3000 + s END", sqft="CASE WHEN n = 0 THEN 1050 END", borough="'Manhattan'").replace("FROM part)", "FROM part), (VALUES (0), (1)) v(n)"))
def l04_durst(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second card's heading names no rooms: those of the first are carried on."""
    page = F.concat(lit('<p><h4 class="pc-card-title">'), text(s() % 3 + 1), lit(' Bedroom, 1 Bath</h4><tr data-unitid="10" data-title="U'), text(s()), lit('"><td data-th="Sqft" class="x">1,050</td><select><option value="1"> 6 Months (9,000.00 USD)<option value="2"> 12 Months ('), text(3000 + s()), lit('.00 USD)</select></tr><h4 class="pc-card-title">More</h4><tr data-unitid="11"></tr>'))
    pages = _parts(spark, sf_dir).select(page.alias("text"), F.concat(lit("b"), text(k())).alias("id"), lit("n").alias("name"), lit("5 Main").alias("address"), lit("h").alias("hood"), lit("Manhattan").alias("boro"))
    return listings.durst(pages).select(*FIELDS)


@query(listing_sql(source_id="k", address="concat(k, ' W 10th St')", unit_number="CASE WHEN k % 2 = 0 THEN concat(s, 'C') ELSE '9' END", bedrooms="s % 3", bathrooms="1", price="2000 + s", sqft="800", borough="'first'", zipcode="CASE WHEN k % 2 = 0 THEN '10014' ELSE '5' END", where="k % 5 > 0 AND k % 7 > 0"))
def l05_elliman(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each listing on two pages: the first one's counts."""
    item = nest(coreListingId=text(k()), listingStatus=F.when(k() % 5 > 0, "ACTIVE ").otherwise("Closed"), closeDate=F.when(k() % 7 == 0, "2026"), bedroomsTotal=num(s() % 3), bathroomsTotal=lit(1.0), listPrice=num(2000 + s()), livingAreaSquareFeet=lit(800.0), address=nest(samlsFullAddress=F.concat(text(k()), lit(" W 10th St "), F.when(k() % 2 == 0, F.concat(text(s()), lit("c"))).otherwise(""), lit(", New York, NY 10014-1234")), unitNumber=F.when(k() % 2 == 1, "9"), postalCode=F.when(k() % 2 == 1, "5")))
    d = _parts(spark, sf_dir).select(F.to_json(F.array(item)).alias("text"))
    pages = d.select("text", lit("first").alias("borough"), lit(0).alias("page_no")).union(d.select("text", lit("second"), lit(1)))
    return listings.elliman(pages).select(*FIELDS)


@query(listing_sql(source_id="concat('glenwood-', k)", address="'7 Park'", bedrooms="CASE WHEN s % 2 = 0 THEN s % 5 ELSE 0 END", bathrooms="2", price="CASE WHEN k % 2 = 0 THEN 4000 + s ELSE 5000 + s END", borough="CASE WHEN k % 3 = 0 THEN 'Bronx' ELSE 'Manhattan' END"))
def l06_glenwood(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _parts(spark, sf_dir)
    found = listings.glenwood_ids(d.select(F.concat(lit('<a href="/x?lid='), text(k()), lit('">a</a><a href="/y?z=1&lid='), text(k()), lit('">b</a>')).alias("text"), lit("n").alias("name"), lit("7 Park").alias("addr"), F.when(k() % 3 == 0, "Riverdale").otherwise("Soho").alias("hood")))
    line = lambda x: F.concat(lit('<p class="pprice" id="p">'), x, lit("</p>"))
    page = F.concat(line(F.when(s() % 2 == 0, F.concat(text(s() % 5), lit(" BR"))).otherwise("Studio")), line(lit("2 Bath")), line(lit("212.555.0000")), line(F.concat(lit("5,0"), F.lpad(text(s()), 2, "0"))), F.when(k() % 2 == 0, F.concat(lit('<iframe src="/schedule-appointment-listing-today/?lid='), text(k()), lit("&price="), text(4000 + s()), lit('">'))).otherwise(""))
    return listings.glenwood(found, d.select(text(k()).alias("lid"), page.alias("text"))).select(*FIELDS)


@query(listing_sql(source_id="k", address="CASE WHEN k % 2 = 0 THEN concat(k, ' Main St') ELSE p_name END", unit_number="CASE WHEN s % 2 = 0 THEN concat(s, 'G') END", bedrooms="s % 3", bathrooms="1", price="(2000 + s) / 100.0", sqft="600", borough="CASE WHEN k % 2 = 0 THEN 'Queens' END", zipcode="CASE WHEN k % 2 = 0 THEN '11102' END"))
def l07_nooklyn(spark: SparkSession, sf_dir: str) -> DataFrame:
    item = nest(id=text(k()), price=num(2000 + s()), address=F.when(k() % 2 == 0, F.concat(text(k()), lit(" Main St, Astoria, NY 11102"))).otherwise(c("p_name")), short_address=F.when(s() % 2 == 0, F.concat(lit("5 Main Unit: "), text(s()), lit("G "))).otherwise("5 Main"), bedrooms=num(s() % 3), bathrooms=lit(1.0), square_feet=lit(600.0))
    return listings.nooklyn(_parts(spark, sf_dir).select(json(listings=F.array(item)).alias("text"))).select(*FIELDS)


@query(listing_sql(source_id="concat('ogdencap-c', '-', k)", address="'9 East'", unit_number="concat(s, 'D')", bedrooms="CASE WHEN s % 2 = 0 THEN 2 ELSE 0 END", bathrooms="CASE WHEN s % 2 = 0 THEN 1.5 ELSE 1 END", price="1000 + s", sqft="1100", borough="'Manhattan'"))
def l08_ogdencap(spark: SparkSession, sf_dir: str) -> DataFrame:
    page = F.concat(lit('<td data-th="Unit" x><span y> '), text(s()), lit('D </span></td><a data-alt="'), F.when(s() % 2 == 0, "2 Bed, 1.5 Bath").otherwise("Studio"), lit('"></a><td data-th="Sqft">1,100</td><td data-th="Available">now</td><i data-rent-range=" 1,0'), F.lpad(text(s()), 2, "0"), lit(' - 9,999" data-unitid=" '), text(k()), lit(' " data-unit-address=" 9 East " data-available-date="2026-01-01T00">'))
    pages = _parts(spark, sf_dir).select(page.alias("text"), lit("c").alias("code"), lit("n").alias("name"), lit("h").alias("hood"), lit("Manhattan").alias("boro"))
    return listings.ogdencap(pages).select(*FIELDS)


@query("SELECT concat('sc-sub-', p_size, 'x', p_partkey) AS source_id, 'a' AS address, concat(p_size, 'x', p_partkey) AS unit_number, CASE WHEN p_size % 2 = 0 THEN 2e0 ELSE 0e0 END AS bedrooms, 1e0 AS bathrooms, (1000 + p_size)::DOUBLE AS price, 750e0 AS sqft, CASE WHEN p_size % 3 = 0 THEN '02/03/2026' END AS available_date FROM part")
def l09_securecafe(spark: SparkSession, sf_dir: str) -> DataFrame:
    unit = F.concat(text(s()), lit("x"), text(k()))
    page = F.concat(lit("<caption id=1>Apartment Details for: Floor Plan: "), F.when(s() % 2 == 0, "2 Bedrooms, 1 Bath").otherwise("Studio"), lit("</caption><th data-label='Apartment' x>#"), unit, lit("</th><td data-label=Sq.Ft.>750</td><td data-label='Rent'>$1,0"), F.lpad(text(s()), 2, "0"), lit("</td>"), F.when(s() % 3 == 0, F.concat(lit("<a id='"), unit, lit("' onclick='ApplyNowClick(\"1\",\"2\",\"3\",\"02/03/2026\")'>"))).otherwise(""))
    pages = _parts(spark, sf_dir).select(page.alias("text"), lit("sub").alias("subdomain"), lit("n").alias("label"), lit("a").alias("address"), lit("h").alias("hood"), lit("b").alias("boro"))
    return listings.securecafe(pages).select("source_id", "address", "unit_number", "bedrooms", "bathrooms", "price", "sqft", "available_date")


@query(listing_sql(source_id="concat('stonehenge-', k)", address="CASE WHEN k % 2 = 0 THEN '1 Park Ave' END", unit_number="concat('0', s, 'M')", bedrooms="s % 3", bathrooms="CASE WHEN s % 2 = 0 THEN 1.5 ELSE 1 END", price="1000 + s", borough="'Manhattan'"))
def l10_stonehenge(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.concat(F.when(s() % 3 > 0, F.concat(text(s() % 3), lit(" Bedroom | "))).otherwise("Studio | "), F.when(s() % 2 == 0, "Bath 1.5 | ").otherwise(""), lit("Apt 0"), text(s()), lit("M | $1,0"), F.lpad(text(s()), 2, "0"))
    pages = _parts(spark, sf_dir).select(F.to_json(F.array(nest(value=text(k()), label=label))).alias("text"), F.when(k() % 2 == 0, "p").otherwise("q").alias("code"), lit("n").alias("label"))
    return listings.stonehenge(pages, {"p": "1 Park Ave"}).select(*FIELDS)


@query(listing_sql(source_id="k", address="p_name", unit_number="s", bedrooms="CASE WHEN s % 3 > 0 THEN s % 3 ELSE 0 END", bathrooms="1", price="2000 + s", sqft="650", borough="CASE WHEN k % 2 = 0 THEN 'Manhattan' ELSE '' END", where="k % 5 > 0"))
def l11_stuytown(spark: SparkSession, sf_dir: str) -> DataFrame:
    item = nest(unitSpk=text(k()), unitNumber=text(s()), isAvailable=k() % 5 > 0, bedrooms=F.when(s() % 3 > 0, num(s() % 3)), bathrooms=lit(1.0), price=num(2000 + s()), sqft=lit(650.0), building=nest(name=lit("b"), address=c("p_name")), property=nest(name=F.when(k() % 2 == 0, "P").otherwise("Q")))
    return listings.stuytown(_parts(spark, sf_dir).select(json(unitModels=F.array(item)).alias("text")), {"P": ("East", "Manhattan")}).select(*FIELDS)


@query(listing_sql(source_id="concat('u', k)", address="CASE WHEN k % 2 = 0 THEN 'of property' ELSE p_name END", unit_number="CASE WHEN s % 2 = 0 THEN s::VARCHAR ELSE '' END", bedrooms="s % 3", bathrooms="1", price="2000 + s", borough="CASE WHEN k % 2 = 0 THEN 'Queens' ELSE 'Manhattan' END", zipcode="CASE WHEN k % 2 = 0 THEN '11101' END", where="k % 5 > 0"))
def l12_tfcornerstone(spark: SparkSession, sf_dir: str) -> DataFrame:
    unit = nest(Code=F.concat(lit("u"), text(k())), PropertyCode=F.concat(F.when(k() % 2 == 0, "p").otherwise("none"), text(k())), IsListed=k() % 5 > 0, Address=c("p_name"), Apartment=F.when(s() % 2 == 0, text(s())), NumBedrooms=num(s() % 3), NumBathrooms=lit(1.0), Price=num(2000 + s()))
    prop = nest(Code=F.concat(lit("p"), text(k())), Name=lit("n"), Address=lit("of property"), City=lit("Long Island City"), Zip=lit("11101"))
    return listings.tfcornerstone(_parts(spark, sf_dir).select(json(Units=nest(Data=F.array(unit)), Properties=nest(Data=F.array(prop))).alias("text"))).select(*FIELDS)


@query("SELECT c_mktsegment AS source, count(*) AS rows, true AS live FROM customer GROUP BY 1 UNION ALL SELECT 'nothing', 0, false")
def g29_liveness(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read(spark, sf_dir, "customer").select(c("c_mktsegment").alias("source"))
    return listings.liveness(d, [*sorted(r[0] for r in d.distinct().collect()), "nothing"])


@query("SELECT n_name AS borough, b.bedrooms FROM nation, (SELECT unnest([NULL, 0, 1, 2, 3, 4, 5])::INTEGER AS bedrooms) b WHERE n_nationkey >= 20 UNION ALL SELECT n_name, NULL FROM nation WHERE n_nationkey < 20")
def s16_crawl_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return listings.crawl_buckets(read(spark, sf_dir, "nation").select(c("n_name").alias("borough"), (c("n_nationkey") * 15).alias("ids")))
