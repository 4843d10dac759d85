"""Listing feeds: each maps landed pages to the listing fields. Requests, keys and sessions are the landing's business.

A feed is a function of a DataFrame of pages (text, and label columns that the landing adds); what a page lacks is null.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from lotline.functions import text as X
from lotline.functions.documents import embedded_array, groups, image_urls, rate_terms, sections
from lotline.functions.numbers import dollars, term_price
from lotline.operators.units import LISTING_FIELDS

c = F.col
FEEDS: dict[str, Callable[..., DataFrame]] = {}
# The sources that resell other sources' ads, and the patterns of feeds' pages.
MARKETPLACES = ["nooklyn"]
CARD = r'<h4\s+class="pc-card-title">'
CARD_TITLE = r"(?s)^(.*?)</h4>"
CARD_UNIT = r'(?s)data-unitid="(\d+)"(.*?)(?=data-unitid="|<h4\s|$)'
CARD_TERM = r'(?i)<option\s+value="\d+">\s*(\d+)\s+Months?\s+\(([\d,.]+)\s+USD\)'
CARD_LABEL = 'data-title="([^"]+)"'
CARD_SQFT = r'data-th="Sqft"[^>]*>\s*([\d,]+)'
CARD_DATE = 'data-available-date="([^"]+)"'
CARD_PLAN = 'data-src="(https://[^"]+)"'
CARD_STABILIZED = 'data-all-dhcr-units="True"'
HOP_ID = r"[?&]lid=(\d+)"
HOP_LINE = r'class="pprice"[^>]*>([^<]+)'
HOP_PRICE = r"schedule-appointment-listing-today/\?lid=\d+[^\"]*?price=(\d+)"
HOP_CONVERTIBLE = r"(?i)CONV(\d)"
HOP_PLAN = r"glenwoodadmin\.com/webdav/images/floorplans/[^\"']+"
HOP_TEXT = r'(?is)class="[^"]*listing-description[^"]*"[^>]*>(.*?)</div>'
HOP_PHONE = r"^\d{3}\.\d{3}"
PLAN = r"(?is)<caption[^>]*>Apartment Details.*?Floor Plan:\s*"
PLAN_ROW = r"(?s)data-label='Apartment'[^>]*>#?(\w+)</th>.*?data-label=Sq\.Ft\.>(\d+)</td>.*?data-label='Rent'>\$([\d,]+)</td>"
PLAN_DATE = r'(?s)^.*?ApplyNowClick\([^,]+,[^,]+,[^,]+,"([^"]+)"'
OGDEN_ROW = r'(?s)data-th="Unit"[^>]*>\s*<span[^>]*>([^<]+)</span>.*?data-alt="([^"]+)".*?data-th="Sqft">([\d,]+)</td>.*?data-th="Available">([^<]+)</td>.*?data-rent-range="([^"]+)".*?data-unitid="([^"]+)".*?data-unit-address="([^"]+)".*?data-available-date="([^"]+)"'


def feed(name: str) -> Callable:
    def add(f: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        FEEDS[name] = f
        return f

    return add


def shaped(d: DataFrame, source: str, **columns: Column) -> DataFrame:
    """All listing fields, those not given as nulls."""
    kinds = {"bedrooms": "double", "bathrooms": "double", "price": "double", "sqft": "double", "latitude": "double", "longitude": "double", "is_flex": "int", "is_rent_stabilized": "int"}
    return d.select(F.lit(source).alias("source"), *[columns.get(f, F.lit(None)).cast(kinds.get(f, "string")).alias(f) for f in LISTING_FIELDS])


def day(raw: Column) -> Column:
    return X.filled(F.substring(raw, 1, 10))


def annual(price: Column) -> Column:
    return F.when(price.isNotNull() & (price != 0), F.to_json(F.array(F.struct(F.lit("annual").alias("term"), price.alias("price")))))


@feed("appfolio")
def appfolio(pages: DataFrame) -> DataFrame:
    """pages: text, label, subdomain. Map markers embedded in the page."""
    kind = "array<struct<listing_id:string,address:string,unit_specs:string,rent_range:string,default_photo_url:string,detail_page_url:string,latitude:double,longitude:double>>"
    d = pages.withColumn("m", F.explode(F.from_json(embedded_array("markers:")(c("text")), kind)))
    a, s = X.parse_listing_address(F.coalesce("m.address", F.lit(""))), X.parse_specs(F.coalesce("m.unit_specs", F.lit("")))
    d = d.withColumns({"a": a, "s": s})
    return shaped(d, "appfolio", source_id=F.concat_ws("-", F.lit("appfolio"), "subdomain", "m.listing_id"), building_name=c("label"), address=c("a.street"), unit_number=c("a.unit"), bedrooms=c("s.bedrooms"), bathrooms=c("s.bathrooms"), price=X.parse_money(c("m.rent_range")), sqft=c("s.sqft"), floor_plan_url=c("m.detail_page_url"), image_urls=F.when(c("m.default_photo_url").isNotNull(), F.to_json(F.array("m.default_photo_url"))), latitude=c("m.latitude"), longitude=c("m.longitude"), neighborhood=F.lit(""), borough=c("a.borough"), zipcode=c("a.zipcode"), is_flex=F.lit(0), is_rent_stabilized=F.lit(0), raw_json=F.to_json("m"))


@feed("avalonbay")
def avalonbay(pages: DataFrame) -> DataFrame:
    """pages: text. New York units; the unfurnished price first."""
    price = "struct<prices:struct<price:double>>"
    kind = f"items array<struct<unitId:string,communityName:string,unitName:string,bedroomNumber:double,bathroomNumber:double,squareFeet:double,furnishStatus:string,availableDateUnfurnished:string,availableDateFurnished:string,address:struct<addressLine1:string,city:string,state:string,zip:string>,startingAtPricesUnfurnished:{price},startingAtPricesFurnished:{price},floorPlan:struct<highResolution:string>>>"
    d = pages.select(F.explode(F.from_json("text", kind)["items"]).alias("u")).where("u.address.state = 'NY'").withColumn("a", X.split_trailing_unit(c("u.address.addressLine1")))
    plan = c("u.floorPlan.highResolution")
    return shaped(d, "avalonbay", source_id=c("u.unitId"), building_name=c("u.communityName"), address=F.coalesce(X.filled(c("a.street")), "u.address.addressLine1"), unit_number=F.coalesce("a.unit", X.filled(c("u.unitName"))), bedrooms=c("u.bedroomNumber"), bathrooms=c("u.bathroomNumber"), price=F.coalesce("u.startingAtPricesUnfurnished.prices.price", "u.startingAtPricesFurnished.prices.price"), sqft=c("u.squareFeet"), available_date=day(F.coalesce(X.filled(c("u.availableDateUnfurnished")), "u.availableDateFurnished")), floor_plan_url=F.when(plan.startswith("http"), plan).otherwise(F.concat(F.lit("https://www.avalonbay.com"), plan)), borough=X.city_borough(X.filled(c("u.address.city"))), zipcode=c("u.address.zip"), is_flex=F.lit(0), is_rent_stabilized=F.lit(0), finish_level=c("u.furnishStatus"), raw_json=F.to_json("u"))


@feed("corcoran")
def corcoran(pages: DataFrame) -> DataFrame:
    """pages: text. Active listings without a closing date."""
    kind = "items array<struct<listingId:string,listingStatus:string,closedRentedDate:string,buildingName:string,address1:string,address2:string,unitType:string,bedrooms:double,bathrooms:double,totalBathrooms:double,price:double,squareFootage:double,squareFeetInterior:double,availableDate:string,dateAvailable:string,listingAttribution:string,listingAgency:string,mediaUrl:string,location:struct<latitude:double,longitude:double>,neighborhoodName:string,boroughName:string,zipCode:string>>"
    d = pages.select(F.explode(F.from_json("text", kind)["items"]).alias("i"))
    status = F.lower(X.strip(F.coalesce("i.listingStatus", F.lit(""))))
    d = d.where(X.filled(c("i.listingId")).isNotNull() & status.isin("", "active") & X.filled(c("i.closedRentedDate")).isNull())
    by = F.coalesce(X.filled(c("i.listingAttribution")), X.filled(c("i.listingAgency")))
    nonzero = lambda x: F.nullif(c(x), F.lit(0.0))
    return shaped(d, "corcoran", source_id=c("i.listingId"), building_name=c("i.buildingName"), address=c("i.address1"), unit_number=F.coalesce(X.filled(c("i.address2")), "i.unitType"), bedrooms=c("i.bedrooms"), bathrooms=F.coalesce(nonzero("i.totalBathrooms"), "i.bathrooms"), price=c("i.price"), sqft=F.coalesce(nonzero("i.squareFootage"), "i.squareFeetInterior"), available_date=F.coalesce(X.filled(c("i.availableDate")), "i.dateAvailable"), lease_terms=annual(c("i.price")), description=F.concat(F.lit("Listed by "), by), image_urls=F.when(X.filled(c("i.mediaUrl")).isNotNull(), F.to_json(F.array("i.mediaUrl"))), latitude=c("i.location.latitude"), longitude=c("i.location.longitude"), neighborhood=c("i.neighborhoodName"), borough=c("i.boroughName"), zipcode=c("i.zipCode"), raw_json=F.to_json("i"))


@feed("durst")
def durst(pages: DataFrame) -> DataFrame:
    """pages: text, id, name, address, hood, boro. Cards with a heading of rooms, each with rows of units and their lease terms. A heading without a number keeps the rooms of the card before it."""
    d = pages.select("*", F.posexplode(sections(c("text"), CARD)).alias("card_no", "card"))
    title = F.regexp_extract("card", CARD_TITLE, 1)
    beds = F.when(F.lower(title).contains("studio"), F.lit(0.0)).otherwise(X.number_before(title, "bed"))
    d = d.withColumns({"beds_here": beds, "baths_here": X.number_before(title, "bath")})

    so_far = W.partitionBy("id").orderBy("card_no").rowsBetween(W.unboundedPreceding, 0)
    d = d.withColumns({"beds": F.coalesce(F.last("beds_here", True).over(so_far), F.lit(0.0)), "baths": F.coalesce(F.last("baths_here", True).over(so_far), F.lit(1.0))})
    d = d.withColumn("u", F.explode(groups(c("card"), CARD_UNIT, "uid", "block")))
    block = c("u.block")
    part = lambda p: X.filled(F.regexp_extract(block, p, 1))
    terms = F.transform(groups(block, CARD_TERM, "months", "price"), lambda t: F.struct(F.concat(t["months"].cast("int").cast("string"), F.lit(" months")).alias("term"), F.regexp_replace(t["price"], ",", "").cast("double").cast("int").alias("price")))
    d = d.withColumn("terms", terms)
    return shaped(d, "durst", source_id=F.concat_ws("-", F.lit("durst"), "id", "u.uid"), building_name=c("name"), address=c("address"), unit_number=F.coalesce(part(CARD_LABEL), "u.uid"), bedrooms=c("beds"), bathrooms=c("baths"), price=term_price(c("terms")), sqft=F.regexp_replace(part(CARD_SQFT), ",", "").try_cast("int"), available_date=part(CARD_DATE), lease_terms=F.when(F.size("terms") > 0, F.to_json("terms")), floor_plan_url=part(CARD_PLAN), neighborhood=c("hood"), borough=c("boro"), is_flex=F.lit(0), is_rent_stabilized=block.contains(CARD_STABILIZED).cast("int"))


@feed("elliman")
def elliman(pages: DataFrame) -> DataFrame:
    """pages: text, borough, page_no. Active leases; of an id that several pages have the first stays."""
    kind = "array<struct<coreListingId:string,listingStatus:string,closeDate:string,closePrice:double,buildingName:string,bedroomsTotal:double,bathroomsTotal:double,listPrice:double,livingAreaSquareFeet:double,brokerAttribution:string,images:array<struct<url:string>>,latLng:struct<lat:double,lng:double>,address:struct<samlsFullAddress:string,samlsPartialAddress:string,unitNumber:string,postalCode:string,neighborhood:string>>>"
    d = pages.select("borough", "page_no", F.posexplode(F.from_json("text", kind)).alias("n", "i")).where(X.filled(c("i.coreListingId")).isNotNull())
    d = d.groupBy(c("i.coreListingId").alias("id")).agg(F.min_by(F.struct("borough", "i"), F.struct("page_no", "n")).alias("r")).select("r.*")
    d = d.where((F.lower(X.strip(F.coalesce("i.listingStatus", F.lit("")))) == "active") & X.filled(c("i.closeDate")).isNull() & F.nullif("i.closePrice", F.lit(0.0)).isNull())
    full = F.coalesce(X.filled(c("i.address.samlsFullAddress")), "i.address.samlsPartialAddress", F.lit(""))
    d = d.withColumn("a", X.split_mls_address(full, c("i.address.unitNumber")))
    return shaped(d, "elliman", source_id=c("i.coreListingId"), building_name=c("i.buildingName"), address=c("a.street"), unit_number=c("a.unit"), bedrooms=c("i.bedroomsTotal"), bathrooms=c("i.bathroomsTotal"), price=c("i.listPrice"), sqft=c("i.livingAreaSquareFeet"), lease_terms=annual(c("i.listPrice")), description=c("i.brokerAttribution"), image_urls=image_urls(c("i.images"), 10), latitude=c("i.latLng.lat"), longitude=c("i.latLng.lng"), neighborhood=c("i.address.neighborhood"), borough=c("borough"), zipcode=F.coalesce(X.filled(c("i.address.postalCode")), X.trailing_zip(X.strip(full))), raw_json=F.to_json("i"))


def crawl_buckets(borough_counts: DataFrame, cap: int = 300, bedrooms: int = 6) -> DataFrame:
    """borough, bedrooms (null: all): the pages a landing should ask for; a borough that reached the cap is asked by bedrooms too."""
    each = F.when(c("ids") >= cap, F.concat(F.array(F.lit(None).cast("int")), F.sequence(F.lit(0), F.lit(bedrooms - 1)))).otherwise(F.array(F.lit(None).cast("int")))
    return borough_counts.select("borough", F.explode(each).alias("bedrooms"))


def glenwood_ids(pages: DataFrame) -> DataFrame:
    """The first hop: distinct listing ids of building pages (text, name, addr, hood)."""
    return pages.select("name", "addr", "hood", F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit(F.lit(HOP_ID)), F.lit(1)))).alias("lid"))


@feed("glenwood")
def glenwood(found: DataFrame, details: DataFrame) -> DataFrame:
    """The second hop: ids joined with their detail pages (lid, text)."""
    d = found.join(details, "lid")
    lines = F.filter(F.transform(F.regexp_extract_all("text", F.lit(F.lit(HOP_LINE)), F.lit(1)), X.strip), lambda x: (x != "") & ~x.rlike(HOP_PHONE))
    d = d.withColumn("lines", lines)
    try_last = lambda f: F.get(F.reverse(F.filter(F.transform("lines", f), lambda x: x.isNotNull())), F.lit(0))
    beds = try_last(lambda x: F.coalesce(X.number_before(x, "BR"), F.when(F.lower(x).contains("studio"), F.lit(0.0))))
    baths = try_last(lambda x: X.number_before(x, "Bath"))
    listed = F.get(F.filter(F.transform("lines", lambda x: F.when(x.rlike(r"^[\d,]+$"), F.regexp_replace(x, ",", "").try_cast("double"))), lambda x: x.isNotNull()), F.lit(0))
    framed = F.regexp_extract(F.col("text"), HOP_PRICE, 1).try_cast("double")
    d = d.withColumns({"beds": F.coalesce(beds, F.regexp_extract("text", HOP_CONVERTIBLE, 1).try_cast("double")), "baths": baths, "price": F.coalesce(framed, listed)})
    d = d.where(c("price").isNotNull() | c("beds").isNotNull())
    plan = X.filled(F.regexp_extract("text", HOP_PLAN, 0))
    about = X.strip(F.regexp_replace(F.regexp_extract("text", HOP_TEXT, 1), "<[^>]+>", ""))
    return shaped(d, "glenwood", source_id=F.concat(F.lit("glenwood-"), "lid"), building_name=c("name"), address=c("addr"), bedrooms=c("beds"), bathrooms=c("baths"), price=c("price"), description=X.filled(about), floor_plan_url=F.concat(F.lit("https://"), plan), neighborhood=c("hood"), borough=F.when(c("hood") == "Riverdale", "Bronx").otherwise("Manhattan"), is_flex=F.lit(0), is_rent_stabilized=F.lit(0))


@feed("nooklyn")
def nooklyn(pages: DataFrame) -> DataFrame:
    """pages: text. Prices in cents."""
    kind = "listings array<struct<id:string,price:double,address:string,short_address:string,bedrooms:double,bathrooms:double,square_feet:double,date_available:string,description:string,latitude:double,longitude:double,neighborhood:struct<name:string>>>"
    d = pages.select(F.explode(F.from_json("text", kind)["listings"]).alias("i")).withColumn("a", X.marketplace_address(c("i.address")))
    return shaped(d, "nooklyn", source_id=c("i.id"), address=c("a.street"), unit_number=X.labelled_unit(c("i.short_address")), bedrooms=c("i.bedrooms"), bathrooms=c("i.bathrooms"), price=dollars(c("i.price")), sqft=c("i.square_feet"), available_date=F.when(F.length("i.date_available") >= 10, F.substring("i.date_available", 1, 10)), description=c("i.description"), latitude=c("i.latitude"), longitude=c("i.longitude"), neighborhood=c("i.neighborhood.name"), borough=X.filled(X.city_borough(c("a.city"))), zipcode=c("a.zipcode"), raw_json=F.to_json("i"))


@feed("ogdencap")
def ogdencap(pages: DataFrame) -> DataFrame:
    """pages: text, code, name, hood, boro. One pattern for a row; the low end of the rent."""
    d = pages.withColumn("u", F.explode(groups(c("text"), OGDEN_ROW, "unit", "alt", "sqft", "shown", "rent", "uid", "addr", "date")))
    return shaped(d, "ogdencap", source_id=F.concat_ws("-", F.lit("ogdencap"), "code", X.strip(c("u.uid"))), building_name=c("name"), address=X.strip(c("u.addr")), unit_number=X.strip(c("u.unit")), bedrooms=F.coalesce(X.number_before(c("u.alt"), "Bed"), F.lit(0.0)), bathrooms=F.coalesce(X.number_before(c("u.alt"), "Bath"), F.lit(1.0)), price=F.regexp_replace(F.regexp_extract("u.rent", r"^\s*([\d,]+)", 1), ",", "").try_cast("double"), sqft=F.regexp_replace("u.sqft", ",", "").try_cast("int"), available_date=F.substring(X.strip(c("u.date")), 1, 10), neighborhood=c("hood"), borough=c("boro"), is_flex=F.lit(0), is_rent_stabilized=F.lit(0))


@feed("securecafe")
def securecafe(pages: DataFrame) -> DataFrame:
    """pages: text, subdomain, label, address, hood, boro. A table for each floor plan; move-in dates from the apply links."""
    d = pages.withColumn("section", F.explode(sections(c("text"), PLAN)))
    head = F.regexp_extract("section", r"^([^<]+)", 1)
    d = d.withColumns({"beds": F.coalesce(X.number_before(head, "Bed"), F.lit(0.0)), "baths": F.coalesce(X.number_before(head, "Bath"), F.lit(1.0))})
    d = d.withColumn("u", F.explode(groups(c("section"), PLAN_ROW, "unit", "sqft", "rent")))
    after = F.expr("substring(section, greatest(1, locate(concat(\"id='\", u.unit, \"'\"), section)))")
    date = F.when(F.expr("locate(concat(\"id='\", u.unit, \"'\"), section) > 0"), X.filled(F.regexp_extract(after, PLAN_DATE, 1)))
    return shaped(d, "securecafe", source_id=F.concat_ws("-", F.lit("sc"), "subdomain", "u.unit"), building_name=c("label"), address=c("address"), unit_number=c("u.unit"), bedrooms=c("beds"), bathrooms=c("baths"), price=F.regexp_replace("u.rent", ",", "").try_cast("double"), sqft=c("u.sqft").try_cast("int"), available_date=date, neighborhood=c("hood"), borough=c("boro"), is_flex=F.lit(0), is_rent_stabilized=F.lit(0))


@feed("stonehenge")
def stonehenge(pages: DataFrame, addresses: dict[str, str]) -> DataFrame:
    """pages: text, code, label. Labels of cards; a code without an address stays without one."""
    d = pages.select("code", c("label").alias("building"), F.explode(F.from_json("text", "array<struct<value:string,label:string>>")).alias("u")).withColumn("s", X.parse_card_label(F.coalesce("u.label", F.lit(""))))
    table = F.create_map(*[F.lit(x) for p in sorted(addresses.items()) for x in p]) if addresses else F.create_map().cast("map<string,string>")
    return shaped(d, "stonehenge", source_id=F.concat(F.lit("stonehenge-"), F.coalesce("u.value", F.lit(""))), building_name=c("building"), address=table[c("code")], unit_number=c("s.unit"), bedrooms=c("s.bedrooms"), bathrooms=c("s.bathrooms"), price=c("s.price"), neighborhood=F.lit(""), borough=F.lit("Manhattan"), is_flex=F.lit(0), is_rent_stabilized=F.lit(0), raw_json=F.to_json("u"))


@feed("stuytown")
def stuytown(pages: DataFrame, places: dict[str, tuple[str, str]]) -> DataFrame:
    """pages: text. Available units with rates by months. ``places``: property -> (neighborhood, borough)."""
    kind = "unitModels array<struct<unitSpk:string,unitNumber:string,isAvailable:boolean,isFlex:boolean,isCapped:boolean,bedrooms:double,bathrooms:double,price:double,sqft:double,availableDate:string,building:struct<name:string,address:string>,property:struct<name:string>,unitRates:map<string,double>,finish:struct<name:string>>>"
    d = pages.select(F.explode(F.from_json("text", kind)["unitModels"]).alias("u")).where("u.isAvailable")
    of = lambda i: F.create_map(*[F.lit(x) for k, v in sorted(places.items()) for x in (k, v[i])])[c("u.property.name")] if places else F.lit("")
    name = F.regexp_replace(F.concat(F.coalesce("u.property.name", F.lit("")), F.lit(" — "), F.coalesce("u.building.name", F.lit(""))), "^[ —]+|[ —]+$", "")
    yes = lambda x: F.coalesce(c(x), F.lit(False)).cast("int")
    return shaped(d, "stuytown", source_id=c("u.unitSpk"), building_name=name, address=c("u.building.address"), unit_number=c("u.unitNumber"), bedrooms=F.coalesce("u.bedrooms", F.lit(0.0)), bathrooms=c("u.bathrooms"), price=c("u.price"), sqft=c("u.sqft"), available_date=day(c("u.availableDate")), lease_terms=F.when(F.size("u.unitRates") > 0, F.to_json(rate_terms(c("u.unitRates")))), neighborhood=F.coalesce(of(0), F.lit("")), borough=F.coalesce(of(1), F.lit("")), is_flex=yes("u.isFlex"), is_rent_stabilized=yes("u.isCapped"), finish_level=c("u.finish.name"), raw_json=F.to_json("u"))


@feed("tfcornerstone")
def tfcornerstone(pages: DataFrame) -> DataFrame:
    """pages: text with two collections: listed units joined with their properties by code."""
    unit = "struct<Code:string,PropertyCode:string,IsListed:boolean,Address:string,Apartment:string,NumBedrooms:double,NumBathrooms:double,Price:double,Availability:string,UnitFeatureCodes:array<string>,Description:string,Floorplan:string,FloorplanPrint:string,Images:array<string>,Neighborhood:string>"
    prop = "struct<Code:string,Name:string,Address:string,Latitude:string,Longitude:string,NeighborhoodCode:string,City:string,Zip:string>"
    kind = f"Units struct<Data:array<{unit}>>, Properties struct<Data:array<{prop}>>"
    d = pages.select(F.from_json("text", kind).alias("x"))
    units = d.select(F.explode("x.Units.Data").alias("u")).where("u.IsListed")
    props = d.select(F.explode("x.Properties.Data").alias("p")).groupBy("p.Code").agg(F.last("p").alias("p")).withColumnRenamed("Code", "code")
    j = units.join(props, c("u.PropertyCode") == c("code"), "left")
    urls = F.transform("u.Images", lambda i: F.coalesce(F.get_json_object(i, "$.FullUrl"), F.when(i.startswith("{"), F.lit("")).otherwise(i)))
    return shaped(j, "tfcornerstone", source_id=c("u.Code"), building_name=F.coalesce("p.Name", F.lit("")), address=F.coalesce("p.Address", "u.Address"), unit_number=F.coalesce("u.Apartment", F.lit("")), bedrooms=F.coalesce("u.NumBedrooms", F.lit(0.0)), bathrooms=c("u.NumBathrooms"), price=c("u.Price"), available_date=day(c("u.Availability")), amenities=F.when(F.size("u.UnitFeatureCodes") > 0, F.to_json("u.UnitFeatureCodes")), description=c("u.Description"), floor_plan_url=F.coalesce(X.filled(c("u.Floorplan")), "u.FloorplanPrint"), image_urls=F.when(F.size("u.Images") > 0, F.to_json(urls)), latitude=c("p.Latitude").try_cast("double"), longitude=c("p.Longitude").try_cast("double"), neighborhood=F.coalesce(X.filled(c("u.Neighborhood")), "p.NeighborhoodCode", F.lit("")), borough=X.city_borough(F.coalesce("p.City", F.lit("New York"))), zipcode=c("p.Zip"), raw_json=F.to_json("u"))


def union_feeds(*feeds: DataFrame) -> DataFrame:
    out = feeds[0]
    for f in feeds[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def liveness(listings: DataFrame, sources: list[str]) -> DataFrame:
    """source, rows, live, the ones that are down first: a feed with rows is live."""
    every = listings.sparkSession.createDataFrame([(s,) for s in sources], "source string")
    n = listings.groupBy("source").agg(F.count(F.lit(1)).alias("rows"))
    out = every.join(n, "source", "left").select("source", F.coalesce("rows", F.lit(0)).alias("rows"))
    return out.withColumn("live", c("rows") > 0).orderBy("live", "source")


