"""Addresses, unit labels, owners and other text, as column expressions of built-in functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Spellings and words that results depend on.
ORDINALS = [("FIRST", "1"), ("SECOND", "2"), ("THIRD", "3"), ("FOURTH", "4"), ("FIFTH", "5"), ("SIXTH", "6"), ("SEVENTH", "7"), ("EIGHTH", "8"), ("NINTH", "9"), ("TENTH", "10"), ("ELEVENTH", "11"), ("TWELFTH", "12")]
LISTING_NOISE = [r"\b\d+\s?BEDS?\b", r"\bSTUDIO\b", r"\b\d+\s?BR\b", r"\b\d+\s?BATH\w*\b", r"\bNO FEE\b", r"\bFURNISHED\b", r"\bDUPLEX\b"]
STREET_TYPES = [(" STREET", " ST"), (" AVENUE", " AVE"), (" BOULEVARD", " BLVD"), (" PLACE", " PL"), (" ROAD", " RD"), (" DRIVE", " DR"), (" LANE", " LN"), (" TERRACE", " TERR"), (" PARKWAY", " PKWY"), (" COURT", " CT"), (" SQUARE", " SQ"), (" HIGHWAY", " HWY"), (" TURNPIKE", " TPKE")]
OFFICE_WORDS = [(" FLOOR", " FL"), (" SUITE", " STE"), (" APARTMENT", " APT")]
DIRECTIONS = [("EAST", "E"), ("WEST", "W"), ("NORTH", "N"), ("SOUTH", "S")]
SAME_WORDS = [("SAINT", "ST"), ("FT", "FORT"), ("PLZ", "PLAZA")]
UNIT_WORDS_IN_ADDRESS = "APARTMENT|APT|UNIT|STE|SUITE|FL|FLOOR|RM|ROOM"
UNIT_WORDS = "APT|APARTMENT|UNIT|STE|SUITE|FL|FLOOR|RM|ROOM|NO"
ENDS_OF_STREETS = "ST|AVE|BLVD|PL|RD|DR|LN|TERR|PKWY|CT|SQ|HWY|TPKE|PLAZA|CIRCLE|PARK|WALK|ROW"
ENTITY_ENDINGS = r"L\s*L\s*C|L\s*L\s*P|L\s*P|P\s*L\s*L\s*C|CORP(?:ORATION)?|INC(?:ORPORATED)?|LTD|LIMITED"
NOT_DWELLINGS_EXTRA_FILINGS = ["ALL", "N/A", "NA"]
NOT_DWELLINGS_EXTRA_ARCHIVE = ["FINISHES", "MANAGEMENT"]

#: Python's white space, digits and word boundaries are those of Unicode; so are Java's with this flag.
U = "(?U)"


def strip(c: Column) -> Column:
    """Without white space of any kind at either end."""
    return F.regexp_replace(c, U + r"^\s+|\s+$", "")


def collapse(c: Column) -> Column:
    return strip(F.regexp_replace(c, U + r"\s+", " "))


def filled(c: Column) -> Column:
    """Null for ''."""
    return F.nullif(c, F.lit(""))


def blank_to_null(c: Column) -> Column:
    """Null for what is empty but for white space."""
    return filled(strip(c))


def first_filled(*cs: Column) -> Column:
    """The first that isn't blank, stripped; '' if none is."""
    return F.coalesce(*[blank_to_null(c.cast("string")) for c in cs], F.lit(""))


def first_date(*cs: Column) -> Column:
    """The first that is neither null nor ''."""
    return F.coalesce(*[filled(c.cast("string")) for c in cs])


def blank_as(c: Column, name: str) -> Column:
    return F.coalesce(F.nullif(F.trim(c), F.lit("")), F.lit(name))


def words(c: Column, pairs: list[tuple[str, str]]) -> Column:
    """Whole words by a table, in one pass: what a word becomes is not looked up again."""
    table = F.create_map(*[F.lit(x) for p in pairs for x in p])
    found = F.regexp_extract_all(c, F.lit(U + r"\w+|\W+"), F.lit(0))
    return F.array_join(F.transform(found, lambda w: F.coalesce(table[w], w)), "")


def parts(c: Column, pairs: list[tuple[str, str]]) -> Column:
    """Plain substrings: also inside longer words."""
    for part, to in pairs:
        c = F.replace(c, F.lit(part), F.lit(to))
    return c


def normalize_address(raw: Column) -> Column:
    """House number and street in one spelling; '' for null and for what has no house number or no letter. Each step has the one before it as its only argument, so that a row is normalised once."""
    a = strip(F.upper(F.coalesce(raw, F.lit(""))))
    a = F.regexp_replace(a, "[,.]", " ")
    a = F.regexp_replace(a, U + "|".join(LISTING_NOISE), " ")
    a = words(a, ORDINALS + DIRECTIONS + SAME_WORDS)
    a = parts(a, STREET_TYPES)
    a = F.regexp_replace(a, U + rf"\b(?:{UNIT_WORDS_IN_ADDRESS})\b.*$|#.*$", "")
    a = F.regexp_replace(a, U + r"(\d+)(?:ST|ND|RD|TH)\b", "$1")
    a = F.regexp_replace(a, U + rf"\b({ENDS_OF_STREETS})\s+\d+[A-Z]?$", "$1")
    return F.regexp_replace(collapse(a), r"(?Us)^(?!\d)(?s:.*)$|^.{0,4}$|^[^A-Z]*$", "")


def with_address(df: DataFrame, raw: Column, out: str = "norm_address") -> DataFrame:
    """``df`` with a normalised address. A condition on it, or a join by it, is never moved below it, so the rules run once a row whatever the plan asks of the result."""
    return df.drop(out).select("*", F.explode_outer(F.array(normalize_address(raw))).alias(out))


def normalize_unit(raw: Column) -> Column:
    """Letters and digits of a unit label; a number without leading zeros; '' for null or nothing left."""
    u = F.upper(F.coalesce(raw, F.lit("")))
    u = F.regexp_replace(u, U + rf"\b(?:{UNIT_WORDS})\b\.?", "")
    u = F.regexp_replace(u, "[^A-Z0-9]", "")
    return F.when(u.rlike("^0*[0-9]+$"), F.regexp_replace(u, "^0+(?=[0-9])", "")).otherwise(u)


def normalize_designation(raw: Column) -> Column:
    """As ``normalize_unit``, but with unit words and leading zeros kept."""
    return F.regexp_replace(F.upper(F.coalesce(raw, F.lit(""))), "[^A-Z0-9]", "")


def beds_key(beds: Column) -> Column:
    """1 and 1.0 in one spelling; '' if unknown."""
    return F.coalesce(F.regexp_replace(beds.try_cast("double").cast("string"), r"\.0$", ""), F.lit(""))


def unit_key(address: Column, unit: Column, beds: Column) -> Column:
    """What makes two ads the same home; null without an address or a unit."""
    # '' of either side makes the whole null, and neither is written twice
    some = lambda x: F.nullif(x, F.lit(""))
    return F.concat(some(normalize_address(address)), F.lit("::"), some(normalize_unit(unit)), F.lit("::beds="), beds_key(beds))


def group_key(key: Column, source: Column, source_id: Column) -> Column:
    """``unit_key``, or a key of the row's own."""
    return F.coalesce(key, F.concat_ws("::", F.lit("singleton"), F.coalesce(source, F.lit("")), F.coalesce(source_id, F.lit(""))))


def normalize_owner_name(raw: Column) -> Column:
    """Without the endings of legal forms, however many follow one another."""
    n = collapse(F.regexp_replace(F.upper(F.coalesce(raw, F.lit(""))), "[.,]", " "))
    return strip(F.regexp_replace(n, rf"(?:\s+(?:{ENTITY_ENDINGS}))+\s*$", ""))


def normalize_business_address(raw: Column) -> Column:
    a = F.regexp_replace(F.upper(F.coalesce(raw, F.lit(""))), "[.,#]", " ")
    return collapse(parts(words(a, DIRECTIONS), STREET_TYPES + OFFICE_WORDS))


def cluster_key(bbl: Column, address: Column) -> Column:
    """The office's address, or a key of the building's own."""
    a = normalize_business_address(address)
    return F.when(a != "", a).otherwise(F.concat(F.lit("__no_address__"), bbl))


def join_labels(*cs: Column, sep: str = " / ") -> Column:
    """Labels that aren't empty; null if all are."""
    return filled(F.concat_ws(sep, *[filled(c.cast("string")) for c in cs]))


def clipped(c: Column, most: int = 300) -> Column:
    """At most ``most`` characters, then an ellipsis."""
    return F.when(F.length(c) > most, F.concat(F.regexp_replace(F.substring(c, 1, most), U + r"\s+$", ""), F.lit("…"))).otherwise(c)


def violation_detail(kind: Column, text: Column) -> Column:
    head = F.when(filled(kind).isNotNull(), F.concat(F.lit("Class "), kind))
    return clipped(join_labels(head, strip(text), sep=" "))


def street_address(number: Column, street: Column) -> Column:
    return filled(F.concat_ws(" ", blank_to_null(number), blank_to_null(street)))


def office_address(number: Column, street: Column, apartment: Column, city: Column, state: Column, postcode: Column) -> Column:
    first = filled(F.concat_ws(" ", filled(number), filled(street), F.when(filled(apartment).isNotNull(), F.concat(F.lit("#"), apartment))))
    second = filled(F.concat_ws(" ", filled(city), filled(state), filled(postcode)))
    return filled(F.concat_ws(", ", first, second))


def owner_name(corporation: Column, first: Column, last: Column) -> Column:
    return F.coalesce(filled(corporation), filled(F.trim(F.concat_ws(" ", filled(first), filled(last)))))


def sale_address(address: Column, unit: Column) -> Column:
    """Without the part after the last comma if that repeats the unit."""
    head, tail = F.regexp_extract(address, r"^(.*),([^,]*)$", 1), F.regexp_extract(address, r"^(.*),([^,]*)$", 2)
    same = (normalize_unit(unit) != "") & (normalize_unit(tail) == normalize_unit(unit))
    return F.when(address.contains(",") & same, strip(head)).otherwise(address)


# Street words after which a feed's unit may stand.
MLS_STREET_WORDS = "ST|STREET|AVE|AVENUE|BLVD|BOULEVARD|PL|PLACE|RD|ROAD|DR|DRIVE|LN|LANE|TERR|TERRACE|PKWY|PARKWAY|CT|COURT|SQ|SQUARE"


def split_mls_address(raw: Column, explicit_unit: Column) -> Column:
    """struct(street, unit): one word after a street word, before the first comma, is a unit. AVENUE A to D are streets; a unit given apart wins."""
    head = strip(F.substring_index(raw, ",", 1))
    pattern = rf"(?i)^(?<street>.+?\b(?:{MLS_STREET_WORDS})\b)\s+(?<unit>[A-Z0-9-]+)$"
    street, unit = F.regexp_extract(head, pattern, 1), F.upper(F.regexp_extract(head, pattern, 2))
    lettered = unit.isin("A", "B", "C", "D") & street.rlike(r"(?i)\bAVE(?:NUE)?$")
    given = filled(explicit_unit)
    found = (unit != "") & (given.isNotNull() | ~lettered)
    return F.struct(
        F.when(found, strip(street)).otherwise(F.when(head != "", head).otherwise(raw)).alias("street"),
        F.coalesce(strip(given), F.when(found, unit)).alias("unit"),
    )


def split_trailing_unit(raw: Column) -> Column:
    """struct(street, unit): a trailing apartment, unit or # part."""
    a = strip(F.coalesce(raw, F.lit("")))
    pattern = r"(?i)\s*,?\s*(?:apt\.?|apartment|unit|#)\s*([\w/-]+)\s*$"
    unit = filled(F.regexp_extract(a, pattern, 1))
    return F.struct(F.when(unit.isNull(), a).otherwise(F.regexp_replace(F.regexp_replace(a, pattern, ""), "^[ ,]+|[ ,]+$", "")).alias("street"), unit.alias("unit"))


def parse_listing_address(raw: Column) -> Column:
    """struct(street, unit, borough, zipcode) of '160 Some Avenue - 2A, Brooklyn, NY 11206'. A unit needs a sign or a word before it; New York, NY alone is Manhattan. Of several numbers of five digits the last is the zipcode: a house number may have as many."""
    label = r"(?i)(?:-|#|Apt\.?|Apartment|Unit|Suite|Ste\.?)\s*([\w/]+)(?=\s*,|\s*$)"
    unit = F.regexp_extract(raw, label, 1)
    head = strip(F.substring_index(raw, ",", 1))
    inside = F.regexp_extract(head, r"(?i)^(.*?)(?:-|#|Apt\.?|Apartment|Unit|Suite|Ste\.?)\s*[\w/]+\s*$", 1)
    street = F.when(head.rlike(label), F.regexp_replace(inside, "[ \\-#,]+$", "")).otherwise(head)
    low = F.lower(raw)
    borough = F.lit("")
    borough = F.when(low.rlike("new york,?\\s*(?:ny|new york)"), F.lit("Manhattan")).otherwise(borough)
    for name in ("Manhattan", "Staten Island", "Queens", "Bronx", "Brooklyn"):  # the last one stands before the others
        borough = F.when(low.contains(name.lower()), F.lit(name)).otherwise(borough)
    return F.struct(street.alias("street"), unit.alias("unit"), borough.alias("borough"), filled(F.regexp_extract(raw, r"(?s)^.*\b(\d{5})\b", 1)).alias("zipcode"))


def parse_money(raw: Column) -> Column:
    """The low end of a price or a range of prices; null for 0 or none."""
    return F.nullif(F.regexp_replace(F.regexp_extract(raw, r"([\d,]*\d[\d,]*)", 1), ",", "").try_cast("int"), F.lit(0))


def number_before(raw: Column, word: str, kind: str = "double") -> Column:
    """The number before a word, as in '2 bd'."""
    return F.regexp_replace(F.regexp_extract(raw, rf"(?i)([\d,]+(?:\.\d+)?)\s*{word}", 1), ",", "").try_cast(kind)


def parse_specs(raw: Column) -> Column:
    """struct(bedrooms, bathrooms, sqft) of '3 bd, 2 ba, 1,250 Sq. Ft.'; no bedrooms without a number."""
    return F.struct(F.coalesce(number_before(raw, "bd", "int"), F.lit(0)).alias("bedrooms"), number_before(raw, "ba").alias("bathrooms"), number_before(raw, r"Sq\.?\s*Ft", "int").alias("sqft"))


def parse_card_label(raw: Column) -> Column:
    """struct(bedrooms, bathrooms, unit, price) of '1 Bedroom | Bath 1.0 | Apt 015M | $4945'."""
    return F.struct(
        F.coalesce(number_before(raw, "Bedroom", "int"), F.lit(0)).alias("bedrooms"),
        F.coalesce(F.regexp_extract(raw, r"(?i)Bath\s*([\d.]+)", 1).try_cast("double"), F.lit(1.0)).alias("bathrooms"),
        F.regexp_extract(raw, r"(?i)Apt\s*(\S+)", 1).alias("unit"),
        F.regexp_replace(F.regexp_extract(raw, r"\$([\d,]+)", 1), ",", "").try_cast("int").alias("price"),
    )


def marketplace_address(raw: Column) -> Column:
    """struct(street, city, zipcode) of 'street, city, ST zip'; what doesn't look so is a street."""
    pattern = r"^(.*?),\s*(.*?),\s*[A-Z]{2}\s+(\d{5})"
    part = lambda i: strip(F.regexp_extract(raw, pattern, i))
    fits = raw.rlike(pattern)
    return F.struct(F.when(fits, part(1)).otherwise(F.coalesce(raw, F.lit(""))).alias("street"), F.when(fits, part(2)).otherwise("").alias("city"), F.when(fits, part(3)).alias("zipcode"))


def labelled_unit(raw: Column) -> Column:
    return filled(strip(F.regexp_extract(raw, r"(?i)Unit:\s*(.+)$", 1)))


def trailing_zip(raw: Column) -> Column:
    return filled(F.regexp_extract(raw, r"(\d{5})(?:-\d{4})?$", 1))


# What feeds call the boroughs.
CITY_BOROUGHS = {"New York": "Manhattan", "Brooklyn": "Brooklyn", "Bronx": "Bronx", "Staten Island": "Staten Island", "Astoria": "Queens", "Long Island City": "Queens", "Queens": "Queens", "Jamaica": "Queens", "Flushing": "Queens"}


def mapped(c: Column, table: dict[str, str]) -> Column:
    """By a fixed table; what it lacks passes through."""
    return F.coalesce(F.create_map(*[F.lit(x) for p in table.items() for x in p])[c], c)


def city_borough(city: Column) -> Column:
    return mapped(city, CITY_BOROUGHS)


def strip_tags(html: Column) -> Column:
    return collapse(F.regexp_replace(html, "<[^>]+>", " "))


def routes(raw: Column) -> Column:
    """'N W' as 'N,W'; null for none."""
    return filled(F.array_join(F.filter(F.split(F.trim(raw), r"\s+"), lambda x: x != ""), ","))


def split_labels(raw: Column) -> Column:
    """Labels between commas, semicolons and slashes; one null if there are none."""
    found = F.filter(F.transform(F.split(F.coalesce(raw, F.lit("")), "[,;/]"), strip), lambda x: x != "")
    return F.when(F.size(found) > 0, found).otherwise(F.array(F.lit(None).cast("string")))


def source_label(systems: Column) -> Column:
    """'["X"]' as 'x'."""
    return F.lower(F.regexp_replace(systems, r'^[\[\]"]+|[\[\]"]+$', ""))
