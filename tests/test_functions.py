import math
import uuid

import pytest
from pyspark.sql import functions as F

from lotline.functions import dates, documents, geo, ids, numbers


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_bbls(spark):
    o = lambda c: one(spark, c)
    s = F.lit
    assert o(ids.assembled_bbl(s("3"), s("12"), s(" 7 "))) == "3000120007"
    assert o(ids.assembled_bbl(s("9"), s("12"), s("7"))) is None and o(ids.assembled_bbl(s("9"), s("12"), s("7"), ranged=False)) == "9000120007"
    assert o(ids.assembled_bbl(s("BRONX"), s("12"), s("7"))) is None and o(ids.named_bbl(s("bronx "), s("12"), s("7"))) == "2000120007"
    assert o(ids.assembled_bbl(s("1"), s("123456"), s("7"))) == "11234560007"
    assert o(ids.own_or(s("1000010001"), s("x"))) == "1000010001" and o(ids.own_or(s("10"), s("x"))) == "x"
    assert o(ids.float_bbl(s("2054800111.00000000"))) == "2054800111" and o(ids.float_bbl(s("n/a"))) is None
    assert o(ids.catalog_bbl(s("6000000000"))) is None and o(ids.catalog_bbl(s("1000000001.9"))) == "1000000001"
    assert o(ids.file_bbl(s("1"), s("23"), s("4"))) == "1000230004" and o(ids.file_bbl(s("1"), s(""), s("4"))) is None


def test_ids(spark):
    import hashlib

    sep = "\\x1f"
    assert len(sep) == 4
    want = "unit_" + hashlib.sha256(f"1{sep}{sep}6B".encode()).hexdigest()[:20]
    assert one(spark, ids.catalog_id("unit", F.lit(1), F.lit(None).cast("string"), F.lit("6B"))) == want
    assert one(spark, ids.name_uuid(F.lit("a"), F.lit("b"))) == uuid.uuid5(uuid.NAMESPACE_URL, "a|b").hex
    for i in range(40):
        assert one(spark, ids.name_uuid(F.lit(str(i)))) == uuid.uuid5(uuid.NAMESPACE_URL, str(i)).hex


def test_boroughs():
    assert [ids.borough_code(x) for x in (None, "bk", " Kings", 4, "STATEN ISLAND", "ny")] == [None, 3, 3, 4, 5, 1]
    with pytest.raises(ValueError):
        ids.borough_code("atlantis")


def test_dates(spark):
    o = lambda c: one(spark, c)
    assert o(dates.iso_date(F.lit("2021-04-08T00:00:00.000"))) == "2021-04-08" and o(dates.iso_date(F.lit(""))) is None and o(dates.iso_date(F.lit("02/06/26"))) == "02/06/26"
    assert [o(dates.slashed_date(F.lit(x))) for x in ("2/6/2026", "12/31/1999", "2026-01-02T00", "")] == ["2026-02-06", "1999-12-31", "2026-01-02", None]
    assert o(dates.seen_seconds(F.lit("1970-01-02 00:00:01"))) == 86401 and o(dates.seen_seconds(F.lit("soon"))) == 0
    assert o(dates.horizon(F.lit("2026-01-01"))) == "2026-06-30"
    assert [o(dates.timing(F.lit(x).cast("string"), "2026-01-01")) for x in (None, "", "2026-01-01", "2025-12-31")] == ["missing", "missing", "unexpired", "expired"]


def test_numbers(spark):
    o = lambda c: one(spark, c)
    assert [o(numbers.truncated(F.lit(x))) for x in ("42.9", "-1.5", "x")] == [42, -1, None]
    assert [o(numbers.strict_int(F.lit(x))) for x in (" 42 ", "42.0", "")] == [42, None, None]
    assert o(numbers.positive(F.lit("-3"))) is None and o(numbers.positive(F.lit("3.5"))) == 3.5
    assert [o(numbers.half_even(F.lit(x))) for x in (0.5, 1.5, 2.5)] == [0, 2, 2]
    assert o(numbers.ratio(F.lit(1), F.lit(0))) == 0.0 and o(numbers.ratio(F.lit(1), F.lit(3), 6)) == 0.333333
    terms = F.array(*[F.struct(F.lit(t).alias("term"), F.lit(p).alias("price")) for t, p in (("24 months", 90), ("12 months", 100))])
    assert o(numbers.term_price(terms)) == 100 and o(numbers.term_price(F.slice(terms, 1, 1))) == 90


def test_geo(spark):
    o = lambda c: one(spark, c)
    d = o(geo.haversine(F.lit(40.7128), F.lit(-74.0060), F.lit(40.7580), F.lit(-73.9855)))
    a = math.sin(math.radians(0.0452) / 2) ** 2 + math.cos(math.radians(40.7128)) * math.cos(math.radians(40.758)) * math.sin(math.radians(0.0205) / 2) ** 2
    assert d == pytest.approx(2 * 6_371_000 * math.asin(math.sqrt(a)))
    square = geo.ring_literal([(0, 0), (0, 2), (2, 2), (2, 0)])
    other = geo.ring_literal([(5, 5), (5, 6), (6, 6)])
    assert o(geo.in_ring(F.lit(1.0), F.lit(1.0), square)) and not o(geo.in_ring(F.lit(3.0), F.lit(1.0), square))
    assert o(geo.in_rings(F.lit(1.0), F.lit(1.0), F.array(other, square))) and not o(geo.in_ring(F.lit(None).cast("double"), F.lit(1.0), square))
    assert [o(geo.census_geoid(F.lit(b), F.lit(t).cast("string"))) for b, t in (("1", "12"), ("5", "012345"), ("9", "1"), ("1", "abc"), ("1", None), ("1", "1234567"))] == ["36061000012", "36085012345", None, None, None, None]


def test_documents(spark):
    o = lambda c: one(spark, c)
    page = 'x markers: [ {"a": "]"}, {"a": "q\\"["} ] ] y'
    assert o(documents.embedded_array("markers:")(F.lit(page))) == '[ {"a": "]"}, {"a": "q\\"["} ]'
    assert o(documents.embedded_array("markers:")(F.lit("none"))) == "[]" and documents.closed_array("[[", 0) is None
    rates = F.create_map(F.lit("24"), F.lit(2.0), F.lit("12"), F.lit(1.0))
    assert [tuple(t) for t in o(documents.rate_terms(rates))] == [("12 months", 1.0), ("24 months", 2.0)]
    assert o(documents.sections(F.lit("x<h>a<h>b"), "<h>")) == ["a", "b"] and o(documents.sections(F.lit("x"), "<h>")) == []
    assert [documents.column_number(x) for x in ("A", "Z", "AA", "BC")] == [0, 25, 26, 54]
    d = spark.createDataFrame([(1, None, "z")], "b int, a string, c string")
    assert d.select(documents.canonical_json(["b", "a", "c"]).alias("x")).first()["x"] == '{"a":null,"b":1,"c":"z"}'
