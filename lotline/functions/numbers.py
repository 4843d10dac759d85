"""Numbers out of feed text: what doesn't parse is null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def floating(c: Column) -> Column:
    return c.try_cast("double")


def truncated(c: Column) -> Column:
    """int(float(x))."""
    return c.try_cast("double").try_cast("bigint")


def positive(c: Column) -> Column:
    return F.when(c.try_cast("double") > 0, c.try_cast("double"))


def strict_int(c: Column) -> Column:
    """Digits with a sign, and white space around them; '42.0' is null."""
    return c.cast("string").try_cast("int")


def dollars(cents: Column) -> Column:
    return cents / F.lit(100.0)


def ratio(part: Column, whole: Column, digits: int | None = None) -> Column:
    """0 where the whole is 0."""
    r = F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))
    return r if digits is None else F.round(r, digits)


def half_even(c: Column) -> Column:
    return F.bround(c, 0).cast("int")


def term_price(terms: Column) -> Column:
    """The price of the term '12 months', else the least."""
    year = F.filter(terms, lambda t: t["term"] == "12 months")
    return F.coalesce(F.get(year, F.lit(0))["price"], F.array_min(F.transform(terms, lambda t: t["price"])))
