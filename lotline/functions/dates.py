"""Dates and times. Dates stay text, as feeds write them; the clock is always a parameter."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lotline.functions.text import filled


def iso_date(raw: Column) -> Column:
    """The first ten characters, whatever they are; null for ''."""
    return filled(F.substring(raw.cast("string"), 1, 10))


def slashed_date(raw: Column) -> Column:
    """mm/dd/yyyy as yyyy-mm-dd; else the first ten characters."""
    p = F.split(raw, "/")
    fill = lambda c: F.when(F.length(c) >= 2, c).otherwise(F.lpad(c, 2, "0"))
    return F.when(filled(raw).isNotNull(), F.when(F.size(p) == 3, F.concat(F.get(p, F.lit(2)), F.lit("-"), fill(F.get(p, F.lit(0))), F.lit("-"), fill(F.get(p, F.lit(1))))).otherwise(F.substring(raw, 1, 10)))


def timestamp_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")


def seen_seconds(raw: Column) -> Column:
    """Seconds of 'yyyy-mm-dd hh:mm:ss'; 0 for what doesn't parse."""
    return F.coalesce(F.unix_timestamp(F.try_to_timestamp(raw, F.lit("yyyy-MM-dd HH:mm:ss"))), F.lit(0)).cast("long")


def horizon(day: Column, days: int = 180) -> Column:
    return F.date_format(F.date_add(day.cast("date"), days), "yyyy-MM-dd")


def timing(expires: Column, as_of: str) -> Column:
    """missing, unexpired or expired on a day, by comparison of texts."""
    return F.when(filled(expires).isNull(), "missing").when(expires >= as_of, "unexpired").otherwise("expired")
