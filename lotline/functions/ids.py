"""Identifiers, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lotline.functions.text import filled, normalize_unit, strip

# Borough codes, their names, and what users and feeds call them.
BOROUGHS = [(1, "MN", "MANHATTAN"), (2, "BX", "BRONX"), (3, "BK", "BROOKLYN"), (4, "QN", "QUEENS"), (5, "SI", "STATEN ISLAND")]
BOROUGH_ALIASES = {"NY": 1, "NEW YORK": 1, "KINGS": 3, "RICHMOND": 5}
#: What parts of an identifier are joined by before hashing: four characters, a backslash first.
SEPARATOR = "\\x1f"
URL_NAMESPACE = "6ba7b8119dad11d180b400c04fd430c8"


def borough_code(name: str | int | None) -> int | None:
    """A user's borough (code, abbreviation, name or county) as 1 to 5; None stays None."""
    if name is None:
        return None
    key = str(name).strip().upper()
    table = {k: code for code, abbr, full in BOROUGHS for k in (str(code), abbr, full)} | BOROUGH_ALIASES
    if key not in table:
        raise ValueError(f"unknown borough {name!r}: use MN, BX, BK, QN, SI, a full name, or 1 to 5")
    return table[key]


def borough_filter(borough: int | None, column: Column, form: str = "code") -> Column | None:
    """Equality in the form that a feed uses; None for no filter."""
    if not borough:
        return None
    code, abbr, name = BOROUGHS[borough - 1]
    return column == {"code": str(code), "abbr": abbr, "name": name}[form]


def all_of(*conditions: Column | None) -> Column | None:
    """The conjunction of those that aren't None."""
    out = None
    for c in conditions:
        if c is not None:
            out = c if out is None else out & c
    return out


def in_borough(bbl: Column, borough: int | None) -> Column:
    return F.lit(True) if not borough else bbl.startswith(str(borough))


def borough_code_of(name: Column) -> Column:
    """The code, as text, of a full borough name in any case."""
    table = F.create_map(*[F.lit(x) for code, _, full in BOROUGHS for x in (full, str(code))])
    return table[F.upper(strip(F.coalesce(name, F.lit(""))))]


def whole(c: Column) -> Column:
    """Digits with a sign, and white space around them, as a number; else null."""
    return c.cast("string").try_cast("long")


def assembled_bbl(borough: Column, block: Column, lot: Column, ranged: bool = True) -> Column:
    """Borough, five digits of block and four of lot (more if they have more). ``ranged``: boroughs 1 to 5 only."""
    b, k, l = whole(borough), whole(block), whole(lot)  # noqa: E741
    ok = b.isNotNull() & k.isNotNull() & l.isNotNull()
    if ranged:
        ok = ok & b.between(1, 5)
    return F.when(ok, F.format_string("%d%05d%04d", b, k, l))


def named_bbl(name: Column, block: Column, lot: Column) -> Column:
    """The same from a full borough name."""
    return assembled_bbl(borough_code_of(name), block, lot)


def ten_digits(bbl: Column) -> Column:
    """A feed's own BBL, if it is ten digits."""
    t = strip(bbl.cast("string"))
    return F.when(t.rlike(r"^\d{10}$"), t)


def own_or(bbl: Column, other: Column) -> Column:
    return F.coalesce(ten_digits(bbl), other)


def float_bbl(raw: Column) -> Column:
    """'2054800111.00000000' as ten digits."""
    n = F.floor(raw.try_cast("decimal(30,10)")).try_cast("long")
    return F.when(n.isNotNull(), F.format_string("%010d", n))


def catalog_bbl(raw: Column) -> Column:
    """The same, of the five boroughs only."""
    n = F.floor(raw.try_cast("decimal(30,10)")).try_cast("long")
    return F.when(n.between(1_000_000_000, 5_999_999_999), F.format_string("%010d", n))


def file_bbl(borough: Column, block: Column, lot: Column) -> Column:
    """Zero-filled parts of a landed file; null if one lacks, longer parts stay whole."""
    fill = lambda c, n: F.when(F.length(c) >= n, c).otherwise(F.lpad(c, n, "0"))
    b, k, l = (filled(strip(c)) for c in (borough, block, lot))  # noqa: E741
    return F.concat(b, fill(k, 5), fill(l, 4))


def catalog_id(prefix: str, *parts: Column) -> Column:
    joined = F.concat_ws(SEPARATOR, *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.concat(F.lit(prefix + "_"), F.substring(F.sha2(joined, 256), 1, 20))


def unit_id(key: Column) -> Column:
    return F.substring(F.sha1(key.cast("binary")), 1, 16)


def portfolio_id(key: Column) -> Column:
    return F.concat(F.lit("pf_"), F.substring(F.sha1(key.cast("binary")), 1, 16))


def name_uuid(*parts: Column) -> Column:
    """Hex digits of the version 5 UUID, in the URL namespace, of the parts joined by '|'."""
    name = F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    h = F.sha1(F.concat(F.unhex(F.lit(URL_NAMESPACE)), F.encode(name, "UTF-8")))
    variant = F.lower(F.hex(F.conv(F.substring(h, 17, 1), 16, 10).cast("int").bitwiseAND(3).bitwiseOR(8)))
    return F.concat(F.substring(h, 1, 12), F.lit("5"), F.substring(h, 14, 3), variant, F.substring(h, 18, 15))


def merge_id(prefix: str, *parts: Column) -> Column:
    return F.concat(F.lit(prefix + "_") if prefix else F.lit(""), F.substring(name_uuid(*parts), 1, 20))


def row_hash(payload: Column) -> Column:
    return F.sha2(payload, 256)


def canonical_unit(bbl: Column, label: Column) -> Column:
    return catalog_id("unit", bbl, normalize_unit(label))
