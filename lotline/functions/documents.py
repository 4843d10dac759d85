"""JSON and HTML of landed pages, as column expressions."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def json_field(raw: Column, schema: str, path: str, default: object = None) -> Column:
    """A nested field of JSON text; the default for what lacks or doesn't parse."""
    out = F.from_json(raw, schema)
    for p in path.split("."):
        out = out[p]
    return out if default is None else F.coalesce(out, F.lit(default))


def canonical_json(columns: Sequence[str]) -> Column:
    """Compact JSON of the columns, sorted by name; null fields are kept."""
    return F.to_json(F.struct(*[F.col(c) for c in sorted(columns)]), {"ignoreNullFields": "false"})


#: Marks a number inside a string while keys are sorted: a character for private use.
_NUMBER = "\ue000"


def canonical_payload(raw: Column) -> Column:
    """JSON text in one form for all that is the same: keys sorted at every depth, ``", "`` and ``": "`` between parts, all but printable ASCII as lower-case \\u escapes (pairs beyond the basic plane), fractions without needless zeros. Null for what isn't JSON or repeats a key. Numbers in exponent notation are written in full.

    A variant sorts the keys; strings and what lies between them are then told apart by one pass of a pattern, so nothing inside a string is taken for a separator.
    """
    string = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'
    tokens = lambda t: F.regexp_extract_all(t, F.lit(f'{string}|[^"]++'), F.lit(0))
    kept = lambda t: F.transform(tokens(t), lambda x: F.when(x.startswith('"'), x).otherwise(F.regexp_replace(x, r"(-?\d+\.\d+)(?![\d.eE])", f'"{_NUMBER}$1"')))
    compact = F.to_json(F.try_parse_json(F.array_join(kept(raw), "")))

    def code(n: Column) -> Column:
        return F.concat(F.lit("\\u"), F.lpad(F.lower(F.hex(n)), 4, "0"))

    def escaped(x: Column) -> Column:
        n = F.ascii(x).cast("long")
        pair = F.concat(code(F.lit(0xD800) + F.shiftright(n - 0x10000, 10)), code(F.lit(0xDC00) + (n - 0x10000).bitwiseAND(0x3FF)))
        return F.when(x.rlike(r"^\\u"), F.lower(x)).when(F.length(x) > 1, x).when((n >= 32) & (n < 127), x).when(n < 0x10000, code(n)).otherwise(pair)

    def written(x: Column) -> Column:
        digits = F.regexp_replace(F.substring(x, F.lit(3), F.length(x) - 3), r"(\.\d+?)0+$", "$1")
        odd = F.array_join(F.transform(F.regexp_extract_all(x, F.lit(r"\\u[0-9A-Fa-f]{4}|\\.|(?s)."), F.lit(0)), escaped), "")
        text = F.when(x.rlike(r"[^ -~]|\\u"), odd).otherwise(x)
        between = F.replace(F.replace(x, F.lit(","), F.lit(", ")), F.lit(":"), F.lit(": "))
        return F.when(x.startswith(f'"{_NUMBER}'), digits).when(x.startswith('"'), text).otherwise(between)

    return F.array_join(F.transform(tokens(compact), written), "")


def rate_terms(rates: Column) -> Column:
    """A map of months to prices as [{term, price}], by months."""
    by_months = lambda x, y: F.when(x["key"].cast("int") < y["key"].cast("int"), -1).when(x["key"].cast("int") > y["key"].cast("int"), 1).otherwise(0)
    entries = F.array_sort(F.map_entries(rates), by_months)
    return F.transform(entries, lambda e: F.struct(F.concat(e["key"], F.lit(" months")).alias("term"), e["value"].alias("price")))


def image_urls(images: Column, most: int | None = None) -> Column:
    """JSON of the urls of an array of struct(url); null for none."""
    urls = F.filter(F.transform(images, lambda i: i["url"]), lambda u: u.isNotNull() & (u != ""))
    if most is not None:
        urls = F.slice(urls, 1, most)
    return F.when(F.size(urls) > 0, F.to_json(urls))


def closed_array(text: str, opening: int) -> str | None:
    """The JSON array that begins at ``opening``; brackets inside strings don't count."""
    depth, quoted, i = 0, False, opening
    while i < len(text):
        c = text[i]
        if quoted:
            if c == "\\":
                i += 1
            elif c == '"':
                quoted = False
        elif c == '"':
            quoted = True
        elif c == "[":
            depth += 1
        elif c == "]":
            depth -= 1
            if not depth:
                return text[opening : i + 1]
        i += 1
    return None


def embedded_array(key: str):
    """A function of an HTML column: the JSON array after ``key`` in a page; '[]' if there is none. A page has one such scan, so Arrow batches of it are small beside parsing."""

    @F.pandas_udf(T.StringType())
    def find(pages: pd.Series) -> pd.Series:
        def one(page: str | None) -> str:
            at = (page or "").find(key)
            at = page.find("[", at) if at >= 0 else -1
            return (closed_array(page, at) if at >= 0 else None) or "[]"

        return pages.map(one)

    return find


def groups(raw: Column, pattern: str, *names: str) -> Column:
    """All matches of a pattern as an array of struct, a field for each group."""
    found = [F.regexp_extract_all(raw, F.lit(pattern), F.lit(i + 1)) for i in range(len(names))]
    return F.arrays_zip(*[f.alias(n) for f, n in zip(found, names, strict=True)])


def sections(raw: Column, boundary: str) -> Column:
    """What follows each boundary (the part before the first is dropped)."""
    parts = F.split(raw, boundary)
    return F.when(F.size(parts) > 1, F.slice(parts, 2, F.size(parts) - 1)).otherwise(F.array().cast("array<string>"))


def column_number(letters: str) -> int:
    """A spreadsheet column: A is 0, AA is 26."""
    n = 0
    for c in letters:
        n = n * 26 + ord(c.upper()) - ord("A") + 1
    return n - 1
