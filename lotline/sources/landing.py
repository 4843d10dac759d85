"""Readers of landed pages and files.

Live requests are no part of this library: pages land as files, one JSON document or HTML page each, and everything after that is here. Paging, filters and limits of the feeds are Spark's own.
"""

from __future__ import annotations

import io
import re
import xml.etree.ElementTree as ET
import zipfile
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lotline.functions.documents import column_number


def feed_rows(spark: SparkSession, path: str, fields: Sequence[str], where: Column | None = None, order: Sequence[Column] = (), limit: int | None = None) -> DataFrame:
    """Rows of landed JSON pages (arrays or lines): every field is text, absent ones null; filters and columns reach the reader."""
    schema = T.StructType([T.StructField(f, T.StringType()) for f in fields])
    d = spark.read.schema(schema).option("multiLine", "true").json(path)
    d = d.where(where) if where is not None else d
    d = d.orderBy(*order) if order else d
    return d.limit(limit) if limit is not None else d


def pages(spark: SparkSession, path: str) -> DataFrame:
    """path, text: one row per landed page, broken bytes replaced."""
    d = spark.read.format("binaryFile").load(path)
    return d.select("path", F.make_valid_utf8(F.col("content").cast("string")).alias("text"))


def csv_rows(spark: SparkSession, path: str, required: Sequence[str] = (), encoding: str = "UTF-8") -> DataFrame:
    """A CSV file with a header, as text; fails at once if a required column lacks."""
    d = spark.read.option("header", "true").option("encoding", encoding).option("multiLine", "true").option("escape", '"').csv(path)
    lacking = [c for c in required if c not in d.columns]
    if lacking:
        raise ValueError(f"{path} lacks the columns {lacking}; it has {d.columns}")
    return d


def fixed_csv(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """Rows of exactly these columns: shorter ones are filled with nulls, longer ones cut."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return spark.read.schema(schema).option("header", "true").option("enforceSchema", "true").option("mode", "PERMISSIVE").csv(path)


def zipped_csv(spark: SparkSession, path: str, member: str, columns: Sequence[str], encoding: str = "latin-1") -> DataFrame:
    """Columns of a CSV file inside a zip archive, found by header name; blank and absent ones are ''. Each archive is one task's work and is read as a stream."""
    import csv

    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns] + [T.StructField("arrival", T.LongType())])

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for content in batch["content"]:
                with zipfile.ZipFile(io.BytesIO(content)) as z, z.open(member) as f:
                    rows = csv.DictReader(io.TextIOWrapper(f, encoding=encoding, newline=""))
                    out: list[tuple] = []
                    for n, r in enumerate(rows):
                        out.append((*[(r.get(c) or "").strip() for c in columns], n))
                        if len(out) == 20_000:
                            yield pd.DataFrame(out, columns=schema.names)
                            out = []
                    if out:
                        yield pd.DataFrame(out, columns=schema.names)

    return spark.read.format("binaryFile").load(path).select("content").mapInPandas(read, schema)


SHEET = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"


def sheet_rows(content: bytes) -> list[dict[str, str]]:
    """The first sheet as dicts of text; row 1 has the names, columns without one are left out."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        shared: list[str] = []
        if "xl/sharedStrings.xml" in z.namelist():
            shared = ["".join(t.text or "" for t in si.iter(f"{SHEET}t")) for si in ET.fromstring(z.read("xl/sharedStrings.xml")).iter(f"{SHEET}si")]
        first = min((n for n in z.namelist() if re.fullmatch(r"xl/worksheets/sheet\d+\.xml", n)), key=lambda n: int(re.search(r"(\d+)\.xml", n)[1]))
        table: list[dict[int, str]] = []
        for row in ET.fromstring(z.read(first)).iter(f"{SHEET}row"):
            cells: dict[int, str] = {}
            for i, c in enumerate(row.iter(f"{SHEET}c")):
                letters = re.match(r"[A-Z]+", c.get("r") or "")
                at = column_number(letters[0]) if letters else i
                value = c.findtext(f"{SHEET}v") or ""
                if c.get("t") == "s" and value:
                    value = shared[int(value)]
                elif c.get("t") == "inlineStr":
                    value = "".join(t.text or "" for t in c.iter(f"{SHEET}t"))
                cells[at] = value
            table.append(cells)
    names = {i: n.strip() for i, n in (table[0] if table else {}).items() if n.strip()}
    return [{n: r.get(i, "") for i, n in names.items()} for r in table[1:]]


def xlsx_rows(spark: SparkSession, path: str, columns: dict[str, str]) -> DataFrame:
    """Rows of workbooks with row_no (from 2), file_sha256 and snapshot_at (the file's time). ``columns``: header -> name."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns.values()] + [T.StructField("row_no", T.LongType()), T.StructField("file_sha256", T.StringType()), T.StructField("snapshot_at", T.StringType())])

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for content, sha, at in zip(b["content"], b["sha"], b["at"], strict=True):
                rows = [(*[r.get(h, "") for h in columns], n, sha, at) for n, r in enumerate(sheet_rows(content), start=2)]
                yield pd.DataFrame(rows, columns=schema.names)

    d = spark.read.format("binaryFile").load(path)
    return d.select("content", F.sha2("content", 256).alias("sha"), F.date_format("modificationTime", "yyyy-MM-dd HH:mm:ss").alias("at")).mapInPandas(read, schema)


def file_provenance(spark: SparkSession, path: str) -> DataFrame:
    """path, sha256, snapshot_at (UTC) of landed files."""
    d = spark.read.format("binaryFile").load(path)
    return d.select("path", F.sha2("content", 256).alias("sha256"), F.date_format("modificationTime", "yyyy-MM-dd HH:mm:ss").alias("snapshot_at"))


def table_rows(spark: SparkSession, url: str, table: str, driver: str = "org.sqlite.JDBC", **options: str) -> DataFrame:
    """A table of an archive database, read-only, where its JDBC driver is on the class path."""
    return spark.read.format("jdbc").options(url=url, dbtable=table, driver=driver, **options).load()
