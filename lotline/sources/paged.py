"""A paged REST feed as a data source, for batches and streams: ``spark.read.format("paged_feed")`` after ``register(spark)``.

Options: ``url`` (with {offset}, {limit} and, where the feed takes them, {where}, {select}, {order}, {page}), ``fields`` (the columns, comma-separated, text), ``page_size``, ``limit`` (rows in all), ``offset``, ``max_pages``, ``retries``, ``timeout``, ``pause``; ``where``, ``select`` and ``order`` by hand; ``pushdown`` (false: the feed gets no filters). Any scheme that Python's urllib opens will do, so landed pages can be read the same way; so will a plain path and the stores that Arrow opens, whose names are taken as they are.

* Filters and columns: with Spark's ``spark.sql.python.filterPushdown.enabled`` (set by ``register``) the filters of a query on columns are joined to {where}, and {select} is the columns of ``fields``. Spark applies the filters again, so a feed that reads them more widely changes nothing.
* Partitions: ``count`` (a URL with {where}, whose first answer has the number of rows in ``count_field``), or ``page_count_field`` (in the first page's answer), or ``pages`` by hand make a task for each page; of more pages than ``MAX_TASKS``, each task reads a run of them, so none is left out. Without any, pages are read one after another until one is short, ``MAX_PAGES`` at most.
* Answers that aren't a list of rows: ``rows_field`` names the list. ``body`` is posted, with the same places as the URL. ``headers`` is a JSON object.
* Errors: a page that fails after all tries fails the query; if ``fields`` names ``_page_error``, it gives one row with the error there, and the other pages go on.

As a stream, the offset is the number of rows that the feed has (``count`` is needed): it lies in the checkpoint with the batch, so a run that dies between write and commit reads the same pages again into the same batch.
"""

from __future__ import annotations

import json
import time
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from pathlib import Path
from urllib.parse import quote, urlsplit
from urllib.request import Request, urlopen

from pyarrow import fs as pafs
from pyspark.sql import SparkSession
from pyspark.sql import datasource as D
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StringType, StructField, StructType

from lotline.sources.release import place

#: Pages that a feed which doesn't say how many it has should not need.
MAX_PAGES = 100_000
#: Tasks that pages of a known number are dealt to.
MAX_TASKS = 1_000
ERROR = "_page_error"
#: What urllib opens; the rest is a path in a store.
SCHEMES = ("http", "https", "ftp", "file", "data")


def is_url(url: str) -> bool:
    return urlsplit(url).scheme.lower() in SCHEMES


def folder_url(at: str) -> str:
    """What a feed's URLs begin with whose pages lie in a folder that Spark writes: a local one has its odd characters coded, so that the pages' names are the same to both."""
    fs, root = place(at)
    return Path(root).as_uri() if isinstance(fs, pafs.LocalFileSystem) else at


def _body(url: str, headers: dict[str, str] | None, data: bytes | None, timeout: float) -> bytes:
    if is_url(url):
        with urlopen(Request(url, data=data, headers=headers or {}), timeout=timeout) as r:
            return r.read()
    fs, path = place(url)
    with fs.open_input_stream(path, compression=None) as f:
        return f.read()


def fetch(url: str, headers: dict[str, str] | None = None, data: bytes | None = None, timeout: float = 30, retries: int = 4, pause: float = 2.0) -> str:
    """The body as text, broken bytes replaced; each failed try waits a step longer."""
    for attempt in range(retries):
        try:
            return _body(url, headers, data, timeout).decode("utf-8", errors="replace")
        except OSError:
            if attempt == retries - 1:
                raise
            time.sleep(pause * (attempt + 1))
    raise ValueError("retries must be positive")


def literal(value: object) -> str:
    return "'" + str(value).replace("'", "''") + "'"


def clause(f: D.Filter) -> str | None:
    """A filter in the feed's language, or None where it has no word for it."""
    if isinstance(f, D.Not):
        inner = clause(f.child)
        return inner and f"NOT ({inner})"
    column = getattr(f, "attribute", ())
    if len(column) != 1 or not column[0].replace("_", "a").isalnum() or column[0] == ERROR:
        return None
    name, value = column[0], getattr(f, "value", None)
    for kind, sign in ((D.EqualTo, "="), (D.GreaterThanOrEqual, ">="), (D.GreaterThan, ">"), (D.LessThanOrEqual, "<="), (D.LessThan, "<")):
        if isinstance(f, kind) and value is not None:
            return f"{name} {sign} {literal(value)}"
    if isinstance(f, D.In) and f.value and all(v is not None for v in f.value):
        return f"{name} IN ({', '.join(map(literal, f.value))})"
    if isinstance(f, D.IsNotNull):
        return f"{name} IS NOT NULL"
    if isinstance(f, D.IsNull):
        return f"{name} IS NULL"
    if isinstance(f, D.StringStartsWith):
        return f"starts_with({name}, {literal(value)})"
    return None


@dataclass
class Pages(InputPartition):
    first: int
    count: int | None  # None: until a short page
    stop: int | None = None  # row to stop before


class Feed:
    """Requests for pages of a feed, and their rows."""

    def __init__(self, schema: StructType, options: dict[str, str]):
        self.names, self.o = schema.fieldNames(), options
        self.size = int(options.get("page_size", 50_000))
        self.limit = int(options["limit"]) if options.get("limit") else None
        self.start = int(options.get("offset", 0))
        self.where = [f"({options['where']})"] if options.get("where") else []

    def _text(self, template: str, coded: bool, **places: object) -> str:
        asked = {"where": " AND ".join(self.where), "select": self.o.get("select") or ",".join(n for n in self.names if n != ERROR), "order": self.o.get("order", "")}
        for k, v in {**asked, **places}.items():
            template = template.replace("{" + k + "}", quote(str(v)) if coded else str(v))
        return template

    def ask(self, template: str, **places: object) -> object:
        body = self._text(self.o["body"], False, **places).encode() if self.o.get("body") else None
        headers = json.loads(self.o["headers"]) if self.o.get("headers") else None
        return json.loads(fetch(self._text(template, is_url(template), **places), headers, body, float(self.o.get("timeout", 30)), int(self.o.get("retries", 4)), float(self.o.get("pause", 2))))

    def places(self, page: int, want: int) -> dict[str, int]:
        return {"offset": self.start + page * self.size, "limit": want, "page": page + 1}

    def total(self) -> int:
        """Rows that the feed has now, as it says."""
        answer = self.ask(self.o["count"], offset=0, limit=1, page=1)
        first = answer[0] if isinstance(answer, list) else answer
        return int(first[self.o.get("count_field", "count")])

    def known_pages(self) -> int | None:
        if self.o.get("pages"):
            return int(self.o["pages"])
        if self.o.get("count"):
            rows = max(0, self.total() - self.start)
            return -(-min(rows, rows if self.limit is None else self.limit) // self.size)
        if self.o.get("page_count_field"):
            return int(self.ask(self.o["url"], **self.places(0, self.size))[self.o["page_count_field"]])
        return None

    def pages(self, part: Pages) -> Iterator[tuple]:
        most = min(int(self.o.get("max_pages", MAX_PAGES)), MAX_PAGES)
        for page in range(part.first, part.first + (part.count or most)):
            done = page * self.size
            limits = [self.size, *(x - done for x in (self.limit, part.stop) if x is not None)]
            if (want := min(limits)) <= 0:
                return
            try:
                answer = self.ask(self.o["url"], **self.places(page, want))
                rows = answer[self.o["rows_field"]] if self.o.get("rows_field") else answer
            except (OSError, ValueError, KeyError, TypeError) as e:
                if ERROR not in self.names:
                    raise
                yield tuple(f"page {page + 1}: {e}" if n == ERROR else None for n in self.names)
                if part.count is None:
                    return
                continue
            for r in rows:
                yield tuple(None if r.get(n) is None else r[n] if isinstance(r[n], str) else json.dumps(r[n]) for n in self.names)
            if part.count is None and len(rows) < want:
                return


class PagedReader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict[str, str]):
        self.feed = Feed(schema, options)

    def pushFilters(self, filters: list[D.Filter]) -> Iterable[D.Filter]:
        if self.feed.o.get("pushdown", "true") != "false":
            self.feed.where += [c for c in map(clause, filters) if c]
        return filters

    def partitions(self) -> Sequence[Pages]:
        n = self.feed.known_pages()
        if n is None:
            return [Pages(0, None)]
        run = max(1, -(-n // MAX_TASKS))
        return [Pages(i, min(run, n - i)) for i in range(0, n, run)]

    def read(self, partition: Pages) -> Iterator[tuple]:
        return self.feed.pages(partition)


class PagedStream(DataSourceStreamReader):
    def __init__(self, schema: StructType, options: dict[str, str]):
        if not options.get("count"):
            raise ValueError("a stream needs count: a feed's end is its offset")
        self.feed = Feed(schema, options)

    def initialOffset(self) -> dict:
        return {"rows": 0}

    def latestOffset(self) -> dict:
        return {"rows": max(0, self.feed.total() - self.feed.start)}

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        """Whole pages of the batch's own rows: the first begins where the last batch ended."""
        size, out, at = self.feed.size, [], start["rows"]
        while at < end["rows"]:
            out.append(Rows(at, min(size, end["rows"] - at)))
            at += size
        return out

    def read(self, partition: Rows) -> Iterator[tuple]:
        f = self.feed
        answer = f.ask(f.o["url"], offset=f.start + partition.at, limit=partition.n, page=partition.at // f.size + 1)
        for r in answer[f.o["rows_field"]] if f.o.get("rows_field") else answer:
            yield tuple(None if r.get(n) is None else r[n] if isinstance(r[n], str) else json.dumps(r[n]) for n in f.names)

    def commit(self, end: dict) -> None:
        """Nothing to tell the feed: the offset is in the checkpoint."""


@dataclass
class Rows(InputPartition):
    at: int
    n: int


class PagedFeed(DataSource):
    @classmethod
    def name(cls) -> str:
        return "paged_feed"

    def schema(self) -> StructType:
        return StructType([StructField(f.strip(), StringType()) for f in self.options["fields"].split(",")])

    def _options(self) -> dict[str, str]:
        return {k.lower(): v for k, v in self.options.items()}

    def reader(self, schema: StructType) -> PagedReader:
        return PagedReader(schema, self._options())

    def streamReader(self, schema: StructType) -> PagedStream:
        return PagedStream(schema, self._options())


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(PagedFeed)
