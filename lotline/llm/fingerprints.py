"""Lempel-Ziv phrase fingerprints.

A text's bytes are parsed into dictionary phrases: each phrase is the shortest run that the dictionary lacks, and joins it. The phrase set is hashed, and the fingerprint holds the minimum hash of each of ``BINS`` classes of hashes (16 bits of it, in base64; 0 for an empty class). The share of equal minima estimates the Jaccard similarity of two phrase sets, which falls with compression distance.

Null counts as empty; the fingerprint of an empty text has empty classes only, and two of these are alike by 1. Equal texts have equal fingerprints. Whole texts are parsed, in time linear in their length; a very long one needs memory for the set of its phrases, some 20 times its bytes. Rows with the same doc_id, and those without one, which come first, are ordered by a hash of their text, and rows that repeat in any order. An empty table gives an empty result. Other columns play no part.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from lotline.llm.common import U, materialize, mix

BINS = 128
#: Bytes of text, about, that one task walks.
RANGE_BYTES = 32 << 20
#: Ranges at most: the range sample, the map outputs and the rows that meet in the second step stay small whatever the bytes.
MAX_RANGES = 16_384
SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, role string, part string, at int, text string"


def parse(data: bytes, at: int, seen: set[bytes], phrases: list[bytes]) -> int:
    """Parses ``data`` from ``at``; returns where its last, unfinished phrase begins. A dictionary holds all beginnings of its phrases, so the search may start at the usual length."""
    n, k = len(data), 4
    while at < n:
        if data[at : at + k] in seen:
            k += 1
            while data[at : at + k] in seen:
                if at + k > n:
                    return at
                k += 1
            if at + k > n:
                return at
        else:
            while k > 1 and data[at : at + k - 1] not in seen:
                k -= 1
            if at + k > n:
                k = n - at
                if data[at:] in seen:
                    return at
                while k > 1 and data[at : at + k - 1] not in seen:
                    k -= 1
        p = data[at : at + k]
        seen.add(p)
        phrases.append(p)
        at += k
    return at


def sketch(phrases: list[bytes]) -> np.ndarray:
    out = np.zeros(BINS, np.uint16)
    if phrases:
        h = mix(np.fromiter(map(zlib.crc32, phrases), np.uint32, len(phrases)).astype(U) + U(0x9E3779B97F4A7C15))
        h.sort()
        bins, first = np.unique((h >> U(57)).astype(np.int64) * BINS // 128, return_index=True)
        out[bins] = np.maximum(mix(h[first]) & U(0xFFFF), U(1)).astype(np.uint16)
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    some = (a > 0) | (b > 0)
    return float(((a == b) & some).sum() / some.sum()) if some.any() else 1.0


def text_of(s: np.ndarray) -> str:
    return base64.b64encode(s.astype("<u2").tobytes()).decode()


class Parsed:
    """A text with its fingerprint, and what its edited form shares with it."""

    def __init__(self, text: str):
        self.text, self.n = text, len(text)
        self.cut = self.n - self.n // 4
        data, head = text.encode(), text[: self.cut].encode()
        self.seen: set[bytes] = set()
        self.phrases: list[bytes] = []
        self.at = parse(head, 0, self.seen, self.phrases)
        self.shared = len(self.phrases)
        parse(data, self.at, self.seen, self.phrases)
        self.sketch = sketch(self.phrases)

    def edited(self, other: str) -> tuple[str, np.ndarray]:
        text = self.text[: self.cut] + other[: self.n // 4]
        self.seen.difference_update(self.phrases[self.shared :])
        phrases = self.phrases[: self.shared]
        parse(text.encode(), self.at, self.seen, phrases)
        return text, sketch(phrases)


def fingerprint(text: str | None) -> str:
    return text_of(Parsed(text or "").sketch)


def row(doc_id: int, p: Parsed, other: Parsed) -> tuple:
    text, sk = p.edited(other.text)
    return (doc_id, p.n, hashlib.sha256(text.encode()).hexdigest(), text_of(p.sketch), text_of(sk), likeness(p.sketch, sk), likeness(p.sketch, other.sketch), None, None, None, None)


def batch(rows: list[tuple]) -> pa.RecordBatch:
    names = [x.split()[0] for x in SCHEMA.split(", ")]
    kinds = [{"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string()}[x.split()[1]] for x in SCHEMA.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)


def with_next(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Each document's fingerprint, with those of its edited form and of the next document.

    Documents are dealt by ranges of doc_id (and of their hash and number, so that a frequent doc_id is no task of its own), as many as their bytes ask for, up to ``MAX_RANGES``: the only exchange of texts. A task walks its range in order, as a stream whose memory doesn't depend on the range's size, and hands on only its first and last text, which a second, small step joins.
    """
    d = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    ranges = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(MAX_RANGES, (d.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // RANGE_BYTES))

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at, last, out = uuid.uuid4().hex, TaskContext.get().partitionId(), None, []
        for b in batches:
            for i, t in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                p = Parsed(t.as_py())
                if last is None:
                    out.append((i, *[None] * 6, "first", part, at, p.text))
                else:
                    out.append(row(*last, p))
                last = i, p
                if len(out) >= 500:
                    yield batch(out)
                    out = []
        if last:
            out.append((last[0], *[None] * 6, "last", part, at, last[1].text))
        if out:
            yield batch(out)

    keyed = d.withColumns({"h": F.xxhash64("text"), "n": F.monotonically_increasing_id()})
    ranged = keyed.repartitionByRange(ranges, "doc_id", "h", "n").sortWithinPartitions("doc_id", "h", "n")
    rows = materialize(ranged.select("doc_id", "text").mapInArrow(walk, SCHEMA))
    firsts = rows.where("role = 'first'").select("doc_id", "part", "at", "text")
    # one row a task of the walk
    by = W.orderBy("doc_id", F.xxhash64("text"), "at")
    order = materialize(firsts.withColumn("next_part", F.lead("part").over(by)).withColumn("start", F.first("part").over(by)).select("part", "next_part", "start"))
    order = order.select("part", F.coalesce("next_part", "start").alias("next_part"))
    lasts = rows.where("role = 'last'").select("doc_id", "part", "text").join(order, "part")
    ends = lasts.join(firsts.select(F.col("part").alias("next_part"), F.col("text").alias("next_text")), "next_part").select("doc_id", "text", "next_text")

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield batch([row(i, Parsed(t), Parsed(x)) for i, t, x in zip(*[c.to_pylist() for c in b.columns], strict=True)])

    done = rows.where("role IS NULL").unionByName(ends.mapInArrow(finish, SCHEMA))
    return done.drop("role", "part", "at", "text")
