"""Exact dedup with static binary-fuse filters.

Every load of rows becomes an immutable snapshot: its distinct digests in buckets, and one table of binary-fuse filters, a filter for each bucket, written once. A load is grouped by digest first, so that its own copies meet without any snapshot; then its distinct digests are screened by the filters of all loads before it, in one pass. What all filters deny is new. What one lets pass joins that snapshot's exact bucket, and the texts of both sides are compared byte by byte.

Texts are equal when they are identical after lower-casing A-Z; null counts as empty. Of equal texts the row with the largest doc_id stays (of rows that repeat a doc_id or have none, one stays). Other columns play no part, an empty table gives an empty result, and the length of a text is no matter: only its digest moves, and for filter hits one text a side.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotline.llm.common import U, ascii_lower, materialize, mix

#: Rows in a bucket, about: what one task holds to build or probe a filter.
BUCKET_ROWS = 2_048


class BinaryFuse:
    """A three-wise binary-fuse filter of 8-bit fingerprints over distinct 64-bit keys: about 9 bits a key, 0.4 % false positives, no false negatives."""

    def __init__(self, seed: int, segment: int, count: int, cells: np.ndarray):
        self.seed, self.segment, self.count, self.cells = seed, segment, count, cells

    @staticmethod
    def _places(keys: np.ndarray, seed: int, segment: int, count: int) -> tuple[np.ndarray, np.ndarray]:
        h = mix(keys + U(seed * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
        n = U(segment * count)
        first = ((h >> U(32)) * n) >> U(32)
        mask = U(segment - 1)
        second = (first + U(segment)) ^ ((h >> U(18)) & mask)
        third = (first + U(2 * segment)) ^ (h & mask)
        prints = (h ^ (h >> U(32))).astype(np.uint8)
        return np.stack([first, second, third]).astype(np.int64), prints

    @classmethod
    def build(cls, keys: np.ndarray) -> BinaryFuse:
        keys = np.unique(keys.astype(U))
        n = len(keys)
        segment = 1 << max(2, int(np.floor(np.log(max(n, 2)) / np.log(3.33) + 2.25)))
        factor = max(1.125, 0.875 + 0.25 * np.log(1e6) / np.log(max(n, 2)))
        count = max(1, -(-int(n * factor) // segment) - 2)
        for seed in range(1, 1000):
            if seed % 20 == 0:
                count += max(1, count // 8)
            places, prints = cls._places(keys, seed, segment, count)
            size = segment * (count + 2)
            rounds = cls._peel(places, size, n)
            if rounds is not None:
                cells = np.zeros(size, np.uint8)
                for who, cell in reversed(rounds):
                    cells[cell] = 0  # its own cell takes no part yet
                    cells[cell] = prints[who] ^ cells[places[0, who]] ^ cells[places[1, who]] ^ cells[places[2, who]]
                return cls(seed, segment, count, cells)
        raise RuntimeError("no seed gives a filter")

    @staticmethod
    def _peel(places: np.ndarray, size: int, n: int) -> list[tuple[np.ndarray, np.ndarray]] | None:
        """Rounds of (keys, the cell that each one has alone), all such keys of a round at once; None if a core of keys is left."""
        held = np.bincount(places.ravel(), minlength=size)
        ids = np.zeros(size, np.int64)
        for row in places:
            np.bitwise_xor.at(ids, row, np.arange(n))
        rounds, left = [], n
        while left:
            cell = np.flatnonzero(held == 1)
            if not len(cell):
                return None
            who, first = np.unique(ids[cell], return_index=True)
            cell = cell[first]
            for row in places[:, who]:
                np.subtract.at(held, row, 1)
                np.bitwise_xor.at(ids, row, who)
            rounds.append((who, cell))
            left -= len(who)
        return rounds

    def __contains__(self, key: int) -> bool:
        return bool(self.probe(np.array([key], U))[0])

    def probe(self, keys: np.ndarray) -> np.ndarray:
        places, prints = self._places(keys.astype(U), self.seed, self.segment, self.count)
        c = self.cells
        return prints == c[places[0]] ^ c[places[1]] ^ c[places[2]]


def digests(docs: DataFrame, batch: Column, text: str = "text", doc_id: str = "doc_id", uid: str | None = None) -> DataFrame:
    """A stage table: doc_id, uid (a number for the row), digest (of the normalised text), key (its first 60 bits) and batch."""
    norm = ascii_lower(F.coalesce(F.col(text), F.lit("")))
    number = F.monotonically_increasing_id() if uid is None else F.col(uid)
    df = docs.select(F.col(doc_id).alias("doc_id"), batch.cast("int").alias("batch"), F.sha2(norm, 256).alias("digest"), number.alias("uid"))
    return materialize(df.withColumn("key", F.conv(F.substring("digest", 1, 15), 16, 10).cast("long")))


def group(rows: DataFrame) -> DataFrame:
    """Per batch and digest: the row that would stay and how many there are. Copies meet on the map side, so a large group moves as a row for each task."""
    return rows.groupBy("batch", "digest", "key").agg(F.max(F.struct("doc_id", "uid")).alias("best"), F.count(F.lit(1)).alias("n"))


def build_filters(keys: DataFrame) -> DataFrame:
    """The filters of snapshots, one for each (batch, bucket) of their distinct digests: batch, bucket, seed, segment, count, cells. To be written once and kept with the snapshot."""

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        f = BinaryFuse.build(pdf["key"].to_numpy())
        return pd.DataFrame({"batch": pdf["batch"][:1], "bucket": pdf["bucket"][:1], "seed": [f.seed], "segment": [f.segment], "count": [f.count], "cells": [f.cells.tobytes()]})

    return keys.select("batch", "bucket", "key").groupBy("batch", "bucket").applyInPandas(build, "batch int, bucket int, seed int, segment int, count int, cells binary")


def screen(incoming: DataFrame, filters: DataFrame) -> DataFrame:
    """The rows of ``incoming`` (batch, bucket, key, digest) that a filter of an earlier batch lets pass, with that batch as ``old``: a row for each such filter. One pass over the buckets, whatever the number of snapshots."""

    def probe(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        for r in right.itertuples():
            later = left[left["batch"] > r.batch]
            if len(later):
                f = BinaryFuse(int(r.seed), int(r.segment), int(r.count), np.frombuffer(r.cells, np.uint8))
                out.append(later[f.probe(later["key"].to_numpy())].assign(old=r.batch))
        hit = pd.concat(out) if out else left.head(0).assign(old=pd.Series([], dtype="int32"))
        return hit[["bucket", "digest", "batch", "old"]]

    return incoming.select("batch", "bucket", "key", "digest").groupBy("bucket").cogroup(filters.groupBy("bucket")).applyInPandas(probe, "bucket int, digest string, batch int, old int")


def same_bytes(docs: DataFrame, pairs: DataFrame, text: str = "text", doc_id: str = "doc_id", uid: str | None = None) -> DataFrame:
    """The digests of ``pairs`` (digest, old and new: structs of doc_id and uid) whose texts are all the same bytes. Only texts of filter hits count, found by their digest and number or, without one, doc_id: rows without an id, or sharing one, meet those of their own digest alone. An exchange at every size, as hits grow with the table; Spark's runtime bloom filter prunes the rest at the scan where the table is large."""
    wanted = pairs.select("digest", F.explode(F.array("old", "new")).alias("w")).select("digest", (F.col("w.doc_id") if uid is None else F.col("w.uid")).alias("__wanted")).distinct()
    d = docs.select(F.col(doc_id if uid is None else uid).alias("__id"), ascii_lower(F.coalesce(F.col(text), F.lit(""))).alias("__t")).withColumn("__digest", F.sha2("__t", 256))
    t = wanted.hint("merge").join(d, (wanted["digest"] == d["__digest"]) & wanted["__wanted"].eqNullSafe(d["__id"]))
    return t.groupBy("digest").agg((F.min("__t") == F.max("__t")).alias("__same")).where("__same").select("digest")


def dedup(docs: DataFrame, batch: Column | None = None, text: str = "text", doc_id: str = "doc_id", bucket_rows: int = BUCKET_ROWS, uid: str | None = None) -> DataFrame:
    """One row per document: doc_id, uid, digest, keep_id, group_size, kept.

    ``batch``: the number of the load that a row came with, from 0 on (without it all rows are one load, which meets no snapshot). ``uid``: a column that numbers the rows of a stage table, if there is one.
    """
    rows = digests(docs, F.lit(0) if batch is None else batch, text, doc_id, uid)
    buckets = max(1, rows.count() // bucket_rows)
    groups = materialize(group(rows).withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(buckets)).cast("int")))
    last = groups.agg(F.max("batch")).first()[0]
    filters = materialize(build_filters(groups.where(F.col("batch") < F.lit(last))))
    hits = screen(groups, filters)
    held = groups.select("bucket", "digest", F.col("batch").alias("old"), F.col("best").alias("old_row"))
    exact = hits.join(held, ["bucket", "digest", "old"]).join(groups.select("bucket", "digest", "batch", F.col("best").alias("new_row")), ["bucket", "digest", "batch"])
    pairs = materialize(exact.select("digest", F.col("old_row").alias("old"), F.col("new_row").alias("new")))
    # digests that several loads have and whose bytes agree form one class; the others are a class for each load
    linked = same_bytes(docs, pairs, text, doc_id, uid).withColumn("__linked", F.lit(True))
    g = groups.join(linked, "digest", "left").withColumn("scope", F.when(F.col("__linked"), F.lit(-1)).otherwise(F.col("batch")))
    classes = g.groupBy("digest", "scope").agg(F.max("best").alias("best"), F.sum("n").alias("group_size"))
    final = materialize(g.select("digest", "batch", "scope").join(classes, ["digest", "scope"]).select("digest", "batch", "best", "group_size"))
    out = rows.join(final, ["digest", "batch"])
    return out.select("doc_id", "uid", "digest", F.col("best.doc_id").alias("keep_id"), F.col("group_size").cast("long").alias("group_size"), (F.col("uid") == F.col("best.uid")).alias("kept"))


def loads_of(doc_id: str = "doc_id", loads: int = 2) -> Column:
    """Deals a table that came at once into loads, for a first run: every row belongs to exactly one."""
    return F.pmod(F.xxhash64(F.col(doc_id)), F.lit(loads)).cast("int")


def keep_one(docs: DataFrame, columns: Sequence[str], uid: str, batch: Column | None = None) -> DataFrame:
    """The rows that stay, with ``columns``: every class keeps exactly one row. ``docs`` is a stage table whose rows ``uid`` numbers; its texts move once."""
    out = dedup(docs, batch, uid=uid).where("kept").select(F.col("uid").alias(uid))
    return docs.join(out, uid, "left_semi").select(*columns)
