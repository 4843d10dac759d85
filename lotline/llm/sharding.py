"""Sharding by histogram sort.

Splitters of a sort key are found by counting: candidate boundaries (probes) are broadcast, every partition counts the exact weight below each, the counts meet on the driver (a number a probe), and each splitter's bracket narrows to the probes around its target. This repeats until all splitters are within tolerance; then rows are exchanged once, by splitter. Finer splitters cut a shard into runs that one task sorts, so no task holds a shard.

The key puts a text's hash first and the row's hashes below it: rows of equal text are neighbours and share a shard as far as the tolerance allows (a boundary moves to the end of its group if that keeps the sizes within it); a group too large for that is split, by doc_id and, for rows that share it or have none, by the row's number.

Null texts have size 1 (no bytes, plus 1) and CRC 0. Repeated rows get slots of their own; ties fall to doc_id and then to the row. A very long text is one row of its size: its shard is as much over as the text is. An empty table gives an empty result. Other columns play no part.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from lotline.llm.common import materialize

#: Shares of a shard by which its boundaries may be off, and by which they may move to keep a group together.
TOLERANCE, GROUP_TOLERANCE, PROBES = 0.002, 0.01, 24
#: Rows of a run, about, and runs, at most: the splitters that the driver holds and sends.
RUN_ROWS, MAX_RUNS = 250_000, 65_536
#: Probes of one count: what is sent to each task, and the numbers that come back.
MOST_PROBES = 200_000
GROUP_BITS, ROW_BITS = 31, 11


def group_key(text: Column, doc_id: Column, uid: Column) -> Column:
    """A key of 63 bits: 32 of the text's hash, 20 of the doc_id's, 11 of the row number's, so that rows of one doc_id can be parted too."""
    t = F.shiftrightunsigned(F.xxhash64(F.coalesce(text, F.lit(""))), 32)
    d = F.shiftrightunsigned(F.xxhash64(F.lit(3), doc_id), 64 - (GROUP_BITS - ROW_BITS))
    r = F.shiftrightunsigned(F.xxhash64(F.lit(5), uid), 64 - ROW_BITS)
    return F.shiftleft(t, GROUP_BITS).bitwiseOR(F.shiftleft(d, ROW_BITS)).bitwiseOR(r)


def bucket_of(key: str, splitters: Sequence[int]) -> Column:
    """The number of splitters that aren't above the key."""
    at = np.array(splitters, np.int64)

    @F.pandas_udf(T.IntegerType())
    def find(k: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(at, k.to_numpy(np.int64), side="right").astype(np.int32))

    return find(F.col(key))


def weight_below(rows: DataFrame, key: str, weight: str, probes: Sequence[int]) -> np.ndarray:
    """The exact weight of the rows whose key lies below each probe (ascending)."""
    counts = rows.select(bucket_of(key, probes).alias("b"), F.col(weight).alias("w")).groupBy("b").agg(F.sum("w").alias("w")).collect()
    per = np.zeros(len(probes) + 1, np.int64)
    for r in counts:
        per[r["b"]] = r["w"]
    return np.cumsum(per)[:-1]


def splitters(rows: DataFrame, key: str, weight: str, targets: Sequence[int], slack: Sequence[float], probes: int = PROBES) -> list[int]:
    """Keys such that the weight below the i-th differs from ``targets[i]`` by ``slack[i]`` at most, or by less than the rows of one key.

    The driver holds a bracket a target, in arrays: two keys and the weights below them. A round probes the brackets that are still open, ``MOST_PROBES`` keys in all, and narrows them by one search.
    """
    lo, hi, total = rows.agg(F.min(key), F.max(key), F.sum(weight)).first()
    if lo is None:
        return [0] * len(targets)
    t, s = np.array(targets, np.int64), np.array(slack, np.float64)
    low, high = np.full(len(t), lo, np.int64), np.full(len(t), min(hi + 1, (1 << 63) - 1), np.int64)
    under, over = np.zeros(len(t), np.int64), np.full(len(t), total, np.int64)
    while True:
        live = np.flatnonzero((np.minimum(t - under, over - t) > s) & (high - 1 > low))
        if not len(live):
            break
        brackets = np.unique(np.stack([low[live], high[live]], axis=1), axis=0)
        n = max(1, min(probes, MOST_PROBES // len(brackets)))
        width = brackets[:, 1] - brackets[:, 0]
        i = np.arange(1, n + 1)
        ask = brackets[:, :1] + width[:, None] // (n + 1) * i + width[:, None] % (n + 1) * i // (n + 1)
        new = np.unique(ask[(ask > brackets[:, :1]) & (ask < brackets[:, 1:])])
        below = weight_below(rows, key, weight, new)
        at = np.searchsorted(below, t[live], side="left")
        up = np.minimum(at, len(new) - 1)
        better = (at < len(new)) & (new[up] < high[live]) & (new[up] > low[live])
        high[live[better]], over[live[better]] = new[up[better]], below[up[better]]
        down = np.maximum(at - 1, 0)
        better = (at > 0) & (new[down] > low[live]) & (new[down] < high[live])
        low[live[better]], under[live[better]] = new[down[better]], below[down[better]]
    return np.where(t - under <= over - t, low, high).tolist()


def at_group_ends(rows: DataFrame, key: str, weight: str, found: Sequence[int], targets: Sequence[int], slack: float) -> list[int]:
    """Moves each splitter to the start or end of the group that it cuts, where that stays within ``slack``."""
    starts = [k >> GROUP_BITS << GROUP_BITS for k in found]
    options = [[s, s + (1 << GROUP_BITS)] for s in starts]
    asked = sorted({k for o in options for k in o if k < 1 << 63})
    below = dict(zip(asked, weight_below(rows, key, weight, asked).tolist(), strict=True))
    out = []
    for k, o, t in zip(found, options, targets, strict=True):
        fits = [x for x in o if x in below and abs(below[x] - t) <= slack]
        out.append(min(fits, key=lambda x: abs(below[x] - t)) if fits else k)
    return out


def shard(docs: DataFrame, shards: int, key: Column | None = None, size: Column | None = None, text: str = "text", doc_id: str = "doc_id", tolerance: float = TOLERANCE) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, shard and slot (its place in the shard, in key order). Shards are near equal in ``size``. A ``key`` of one's own is a long that is never negative."""
    t = F.coalesce(F.col(text), F.lit(""))
    size = F.octet_length(t) + 1 if size is None else size
    numbered = docs.withColumn("__uid", F.monotonically_increasing_id())
    key = group_key(F.col(text), F.col(doc_id), F.col("__uid")) if key is None else key
    rows = materialize(numbered.select(F.col(doc_id).cast("long").alias("doc_id"), size.cast("long").alias("size"), F.crc32(t.cast("binary")).alias("text_crc32"), key.alias("key"), F.col("__uid").alias("uid")))
    n, total = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    runs = min(max(4, n // (shards * RUN_ROWS)), max(1, MAX_RUNS // shards))
    targets = [total * i // (shards * runs) for i in range(1, shards * runs)]
    edge = [i % runs == 0 for i in range(1, shards * runs)]
    slack = [tolerance * total / shards if e else 0.2 * total / (shards * runs) for e in edge]
    found = splitters(rows, "key", "size", targets, slack)
    ends = at_group_ends(rows, "key", "size", [k for k, e in zip(found, edge, strict=True) if e], [x for x, e in zip(targets, edge, strict=True) if e], GROUP_TOLERANCE * total / shards)
    inner = [k for k, e in zip(found, edge, strict=True) if not e]
    cuts = sorted([(k, 1) for k in ends] + [(k, 0) for k in inner])
    shard_of = np.concatenate([[0], np.cumsum([x for _, x in cuts])]).astype(int).tolist()
    dealt = rows.withColumn("run", bucket_of("key", [k for k, _ in cuts]))
    counts = {r["run"]: r["n"] for r in dealt.groupBy("run").agg(F.count(F.lit(1)).alias("n")).collect()}
    first, before, was = [], 0, 0
    for i, s in enumerate(shard_of):
        before, was = (before if s == was else 0), s
        first.append((i, s, before))
        before += counts.get(i, 0)
    table = F.broadcast(docs.sparkSession.createDataFrame(first, "run int, shard int, first long"))  # MAX_RUNS rows at most
    place = F.row_number().over(W.partitionBy("run").orderBy("key", "doc_id", "uid")) - 1
    out = dealt.withColumn("place", place).join(table, "run")
    return out.select("doc_id", "size", "text_crc32", "shard", (F.col("first") + F.col("place")).cast("long").alias("slot"))
