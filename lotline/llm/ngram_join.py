"""Jaccard join of word n-grams by prefix filters under several global orders.

A text is the set of its ``NGRAM``-word shingles (A-Z in lower case, words parted by white space; a text of fewer words is one shingle), each a 64-bit hash. Two sets of similarity t or more share a token in their prefixes, whatever global order the prefixes follow; with prefixes longer by l - 1 tokens they share l of them. Three orders are used, and a candidate has to pass all of them before it is verified:

* Hash order, by set: of a set's prefix (``EXTRA`` per cent longer than needed) as many tokens have to occur in other sets' prefixes as its smallest possible partner would share. Sets that only hold a passage that others hold too are out here, for the price of a prefix.
* Rarity, by token: of the sets that are left, tokens are ordered by the number of sets that have them. Sets that share a token of such a prefix form a group; the smaller set of a pair has it in its even shorter index prefix, and groups are dealt by size classes, since sets that differ much in size can't be similar. Tokens of common passages come last and make no group, but for sets that consist of them.
* Hash order and a second, independent one, by pair: both prefixes have to share as many tokens as the shorter one's extra length.

Each member of a group is compared with the group's head, the set with the fewest rarer tokens (the original of a set of copies has none), which links nearly all of it in linear work. Groups that still hold several components are compared further, members outside of the largest component with the others, in blocks (see ``near_dedup.compare_groups``). The filters lose no link, so components are exact. Equal sets meet first and go on as one.

Null texts and texts without words are empty sets, linked with nothing, not even with each other. Rows count by themselves, also those that share a doc_id or have none; a component's id is its least doc_id (null if none has one). Whole texts are read; nothing is capped. An empty table gives an empty result; other columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotline.llm.common import U, materialize, mix
from lotline.llm.near_dedup import compare_groups, components, mixed_groups, verify

NGRAM = 3
#: The least similarity, as tenths.
TENTHS = 9
#: By how many per cent of its size a set's prefix is longer than one shared token asks for.
EXTRA = 5
#: Bytes of text that one step of the token code holds (a longer text alone).
STEP = 1 << 21
BASE = 0x9E3779B97F4A7C15


def _bytes() -> tuple[np.ndarray, np.ndarray]:
    """For each byte a number, the same for both cases of A-Z, and whether it parts words."""
    b = np.arange(256)
    b[65:91] += 32
    space = np.zeros(256, bool)
    space[[32, *range(9, 14)]] = True
    return mix(b.astype(U) + U(1)), space


VALUE, SPACE = _bytes()


def ceil_share(n: np.ndarray) -> np.ndarray:
    """The least overlap of a set of n with one of its size or smaller: ceil(t n)."""
    return -(-TENTHS * n // 10)


def extra(n: np.ndarray) -> np.ndarray:
    return 1 + n * EXTRA // 100


def class_bounds() -> np.ndarray:
    """First sizes of the size classes: a set's larger partner is in its own class or the next."""
    out = [1]
    while out[-1] < 1 << 40:
        out.append(out[-1] * 10 // TENTHS + 1)
    return np.array(out, np.int64)


BOUNDS = class_bounds()


def second_order(tokens: np.ndarray) -> np.ndarray:
    """Another bijection of tokens: their values under it are the second hash order."""
    return mix(tokens ^ U(0xA5A5A5A5A5A5A5A5))


def words_of(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of texts' bytes (one after the other; ``ends`` from 0 on): the words' hashes and each text's number of words."""
    n = len(ends) - 1
    if not len(data):
        return np.zeros(0, U), np.zeros(n, np.int64)
    gap = SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[ends] = True
    before = np.concatenate([[True], gap[:-1]]) | edge[:-1]
    start = np.flatnonzero(~gap & before)
    if not len(start):
        return np.zeros(0, U), np.zeros(n, np.int64)
    word = np.cumsum(~gap & before) - 1
    at = np.arange(len(data)) - start[np.maximum(word, 0)]
    at[gap] = 0
    power = np.full(int(at.max()) + 1, BASE, U)
    power[0] = 1
    term = VALUE[data] * np.cumprod(power, dtype=U)[at]
    term[gap] = 0
    return mix(np.add.reduceat(term, start)), np.diff(np.searchsorted(start, ends))


def token_sets(data: np.ndarray, ends: np.ndarray, k: int = NGRAM) -> list[np.ndarray]:
    """Each text's distinct shingles, sorted."""
    w, count = words_of(data, ends)
    p = U(BASE)
    grams = w[: max(0, len(w) - k + 1)].copy()
    for j in range(1, k):
        grams = grams * p + w[j : len(w) - k + 1 + j]
    grams = mix(grams)
    out, at = [], 0
    for n in count.tolist():
        if n >= k:
            out.append(np.unique(grams[at : at + n - k + 1]))
        elif n:
            h = U(n)
            for x in w[at : at + n]:
                h = U((int(h) * BASE + int(x)) & (1 << 64) - 1)
            out.append(mix(np.array([h], U)))
        else:
            out.append(np.zeros(0, U))
        at += n
    return out


def steps(column: pa.Array) -> Iterator[tuple[int, int, list[np.ndarray]]]:
    """Token sets of a column of texts (null: empty), some rows at a time."""
    lengths = np.array([0 if x is None else x for x in pa.compute.binary_length(column).to_pylist()], np.int64)
    total, i = np.cumsum(lengths), 0
    while i < len(lengths):
        j = max(i + 1, int(np.searchsorted(total, (total[i - 1] if i else 0) + STEP, "right")))
        texts = [x for x in column.slice(i, j - i).cast(pa.binary()).to_pylist() if x]
        yield i, j, token_sets(np.frombuffer(b"".join(texts), np.uint8), np.concatenate([[0], np.cumsum(lengths[i:j])]))
        i = j


def digest(tokens: np.ndarray, seed: int) -> int:
    return int(mix(tokens ^ U(seed * BASE & (1 << 64) - 1)).sum(dtype=U).view(np.int64))


def lists(arrays: list[np.ndarray]) -> pa.Array:
    at = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(at), pa.array(np.concatenate([np.zeros(0, U), *arrays]).view(np.int64)))


def prefix_length(n: int) -> int:
    return int(n - ceil_share(n) + extra(n)) if n else 0


def summaries(docs: DataFrame) -> DataFrame:
    """Of ``docs`` (doc_id, text): doc_id, text_key, n, d1 and d2 (a 128-bit digest of the set), prefix (the least tokens)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j, sets in steps(b.column(2)):
                cols = [pa.array([len(s) for s in sets], pa.int64()), *[pa.array([digest(s, k) for s in sets], pa.int64()) for k in (1, 2)], lists([s[: prefix_length(len(s))] for s in sets])]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), b.column(1).slice(i, j - i), *cols], names=["doc_id", "text_key", "n", "d1", "d2", "prefix"])

    return docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text").mapInArrow(run, "doc_id long, text_key long, n long, d1 long, d2 long, prefix array<long>")


def screened(rows: DataFrame) -> DataFrame:
    """The sets that may have a partner by the first order: node, d1, d2, doc_id and text_key of a row that has it."""
    tokens = rows.select("uid", "d1", F.explode("prefix").alias("token"))
    # copies of one set don't count as others
    shared = tokens.groupBy("token").agg(F.min("d1").alias("a"), F.max("d1").alias("b")).where("a <> b").select("token")
    hits = tokens.select("uid", "token").join(shared, "token", "left_semi").groupBy("uid").agg(F.count(F.lit(1)).alias("hits"))
    # a partner has at least t n tokens, and shares its own extra length
    asked = 1 + F.floor(F.ceil(TENTHS * F.col("n") / 10) * EXTRA / 100)
    left = rows.select("uid", "n", "d1", "d2", "doc_id", "text_key").join(hits, "uid").where(F.col("hits") >= asked)
    one = left.groupBy("d1", "d2").agg(F.min(F.struct("doc_id", "text_key")).alias("r"))
    return materialize(one.select(F.monotonically_increasing_id().alias("node"), "d1", "d2", "r.doc_id", "r.text_key"))


def whole_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """Of the wanted sets: node, n, size_class, bag (the sorted tokens as little-endian 64-bit numbers), by_hash and by_second (prefixes under both hash orders). Only their texts move; Spark's runtime bloom filter prunes the rest at the scan where the table is large."""
    w = wanted.select("node", F.col("doc_id").alias("__id"), F.col("text_key").alias("__key")).hint("merge")
    d = docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    texts = d.join(w, d["doc_id"].eqNullSafe(w["__id"]) & (d["text_key"] == w["__key"])).groupBy("node").agg(F.first("text").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j, sets in steps(b.column(1)):
                n = np.array([len(s) for s in sets], np.int64)
                second = [np.sort(second_order(s))[: prefix_length(len(s))] for s in sets]
                cols = [pa.array(n), pa.array((np.searchsorted(BOUNDS, n, "right") - 1).astype(np.int32)), pa.array([s.tobytes() for s in sets], pa.binary()), lists([s[: prefix_length(len(s))] for s in sets]), lists(second)]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), *cols], names=["node", "n", "size_class", "bag", "by_hash", "by_second"])

    return materialize(texts.select("node", "text").mapInArrow(run, "node long, n long, size_class int, bag binary, by_hash array<long>, by_second array<long>"))


def spread(sets: DataFrame) -> DataFrame:
    """node and token, a row each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for node, bag in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                tokens = np.frombuffer(bag.as_buffer(), np.int64)
                for s in range(0, len(tokens), 1 << 16):
                    part = tokens[s : s + (1 << 16)]
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part), node)), pa.array(part)], names=["node", "token"])

    return sets.select("node", "bag").mapInArrow(run, "node long, token long")


def rare_groups(sets: DataFrame) -> DataFrame:
    """Groups by shared tokens of prefixes in order of rarity: band, node, place (how many rarer tokens the set has); bands with the same members once."""
    tokens = spread(sets)
    repeated = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    ranked = tokens.join(repeated, "token").groupBy("node").agg(F.array_sort(F.collect_list(F.struct("df", "token"))).alias("t"))
    r = ranked.join(sets.select("node", "n", "size_class"), "node")
    # tokens that no other set has come first
    ones = F.col("n") - F.size("t")
    length = F.col("n") - F.ceil(TENTHS * F.col("n") / 10) + 1
    index = F.col("n") - F.ceil(2 * TENTHS * F.col("n") / (10 + TENTHS)) + 1
    r = r.select("node", "size_class", ones.alias("ones"), index.alias("index"), F.slice("t", F.lit(1), F.greatest(F.lit(0), length - ones).cast("int")).alias("t"))
    e = r.select("node", "size_class", "ones", "index", F.posexplode("t").alias("pos", "x")).withColumn("place", F.col("ones") + F.col("pos"))
    e = e.select("node", "place", (F.col("place") < F.col("index")).alias("indexed"), F.col("x.token").alias("token"), "size_class")
    # as the smaller set of a pair in its own class, as the larger one in its own and the class before
    e = e.select("node", "place", F.explode(F.array(F.struct(F.col("size_class").alias("c"), "indexed"), F.struct((F.col("size_class") - 1).alias("c"), F.lit(False).alias("indexed")))).alias("k"), "token")
    members = materialize(e.select(F.xxhash64("token", "k.c").alias("band"), "node", "place", "k.indexed"))
    per = members.groupBy("band").agg(F.count(F.lit(1)).alias("n"), F.max("indexed").alias("any"), *[F.bit_xor(F.xxhash64(F.lit(s), "node")).alias(f"h{s}") for s in (1, 2)])
    bands = materialize(per.where("n > 1 AND any").groupBy("n", "h1", "h2").agg(F.min("band").alias("band")).select("band"))
    return materialize(members.join(bands, "band", "left_semi").select("band", "node", "place"))


def pass_all_orders(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sizes allow the similarity and whose prefixes under both hash orders share what they have to."""
    side = lambda s: sets.select(F.col("node").alias(s), *[F.col(c).alias(f"{c}_{s}") for c in ("n", "by_hash", "by_second")])
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    small, large = F.least("n_a", "n_b"), F.greatest("n_a", "n_b")
    asked = 1 + F.floor(small * EXTRA / 100)
    shared: Column = F.size(F.array_intersect("by_hash_a", "by_hash_b")) >= asked
    return both.where((10 * small >= TENTHS * large) & shared & (F.size(F.array_intersect("by_second_a", "by_second_b")) >= asked)).select("a", "b")


def links(sets: DataFrame) -> DataFrame | None:
    """Labels (node, label) of the sets that are linked with another."""
    groups = rare_groups(sets)
    bags = sets.select("node", "bag")
    heads = groups.groupBy("band").agg(F.min(F.struct("place", "node")).alias("h")).select("band", F.col("h.node").alias("head"))
    members = materialize(groups.join(heads, "band").select("band", "node", "head"))
    pairs = members.where("node <> head").select(F.col("node").alias("a"), F.col("head").alias("b")).distinct()
    first = materialize(pass_all_orders(pairs, sets))
    edges = materialize(verify(first, bags).where(F.col("sim") >= TENTHS / 10).select("a", "b"))
    labels = components(edges)
    open_ = members.join(labels, "node", "left").select("band", "node", F.coalesce("label", "node").alias("label"))
    mixed = materialize(mixed_groups(open_))
    if mixed.limit(1).count():
        more = materialize(compare_groups(open_.join(mixed, "band"), bags, TENTHS / 10))
        if more.limit(1).count():
            labels = components(edges.union(more))
    return labels


def join(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id."""
    d = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = materialize(summaries(d).withColumn("uid", F.monotonically_increasing_id()))
    wanted = screened(rows.where("n > 0"))
    sets = whole_sets(d, wanted)
    labelled = wanted.join(links(sets), "node").select("d1", "d2", "label")
    ids = rows.where("n > 0").groupBy("d1", "d2").agg(F.min("doc_id").alias("least"))
    named = ids.join(labelled, ["d1", "d2"], "left")
    # sets without a link are components of their own
    tops = named.where("label IS NOT NULL").groupBy("label").agg(F.min("least").alias("component_id"))
    named = materialize(named.join(tops, "label", "left").select("d1", "d2", F.when(F.col("label").isNull(), F.col("least")).otherwise(F.col("component_id")).alias("component_id")))
    out = rows.select("doc_id", "n", "d1", "d2").join(named, ["d1", "d2"], "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))
