"""Near-duplicate classes by BagMinHash.

A text is the multiset of its five-word shingles (a text of one to four words: one shingle of all of them; words are runs of letters and digits in lower case). Texts with equal multisets are one node. A node's signature holds ``M`` minima of Poisson processes: a shingle's weight axis is cut into dyadic blocks, each with a process of its own, whose points fall on weight levels by the bits of their hash; a point counts for a multiset that reaches its level. Two signatures agree in a component with the probability of the weighted Jaccard similarity.

``BANDS`` bands of ``ROWS`` components give candidate groups. Each member of a group is compared with the group's least node (exact multiset overlap), which links nearly all of a true group in linear work. Of groups that still hold several components, one for each set of members is compared further: the nodes outside of its largest component with all nodes of other components, in blocks of ``BLOCK`` nodes, of which only links come out. Classes are the connected components of the links of similarity ``THRESHOLD`` or more; the class id is the least doc_id.

Every row counts by itself: rows that share a doc_id may have different texts, and rows without one are compared like others (a class of such rows only has a null class id). Null and empty texts, and texts without a word, are equal (empty) multisets: one class. Of a class the row of the least doc_id is kept, of rows that tie any one. An empty table gives an empty result; other columns play no part. Whole texts are read; nothing is capped: a signature misses a pair of similarity 0.8 in all bands with probability 0.0002.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotline.llm.common import U, materialize, mix, released

SHINGLE, THRESHOLD = 5, 0.8
BANDS, ROWS = 28, 6
M = BANDS * ROWS
#: Nodes of a block and bytes of its shingles, for groups that are compared in full.
BLOCK, BLOCK_BYTES = 512, 16 << 20
#: Turns in which a node is compared with one head of its groups.
SINGLE_TURNS = 1
#: Words that one step of the signature code holds.
SLICE_WORDS, SLICE_DOCS = 100_000, 4_000


def words(text: Column) -> Column:
    """Hashes of the words of a text, in order."""
    w = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+")
    return F.transform(F.filter(w, lambda x: x != ""), lambda x: F.xxhash64(x))


def shingles(values: np.ndarray, lengths: np.ndarray, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of a run of documents: document, 52-bit hash, weight; ordered by document and hash."""
    v, n = values.astype(U), len(lengths)
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype(np.int64)
    doc = np.repeat(np.arange(n), lengths)
    at = np.arange(len(v)) - starts[doc]
    p = U(0x9E3779B97F4A7C15) | U(1)
    whole = np.flatnonzero(at + k <= lengths[doc])
    h = np.zeros(len(whole), U)
    for j in range(k):
        h = h * p + v[whole + j]
    short = np.flatnonzero((lengths > 0) & (lengths < k))
    g = np.zeros(len(short), U)
    for j in range(k - 1):
        on = lengths[short] > j
        g[on] = g[on] * p + v[starts[short[on]] + j]
    key = np.concatenate([(doc[whole].astype(U) << U(52)) | (mix(h) >> U(12)), (short.astype(U) << U(52)) | (mix(g + U(1)) >> U(12))])
    key.sort()
    if not len(key):
        return np.zeros(0, np.int64), np.zeros(0, U), np.zeros(0, np.int64)
    new = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    weight = np.diff(np.append(new, len(key)))
    key = key[new]
    return (key >> U(52)).astype(np.int64), key & U((1 << 52) - 1), weight


def bag_minhash(doc: np.ndarray, element: np.ndarray, weight: np.ndarray, n: int, m: int = M) -> np.ndarray:
    """Signatures (n x m) of n multisets, given as (document, element, whole weight). A document without elements has the largest values throughout.

    Points of a process come in rising order; a process ends when its next point lies above all minima of its document, so most end after a point or two.
    """
    blocks = 1 + np.where(weight > 1, np.ceil(np.log2(np.maximum(weight, 1))), 0).astype(np.int64)
    row = np.repeat(np.arange(len(doc)), blocks)
    b = np.arange(len(row)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    low = np.where(b > 0, 1 << np.maximum(b - 1, 0), 0).astype(np.int64)
    length = np.maximum(low, 1)
    process = mix(element[row] + (b.astype(U) << U(56)))
    d, w = doc[row], weight[row]
    x = np.zeros(len(row))
    least = np.full(n * m, np.inf)
    step = 0
    while len(x):
        step += 1
        r = mix(process + U(step * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
        x = x - np.log(((r >> U(11)).astype(np.float64) + 0.5) * 2.0**-53) / length
        r = mix(r ^ U(0xD1B54A32D192ED03))
        to = d * m + (((r >> U(32)) * U(m)) >> U(32)).astype(np.int64)
        level = low + (((r & U(0xFFFFFFFF)) * length.astype(U)) >> U(32)).astype(np.int64)
        ok = level < w
        np.minimum.at(least, to[ok], x[ok])
        on = x < least.reshape(n, m).max(axis=1)[d]
        if not on.all():
            process, d, w, low, length, x = (a[on] for a in (process, d, w, low, length, x))
    return least.reshape(n, m)


def band_hashes(sig: np.ndarray, bands: int = BANDS) -> np.ndarray:
    s = sig.view(U).reshape(len(sig), bands, -1)
    h = np.tile(np.arange(1, bands + 1).astype(U), (len(sig), 1))
    for j in range(s.shape[2]):
        h = mix(h * U(0x9E3779B97F4A7C15) + s[:, :, j])
    return h.view(np.int64)


def expanded(element: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """A multiset as a sorted set of (element, occurrence)."""
    row = np.repeat(np.arange(len(element)), weight)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(weight) - weight, weight)
    out = mix(element[row] * U(2) + nth.astype(U) * U(0xD1B54A32D192ED03))
    out.sort()
    return out


def sliced(lengths: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of documents with a bounded number of words (a longer document alone)."""
    i, n = 0, len(lengths)
    ends = np.cumsum(lengths)
    while i < n:
        base = ends[i - 1] if i else 0
        j = max(i + 1, min(int(np.searchsorted(ends, base + SLICE_WORDS, "right")), i + SLICE_DOCS, n))
        yield i, j
        i = j


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    off = np.asarray(column.offsets)
    return np.asarray(column.values)[off[0] : off[-1]], np.diff(off).astype(np.int64)


def signatures(docs: DataFrame) -> DataFrame:
    """Of ``docs`` (uid, doc_id, text): uid, doc_id, d1 and d2 (a 128-bit digest of the multiset), bands (none for an empty multiset)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            values, lengths = flat(b.column(2))
            at = 0
            for i, j in sliced(lengths):
                n, own = j - i, lengths[i:j]
                doc, element, weight = shingles(values[at : at + own.sum()], own)
                at += int(own.sum())
                sig = band_hashes(bag_minhash(doc, element, weight, n))
                digest = []
                for seed in (1, 2):
                    total = np.zeros(n, U)
                    np.add.at(total, doc, mix(mix(element + (U(seed) << U(53))) + weight.astype(U)))
                    digest.append(total.view(np.int64))
                some = own > 0
                offsets = np.concatenate([[0], np.cumsum(some * BANDS)]).astype(np.int32)
                bands = pa.ListArray.from_arrays(pa.array(offsets), pa.array(sig[some].ravel()))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, n), b.column(1).slice(i, n), pa.array(digest[0]), pa.array(digest[1]), bands], names=["uid", "doc_id", "d1", "d2", "bands"])

    return docs.select("uid", "doc_id", words(F.col("text")).alias("w")).mapInArrow(released(run), "uid long, doc_id long, d1 long, d2 long, bands array<long>")


def multisets(docs: DataFrame) -> DataFrame:
    """Of ``docs`` (uid, text): node (the uid), bag: the expanded multiset as little-endian 64-bit numbers, sorted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            values, lengths = flat(b.column(1))
            at = 0
            for i, j in sliced(lengths):
                own = lengths[i:j]
                doc, element, weight = shingles(values[at : at + own.sum()], own)
                at += int(own.sum())
                cut = np.searchsorted(doc, np.arange(j - i + 1))
                bags = [expanded(element[s:e], weight[s:e]).tobytes() for s, e in zip(cut[:-1], cut[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), pa.array(bags, pa.binary())], names=["node", "bag"])

    return docs.select("uid", words(F.col("text")).alias("w")).mapInArrow(released(run), "node long, bag binary")


def overlap(a: np.ndarray, b: np.ndarray) -> float:
    """Weighted Jaccard similarity of two expanded multisets."""
    both = np.concatenate([a, b])
    both.sort()
    common = int((both[1:] == both[:-1]).sum())
    return common / max(1, len(a) + len(b) - common)


def verify(pairs: DataFrame, bags: DataFrame) -> DataFrame:
    """``pairs`` (a, b) with their exact similarity. A node with many partners moves to its partners' tasks; Spark splits such a key."""
    left = pairs.join(bags.select(F.col("node").alias("a"), F.col("bag").alias("bag_a")), "a")
    both = left.join(bags.select(F.col("node").alias("b"), F.col("bag").alias("bag_b")), "b").select("a", "b", "bag_a", "bag_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            sims = [overlap(np.frombuffer(p.as_buffer(), U), np.frombuffer(q.as_buffer(), U)) for p, q in zip(x.column(2), x.column(3), strict=True)]
            yield pa.RecordBatch.from_arrays([x.column(0), x.column(1), pa.array(sims, pa.float64())], names=["a", "b", "sim"])

    return both.mapInArrow(released(run), "a long, b long, sim double")


def block_links(ids: np.ndarray, label: np.ndarray, bags: list[np.ndarray], first: np.ndarray, threshold: float) -> tuple[list[int], list[int]]:
    """Links between ``first`` nodes and the others, of different labels: as many as join what all such links join, and no more."""
    sizes = np.array([len(x) for x in bags], np.int64)
    values = np.concatenate(bags) if bags else np.zeros(0, U)
    row = np.repeat(np.arange(len(bags)), sizes)
    _, column, count = np.unique(values, return_inverse=True, return_counts=True)
    shared = count[column] > 1
    row, column = row[shared], column[shared]
    keep, column = np.unique(column, return_inverse=True)
    left, right = np.flatnonzero(first), np.flatnonzero(~first)
    common = np.zeros((len(left), len(right)), np.float32)
    for s in range(0, len(keep), 4096):  # a bounded number of columns at a time
        on = (column >= s) & (column < s + 4096)
        m = np.zeros((len(bags), min(4096, len(keep) - s)), np.float32)
        m[row[on], column[on] - s] = 1
        common += m[left] @ m[right].T
    sim = common / np.maximum(1, sizes[left][:, None] + sizes[right][None, :] - common)
    of = np.unique(label, return_inverse=True)[1]
    i, j = np.nonzero((sim >= threshold) & (of[left][:, None] != of[right][None, :]))
    root = list(range(len(of)))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    a, b = [], []
    for p, q in zip(left[i].tolist(), right[j].tolist(), strict=True):
        x, y = find(of[p]), find(of[q])
        if x != y:
            root[x] = y
            a.append(int(ids[p]))
            b.append(int(ids[q]))
    return a, b


def mixed_groups(members: DataFrame) -> DataFrame:
    """band and main (the label that most of its members have) of the groups of ``members`` (band, node, label) with several labels, one band for each set of members."""
    per = members.groupBy("band", "label").agg(F.count(F.lit(1)).alias("n"), *[F.bit_xor(F.xxhash64(F.lit(s), "node")).alias(f"h{s}") for s in (1, 2)])
    per = per.groupBy("band").agg(F.max_by("label", F.struct("n", "label")).alias("main"), F.count(F.lit(1)).alias("labels"), F.sum("n").alias("n"), F.bit_xor("h1").alias("h1"), F.bit_xor("h2").alias("h2"))
    return per.where("labels > 1").groupBy("n", "h1", "h2").agg(F.min(F.struct("band", "main")).alias("g")).select("g.band", "g.main")


def compare_groups(members: DataFrame, bags: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Links (a, b) that join the components of each group: ``members`` is (band, node, label, main). Nodes outside of the main component meet all nodes of the group; both sides are dealt into blocks by hash, and a pair of blocks is one task's work, of bounded size. So a node is moved once for each block of the few that are outside, not for each block of its group."""
    sized = bags.select("node", F.octet_length("bag").alias("bytes"))
    m = members.join(sized, "node").withColumn("out", F.col("label") != F.col("main"))
    blocks = lambda on: F.greatest(F.lit(1), F.ceil(F.count_if(on) / BLOCK), F.ceil(F.sum(F.when(on, F.col("bytes")).otherwise(0)) / BLOCK_BYTES)).cast("int")
    stats = m.groupBy("band").agg(blocks(F.col("out")).alias("lefts"), blocks(F.lit(True)).alias("rights"))
    m = m.select("band", "node", "label", "out").join(materialize(stats), "band")
    block = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    every = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    right = m.select("band", "node", "label", F.lit(False).alias("first"), F.explode(every("lefts")).alias("i"), block("rights").alias("j"))
    left = m.where("out").select("band", "node", "label", F.lit(True).alias("first"), block("lefts").alias("i"), F.explode(every("rights")).alias("j"))
    m = left.unionByName(right).join(bags, "node")

    def run(table: pa.Table) -> pa.Table:
        t = table.combine_chunks()
        ids, label = t.column("node").to_numpy(), t.column("label").to_numpy()
        bags_ = [np.frombuffer(x, U) for x in t.column("bag").to_pylist()]
        a, b = block_links(ids, label, bags_, t.column("first").to_numpy(zero_copy_only=False), threshold)
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return m.groupBy("band", "i", "j").applyInArrow(run, "a long, b long")


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """node, label (the least node of its component), for nodes with an edge. Labels spread along edges and jump to the label's label, a stage table each round."""
    both = materialize(edges.select("a", "b").union(edges.select("b", "a")).toDF("a", "b").distinct())
    labels = materialize(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("label")).select(F.col("a").alias("node"), "label"))
    for _ in range(max_rounds):
        near = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy("a").agg(F.min("label").alias("near"))
        step = labels.join(near, labels["node"] == near["a"]).select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        up = labels.select(F.col("node").alias("__n"), F.col("label").alias("__up"))
        new = materialize(step.join(up, step["label"] == up["__n"], "left").select("node", "old", F.least("label", F.coalesce("__up", "label")).alias("label")))
        if not new.where("old <> label").limit(1).count():
            return new.select("node", "label")
        labels = new.select("node", "label")
    raise RuntimeError("components did not settle")


def apart(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """The pairs (a, b) that no links join yet."""
    la = labels.select(F.col("node").alias("a"), F.col("label").alias("__la"))
    lb = labels.select(F.col("node").alias("b"), F.col("label").alias("__lb"))
    both = pairs.join(la, "a", "left").join(lb, "b", "left")
    return both.where(F.coalesce("__la", "a") != F.coalesce("__lb", "b")).select("a", "b")


def near_dedup(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", threshold: float = THRESHOLD, uid: str | None = None) -> DataFrame:
    """One row per document: doc_id, uid, class_id (the least doc_id of its class), kept (one row of a class). ``uid``: a column that numbers the rows of a stage table, if there is one."""
    d = docs.select((F.monotonically_increasing_id() if uid is None else F.col(uid)).alias("uid"), F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    d = materialize(d) if uid is None else d
    rows = materialize(signatures(d))
    nodes = materialize(rows.groupBy("d1", "d2").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "uid")).alias("rep"), F.first("bands").alias("bands")).select("d1", "d2", F.col("rep.uid").alias("node"), "rep", "bands"))
    banded = nodes.where(F.size("bands") > 0).select("node", F.explode("bands").alias("band"))
    # as tables, so that the joins have an exchange on both sides and Spark can split a frequent band
    groups = materialize(banded.groupBy("band").agg(F.min("node").alias("head"), F.count(F.lit(1)).alias("n")).where("n > 1"))
    members = materialize(banded.join(groups, "band").select("band", "node", "head", "n"))
    wanted = members.select(F.col("node").alias("uid")).distinct()
    # a shuffle join at every size: the list of candidates grows with the table
    bags = materialize(multisets(d.select("uid", "text").join(wanted.hint("merge"), "uid", "left_semi")))

    left = materialize(members.where("node <> head").select(F.col("node").alias("a"), F.col("head").alias("b")).distinct())
    edges, labels = None, None
    for turn in range(SINGLE_TURNS + 1):
        if not left.limit(1).count():
            break
        # each node tries one head a turn, and then no head that it is linked with already; the last turn tries all that are left
        now = left if turn == SINGLE_TURNS else left.groupBy("a").agg(F.min("b").alias("b"))
        found = verify(now, bags).where(F.col("sim") >= threshold).select("a", "b")
        edges = materialize(found if edges is None else edges.union(found))
        labels = components(edges)
        if turn < SINGLE_TURNS:
            left = materialize(apart(left.join(now, ["a", "b"], "left_anti"), labels))
    if labels is None:
        labels = nodes.select("node", F.col("node").alias("label")).limit(0)

    lab = labels.select("node", "label")
    open_ = members.where("n > 2").join(lab, "node", "left").select("band", "node", F.coalesce("label", "node").alias("label"))
    mixed = materialize(mixed_groups(open_))
    if mixed.limit(1).count():
        more = materialize(compare_groups(open_.join(mixed, "band"), bags, threshold))
        if more.limit(1).count():
            labels = components(edges.union(more))

    tops = nodes.select("d1", "d2", "node", "rep").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    classes = tops.groupBy("label").agg(F.min("rep").alias("best"))
    tops = materialize(tops.select("d1", "d2", "label").join(classes, "label").select("d1", "d2", F.col("best.doc_id").alias("class_id"), F.col("best.uid").alias("keep_uid")))
    return rows.join(tops, ["d1", "d2"]).select("doc_id", "uid", "class_id", (F.col("uid") == F.col("keep_uid")).alias("kept"))
