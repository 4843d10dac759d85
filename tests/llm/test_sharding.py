import random
import zlib
from collections import Counter

import pytest

from lotline.llm import sharding as H

from .helpers import documents, rows, sentence


def check(got, data, shards):
    assert len(got) == len(data)
    texts = {i: t or "" for i, t, *_ in data}
    for r in got:
        b = texts[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"]) == (len(b) + 1, zlib.crc32(b)) and 0 <= r["shard"] < shards
    by = {}
    for r in got:
        by.setdefault(r["shard"], []).append(r)
    for rs in by.values():
        assert sorted(r["slot"] for r in rs) == list(range(len(rs)))
    return {k: sum(r["size"] for r in rs) for k, rs in by.items()}, by


@pytest.mark.parametrize("clash", [False, True])
def test_edges(spark, clash):
    data = rows()
    check(H.shard(documents(spark, data, clash), 4).collect(), data, 4)
    assert H.shard(documents(spark, []), 16).count() == 0


def test_sizes_near_equal_and_groups_kept(spark):
    rng = random.Random(4)
    data = [(i, sentence(rng, "en", rng.randint(1, 80)), "en", "s", 0) for i in range(3000)]
    data += [(3000 + i, data[i % 50][1], "en", "s", 0) for i in range(500)]
    got = H.shard(documents(spark, data), 16).collect()
    sizes, _ = check(got, data, 16)
    mean = sum(sizes.values()) / 16
    assert max(abs(x - mean) for x in sizes.values()) < 0.03 * mean
    text = dict((i, t) for i, t, *_ in data)
    shards = {}
    for r in got:
        shards.setdefault(text[r["doc_id"]], set()).add(r["shard"])
    copies = Counter(text.values())
    split = [t for t, s in shards.items() if len(s) > 1]
    assert all(copies[t] * (len(t.encode()) + 1) > H.GROUP_TOLERANCE * mean for t in split) and len(split) <= 15


def test_a_group_of_a_third_is_split_evenly(spark):
    rng = random.Random(5)
    data = [(i, "one text that all have " * 3 if i % 3 == 0 else sentence(rng, "en", 12), "en", "s", 0) for i in range(3000)]
    sizes, by = check(H.shard(documents(spark, data), 8).collect(), data, 8)
    mean = sum(sizes.values()) / 8
    assert max(abs(x - mean) for x in sizes.values()) < 0.03 * mean
    hot = [k for k, rs in by.items() if sum(r["doc_id"] % 3 == 0 for r in rs)]
    assert max(hot) - min(hot) + 1 == len(hot)  # neighbours


@pytest.mark.parametrize("doc_id", [None, 7])
def test_rows_of_one_key_are_split_evenly(spark, doc_id):
    """Half of the rows have the same text and no doc_id, or the same one."""
    rng = random.Random(7)
    data = [(doc_id, "same text", "en", "s", 0) if i % 2 else (i + 10, sentence(rng, "en", 3), "en", "s", 0) for i in range(3000)]
    got = H.shard(documents(spark, data), 16).collect()
    sizes = Counter()
    for r in got:
        sizes[r["shard"]] += r["size"]
    mean = sum(sizes.values()) / 16
    assert len(got) == 3000 and len(sizes) == 16 and max(abs(x - mean) for x in sizes.values()) < 0.03 * mean
    for k in sizes:
        assert sorted(r["slot"] for r in got if r["shard"] == k) == list(range(sum(r["shard"] == k for r in got)))


def test_splitters_meet_tolerance(spark):
    rng = random.Random(6)
    data = [(int(rng.paretovariate(0.4) * 1e6) % (1 << 62), rng.randint(1, 100)) for _ in range(5000)]
    df = spark.createDataFrame(data, "key long, w long").repartition(7)
    total = sum(w for _, w in data)
    targets = [total * i // 10 for i in range(1, 10)]
    for t, k in zip(targets, H.splitters(df, "key", "w", targets, [0.001 * total] * 9), strict=True):
        assert abs(sum(w for x, w in data if x < k) - t) <= 0.001 * total
