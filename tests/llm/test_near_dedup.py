import random
import re
from collections import Counter

import numpy as np
import pytest

from lotline.llm import near_dedup as N

from .helpers import documents, rows, sentence


def bag(text):
    w = re.findall(r"[^\W_]+", (text or "").lower())
    return Counter(zip(*[w[i:] for i in range(5)], strict=False)) if len(w) >= 5 else Counter([tuple(w)] if w else [])


def brute_classes(data):
    """doc_id -> least doc_id of its component, by all pairs."""
    bags = {i: bag(t) for i, t, *_ in data}
    ids = sorted(bags)
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for n, i in enumerate(ids):
        for j in ids[:n]:
            a, b = bags[i], bags[j]
            common = sum((a & b).values())
            whole = sum(a.values()) + sum(b.values()) - common
            if whole == 0 or common / whole >= N.THRESHOLD:
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def edited(rng, text, share):
    w = text.split()
    for k in rng.sample(range(len(w)), int(share * len(w))):
        w[k] = "edit" + str(rng.randrange(10**6))
    return " ".join(w)


def check(spark, data, clash=False):
    got = N.near_dedup(documents(spark, data, clash)).collect()
    want = brute_classes(data)
    assert len(got) == len(data)
    assert {r["doc_id"]: r["class_id"] for r in got} == want
    assert Counter(r["class_id"] for r in got if r["kept"]) == Counter(set(want.values()))


@pytest.mark.parametrize("clash", [False, True])
def test_edges_against_brute_force(spark, clash):
    check(spark, rows(n=40), clash)


def test_copies_and_chains_against_brute_force(spark):
    rng = random.Random(5)
    data = []
    for _ in range(8):
        text = sentence(rng, "en", 150)
        for _ in range(rng.randint(1, 6)):
            data.append((len(data), text, "en", "s", 0))
            text = edited(rng, text, rng.choice([0.0, 0.01, 0.02, 0.05]))
    check(spark, data)


def test_hot_group_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(N, "BLOCK", 8)
    rng = random.Random(6)
    text = sentence(rng, "en", 200)
    data = [(i, edited(rng, text, rng.choice([0.005, 0.01, 0.03, 0.06])), "en", "s", 0) for i in range(70)]
    data += [(100 + i, sentence(rng, "de", 60), "de", "s", 0) for i in range(20)]
    check(spark, data)


def test_rows_that_share_or_lack_a_doc_id(spark):
    """Classes go by rows: a repeated or null doc_id hides no link."""
    rng = random.Random(8)
    data = []
    for i in range(12):
        text = sentence(rng, "en", 120)
        for k in range(4):
            data.append(([1, None, i, 100][k], edited(rng, text, 0.01) if k else text, "en", "s", 0))
    numbered = [(n, t, *rest) for n, (_, t, *rest) in enumerate(data)]
    want = brute_classes(numbered)
    docs = documents(spark, numbered).withColumnRenamed("doc_id", "n").join(spark.createDataFrame([(n, i) for n, (i, *_) in enumerate(data)], "n long, doc_id long"), "n")
    got = N.near_dedup(docs, uid="n").collect()
    classes, members = {}, {}
    for n, (i, *_) in enumerate(data):
        members.setdefault(want[n], []).append(i)
    for r in got:
        own = [i for i in members[want[r["uid"]]] if i is not None]
        assert r["class_id"] == (min(own) if own else None)
        classes.setdefault(want[r["uid"]], []).append(r["kept"])
    assert len(got) == len(data) and all(sum(k) == 1 for k in classes.values()) and len(classes) == 12


def test_identical_groups_are_compared_once(spark):
    rows_ = [(b, n, n % 3) for b in (1, 2, 3) for n in range(9)] + [(4, n, 5) for n in range(5)] + [(5, n, n % 2) for n in range(7)]
    got = N.mixed_groups(spark.createDataFrame(rows_, "band long, node long, label long")).collect()
    assert sorted((r["band"], r["main"]) for r in got) == [(1, 2), (5, 0)]


def test_empty_table_and_null_ids(spark):
    assert N.near_dedup(documents(spark, [])).count() == 0
    got = N.near_dedup(documents(spark, [(None, "a b c d e f", "en", "s", 0), (1, "g h i j k l", "en", "s", 0)])).collect()
    assert all(r["kept"] for r in got) and len(got) == 2


def test_signatures_are_unbiased():
    """The share of equal minima estimates the weighted Jaccard similarity."""
    rng = np.random.default_rng(2)
    errors = []
    for _ in range(40):
        common = rng.integers(0, 2**52, 30, dtype=np.uint64)
        own = rng.integers(0, 2**52, (2, 20), dtype=np.uint64)
        wa, wb = rng.integers(1, 20, 50), rng.integers(1, 20, 50)
        a, b = np.concatenate([common, own[0]]), np.concatenate([common, own[1]])
        sig = N.bag_minhash(np.repeat([0, 1], 50), np.concatenate([a, b]), np.concatenate([wa, wb]), 2, 512)
        low = np.minimum(wa[:30], wb[:30]).sum()
        errors.append((sig[0] == sig[1]).mean() - low / (wa.sum() + wb.sum() - low))
    assert abs(np.mean(errors)) < 0.01 and np.abs(errors).max() < 0.09


def test_block_links_join_what_all_links_join():
    rng = random.Random(7)
    base = list(range(100))
    bags = [np.array(sorted(set(rng.sample(base, 90)) | {1000 + i}), np.uint64) for i in range(30)]
    ids = np.concatenate([np.arange(30), np.arange(30)])
    a, b = N.block_links(ids, ids, bags + bags, np.arange(60) < 30, 0.8)
    assert len(a) < 30

    def parts(pairs):
        root = list(range(30))

        def find(x):
            while root[x] != x:
                x = root[x]
            return x

        for x, y in pairs:
            root[find(x)] = find(y)
        groups = {}
        for i in range(30):
            groups.setdefault(find(i), set()).add(i)
        return sorted(map(sorted, groups.values()))

    every = [(i, j) for i in range(30) for j in range(i) if N.overlap(bags[i], bags[j]) >= 0.8]
    assert parts(zip(a, b, strict=True)) == parts(every)
