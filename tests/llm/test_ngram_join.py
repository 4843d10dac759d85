import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from lotline.llm import ngram_join as J

from . import helpers


def gram_set(text):
    t = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall("[^\x20\x09-\x0d]+", t)
    if len(w) < 3:
        return frozenset([" ".join(w)] if w else [])
    return frozenset(" ".join(w[i : i + 3]) for i in range(len(w) - 2))


def brute(rows):
    sets = [gram_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= 90 * len(a | b):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        r = find(i)
        least[r] = min((x for x in (least.get(r), d) if x is not None), default=None)
    return sorted([(d, len(s), least[find(i)]) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))], key=str)


def got(df):
    return sorted([tuple(r) for r in df.select("doc_id", "n_shingles", "component_id").collect()], key=str)


def run(spark, rows, clash=False):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    if clash:
        df = df.withColumns({c: F.lit("x") for c in (*helpers.CLASH, "n", "d1", "label", "prefix", "band", "token", "text_key")})
    return J.join(df)


def copies(rng, words, n, edits):
    """Copies of one text, some words of each replaced by others."""
    out = []
    for _ in range(n):
        w = list(words)
        for _ in range(rng.randint(0, edits)):
            w[rng.randrange(len(w))] = f"x{rng.randrange(30)}"
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("seed", range(3))
def test_equals_all_pairs(spark, seed):
    """Groups of copies around the threshold, chains, shared passages, short texts, sizes that just fit."""
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    passage = rng.choices(vocab, k=60)
    texts = []
    for size, n, edits in ((30, 12, 2), (80, 40, 5), (200, 25, 14), (400, 10, 20), (12, 8, 1)):
        texts += copies(rng, rng.choices(vocab, k=size), n, edits)
    texts += [" ".join(rng.choices(vocab, k=rng.randint(1, 40)) + passage + rng.choices(vocab, k=rng.randint(0, 30))) for _ in range(40)]
    texts += [" ".join(passage + rng.choices(vocab, k=k % 9)) for k in range(30)]
    texts += [" ".join(passage[:k]) for k in range(45, 61)]
    texts += [" ".join(rng.choices("ab", k=rng.randint(1, 6))) for _ in range(30)]
    rows = [(i, t) for i, t in enumerate(texts)]
    rng.shuffle(rows)
    assert got(run(spark, rows)) == brute(rows)


def test_edges(spark):
    rows = [(r[0], r[1]) for r in helpers.rows()]
    rows += [(7, None), (None, None), (None, ""), (None, "\t\r\n\x0b"), (None, rows[0][1]), (None, "only here a b c"), (None, "only here a b c"), (900, "Two words"), (901, "two\x0bWORDS"), (902, "ÉA b"), (903, "éa b"), (904, "one"), (904, "ONE")]
    rows += [(1000, helpers.sentence(random.Random(4), n=3000)), (1001, helpers.sentence(random.Random(4), n=3000) + " end")]
    assert got(run(spark, rows, clash=True)) == brute(rows)
    assert run(spark, []).collect() == []
    assert got(run(spark, [(3, None), (4, "")])) == [(3, 0, 3), (4, 0, 4)]


def test_a_third_of_all_rows_is_one_text(spark):
    rng = random.Random(5)
    base = rng.choices([f"w{i}" for i in range(300)], k=120)
    rows = [(i, " ".join(base)) for i in range(200)] + [(200 + i, t) for i, t in enumerate(copies(rng, base, 100, 6))] + [(300 + i, helpers.sentence(rng)) for i in range(100)]
    assert got(run(spark, rows)) == brute(rows)


@pytest.mark.parametrize("seed", range(20))
def test_prefixes_lose_no_link(seed):
    """Sets at the threshold share what each filter asks for."""
    rng = np.random.default_rng(seed)
    for _ in range(200):
        common = int(rng.integers(1, 300))
        free = common - J.TENTHS * common // 10
        a = int(rng.integers(0, free + 1))
        b = int(rng.integers(0, free - a + 1))
        pool = np.unique(rng.integers(0, 1 << 63, common + a + b).astype(np.uint64))
        x, y = pool[: len(pool) - b], np.concatenate([pool[: len(pool) - a - b], pool[len(pool) - b :]])
        inter, union = len(np.intersect1d(x, y)), len(np.union1d(x, y))
        if 10 * inter < J.TENTHS * union:
            continue
        small = min(len(x), len(y))
        for order in (lambda s: np.sort(s), lambda s: np.sort(J.second_order(s))):
            p, q = (order(s)[: J.prefix_length(len(s))] for s in (x, y))
            assert len(np.intersect1d(p, q)) >= J.extra(np.int64(small))
        for s in (x, y):  # what the screen asks of either set
            assert J.extra(np.int64(small)) >= 1 + int(J.ceil_share(np.int64(len(s)))) * J.EXTRA // 100
        c = [int(np.searchsorted(J.BOUNDS, len(s), "right")) for s in (x, y)]
        assert abs(c[0] - c[1]) <= 1


def test_words_and_shingles():
    texts = ["a b c a b c", "", "A  B\tC\x0bd", "solo", "é É", "  "]
    raw = [t.encode() for t in texts]
    sets = J.token_sets(np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in raw])]))
    assert [len(s) for s in sets] == [len(gram_set(t)) for t in texts]
    assert len(np.intersect1d(sets[0], sets[2])) == 1
