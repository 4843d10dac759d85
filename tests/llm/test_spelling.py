import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lotline.llm import spelling as S


def one_apart(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(words, min_count=2, ratio=10):
    n = {w: c for w, c in Counter(w for w in words if w).items() if c >= min_count}
    near = {w: [x for x in n if one_apart(w, x)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= ratio * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return sorted(out)


def got(df):
    return sorted(tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect())


@pytest.mark.parametrize("seed", range(4))
def test_equals_all_pairs(spark, seed):
    """Words of few letters: many repeat letters, and many are one letter apart."""
    rng = random.Random(seed)
    base = ["".join(rng.choices("abÿé", k=rng.randint(1, 7))) for _ in range(60)]
    words = []
    for w in base:
        words += [w] * rng.choice((1, 2, 3, 30, 400))
        i = rng.randrange(len(w))
        words += [w[:i] + w[i + 1 :], w[:i] + rng.choice("abÿé") + w[i:], w[:i] + "b" + w[i + 1 :]] * rng.randint(1, 3)
    df = spark.createDataFrame([(w,) for w in words] + [(None,), ("",), ("",)], "word string").withColumns({c: F.lit("x") for c in ("id", "n", "form", "key", "near")}).repartition(3)
    assert got(S.variants(df)) == brute(words)


def test_chains_end_at_the_root(spark):
    """Each word is ten times rarer than the next: forms are followed over several steps."""
    chain = ["abcdefgh", "abcdefg", "abcdef", "abcde", "abcd"]
    df = spark.range(1).select(F.explode(F.array(*[F.struct(F.lit(w).alias("word"), F.lit(2 * 10**i).alias("n")) for i, w in enumerate(chain)])).alias("x"))
    df = df.select("x.word", F.explode(F.sequence(F.lit(1), F.col("x.n"))).alias("__"))
    out = {r["word"]: r for r in S.variants(df).collect()}
    assert [out[w]["form"] for w in chain] == [*chain[1:], None]
    assert {r["root"] for r in out.values()} == {"abcd"}


def test_one_letter_and_repeats(spark):
    words = ["a"] * 2 + ["b"] * 40 + ["aa"] * 3 + ["aaa"] * 30 + ["ab"] * 2 + ["ba"] * 2 + ["😀a"] * 2 + ["😀"] * 2
    assert got(S.variants(spark.createDataFrame([(w,) for w in words], "word string"))) == brute(words)


def test_very_long_words(spark):
    """A word emits a number for each letter: neither memory nor exchange grows with the square of its length."""
    w = "".join(random.Random(1).choices("abcdefgh", k=200_000))
    words = [w] * 30 + [w[:99_999] + w[100_000:]] * 2 + [w[:-1] + "z"] * 3 + ["a" * 150_000] * 2 + ["a" * 150_001] * 25
    out = {r["word"]: r for r in S.variants(spark.createDataFrame([(x,) for x in words], "word string")).collect()}
    assert len(out) == 5 and out[words[30]]["form"] == w and out[words[32]]["form"] == w and out["a" * 150_000]["form"] == "a" * 150_001
    assert out[w]["n_near"] == 2


def test_hash_alike_words_are_not_near(spark, monkeypatch):
    """Verification is by letters: with a hash that is nearly constant nothing changes."""
    words = ["".join(random.Random(i).choices("abc", k=5)) for i in range(60) for _ in range(2)]
    df = spark.createDataFrame([(w,) for w in words], "word string")
    want = brute(words)
    real = S.emitted
    monkeypatch.setattr(S, "emitted", lambda w: real(w).withColumn("key", F.col("key") % 3))
    pairs = S.near_pairs(S.materialize(spark.createDataFrame([(i, w, n) for i, (w, n) in enumerate(sorted(Counter(words).items()))], "id long, word string, n long")))
    near = Counter(x for r in pairs.select("word_a", "word_b").collect() for x in r)
    assert near == {w: n for w, _, _, _, n, _ in want if n}


def test_runs(spark):
    df = spark.createDataFrame([("Straße École abcdefg-ABCDEFG×÷ x",), (None,), ("",), ("...",), ("A" * 100_000,)], "t string")
    out = [r[0] for r in df.select(S.runs(F.col("t"))).collect()]
    assert out == [["abcdefg", "abcdefg×÷"], [], [], [], ["a" * 100_000]]
    assert df.limit(1).select(S.runs(F.col("t"), 5)).first()[0] == ["straße", "École", "abcdefg", "abcdefg×÷"]


def test_empty(spark):
    assert S.variants(spark.createDataFrame([], "word string")).collect() == []
    assert S.variants(spark.createDataFrame([("once",), (None,)], "word string")).collect() == []
