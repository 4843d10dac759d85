import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lotline.llm import mixing as M

from .helpers import documents, rows, sentence

leaves = st.dictionaries(st.tuples(st.sampled_from("ab"), st.sampled_from("xy"), st.sampled_from("123")), st.integers(0, 1000), min_size=1)


@settings(max_examples=200, deadline=None)
@given(leaves, st.floats(0, 3), st.integers(1, 3))
def test_budgets_use_what_there_is(supply, share, epochs):
    total = int(share * sum(supply.values()))
    got = M.budgets(supply, {}, total, epochs)
    room = sum(supply.values()) * epochs
    assert all(0 <= got[k] <= supply[k] * epochs for k in supply)
    assert sum(got.values()) == min(total, room)


def test_shortages_go_to_siblings_first():
    supply = {("a", "x"): 10, ("a", "y"): 500, ("b", "x"): 500, ("b", "y"): 500}
    assert M.budgets(supply, {}, 400, 1) == {("a", "x"): 10, ("a", "y"): 190, ("b", "x"): 100, ("b", "y"): 100}
    supply[("a", "y")] = 50  # now the family of a lacks 140, which go to the family of b
    assert M.budgets(supply, {}, 400, 1) == {("a", "x"): 10, ("a", "y"): 50, ("b", "x"): 170, ("b", "y"): 170}


def test_weights():
    supply = {("a",): 1000, ("b",): 1000, ("c",): 1000}
    assert M.budgets(supply, {("a",): 3, ("c",): 0}, 400, 1) == {("a",): 300, ("b",): 100, ("c",): 0}


def test_table_equals_driver(spark):
    """Trees that the driver doesn't hold get the same budgets."""
    rng = random.Random(4)
    supply = {(rng.choice("abc"), rng.choice("wxyz"), f"s{rng.randrange(60)}"): rng.choice([0, 5, 5, rng.randrange(1000), rng.randrange(10**6)]) for _ in range(250)}
    leaves = spark.createDataFrame([(list(k), v) for k, v in supply.items()], "leaf array<string>, leaf_tokens long")
    for weights, share, epochs in (({}, 0.4, 1), ({("a",): 5, ("b", "w"): 0, ("c", "x", "s1"): 0.25, ("a", "y"): 3}, 0.9, 2), ({("a",): 0}, 5.0, 1)):
        total = int(share * sum(supply.values()))
        got = {tuple(r["leaf"]): r["leaf_budget"] for r in M.budget_table(leaves, weights, total, epochs, 3).collect()}
        assert got == M.budgets(supply, weights, total, epochs)


def test_large_trees_give_the_same_rows(spark):
    docs = documents(spark, rows())
    a, b = (sorted(map(tuple, M.mix_sources(docs, ["lang", "source"], total_share=0.7, driver_leaves=n).drop("uid").collect()), key=str) for n in (100, 0))
    assert a == b and a


def brute(data, tree_of, order, total, epochs):
    n = {i: len((t or "").split()) for i, t, *_ in data}
    leaves = {}
    for row in data:
        leaves.setdefault(tree_of(row), []).append(row[0])
    supply = {k: sum(n[i] for i in v) for k, v in leaves.items()}
    out = []
    for k, b in M.budgets(supply, {}, total, epochs).items():
        whole, rest = (b // supply[k], b % supply[k]) if supply[k] else (0, 0)
        for e in range(whole):
            out += [(i, e, n[i]) for i in leaves[k]]
        before = 0
        for i in sorted(leaves[k], key=lambda i: (order[(whole, i)], i)):
            if before < rest:
                out.append((i, whole, min(n[i], rest - before)))
            before += n[i]
    return sorted(out)


@pytest.mark.parametrize("share,epochs", [(1.0, 2), (0.5, 1), (3.0, 2)])
def test_against_brute_force(spark, share, epochs):
    rng = random.Random(2)
    data = [(i, sentence(rng, "en", rng.randint(1, 60)), rng.choice(["en", "de"]), rng.choice(["hot", "hot", "s1", "s2"]), 0) for i in range(300)]
    docs = documents(spark, data)
    order = {(w, r[0]): int(hashlib.md5(f"{M.SEED}|{w}|{r[0]}".encode()).hexdigest()[:15], 16) for r in data for w in range(4)}
    got = M.mix_sources(docs, ["lang", "source"], total_share=share, max_epochs=epochs)
    total = int(share * sum(len(t.split()) for _, t, *_ in data))
    assert sorted((r["doc_id"], r["epoch"], r["tokens_used"]) for r in got.collect()) == brute(data, lambda r: (r[2], r[3]), order, total, epochs)


@pytest.mark.parametrize("clash", [False, True])
def test_edges(spark, clash):
    from pyspark.sql import functions as F

    got = M.mix_sources(documents(spark, rows(), clash), [M.domain(F.col("source")), "lang", "source"]).collect()
    assert all(r["tokens_used"] <= r["tokens"] for r in got) and any("/" in r["leaf"] for r in got)
    assert M.mix_sources(documents(spark, []), ["lang"]).count() == 0
