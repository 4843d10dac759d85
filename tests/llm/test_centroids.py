import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lotline.llm import centroids as C

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows, k, dim, rounds, scale=64, seed=1):
    """Lloyd's rounds with all distances, in Python's own integers."""
    import math

    vs = []
    for i, e in rows:
        if e is not None and len(e) == dim and all(x is not None and math.isfinite(x) for x in e):
            vs.append((i, [math.floor(scale * float(np.float32(x))) for x in e]))
    order = sorted(vs, key=lambda r: (hashlib.sha256(f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    cs = [v for _, v in order[:k]]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    near = lambda v: min((far(v, c), i) for i, c in enumerate(cs))
    for _ in range(rounds):
        groups = {}
        for _, v in vs:
            groups.setdefault(near(v)[1], []).append(v)
        cs = [[sum(x) // len(groups[i]) for x in zip(*groups[i], strict=True)] if i in groups else c for i, c in enumerate(cs)]
    out = [(i, near(v)[1], near(v)[0]) for i, v in vs]
    per = {}
    for _, c, d in out:
        per[c] = per.get(c, 0) + d
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cs]
    return sorted([(i, c, d, per[c], sum(per.values()), sha[c]) for i, c, d in out], key=str)


def table(rng, n=300, dim=8):
    middles = [[rng.uniform(-3, 3) for _ in range(dim)] for _ in range(6)]
    rows = [(i, [rng.gauss(m, 0.4) for m in middles[i % 6]]) for i in range(n)]
    rows += [(n + i, list(rows[0][1])) for i in range(60)]  # one frequent vector
    rows += [rows[5], rows[5], (None, rows[1][1]), (None, rows[2][1]), (1000, None), (1001, []), (1002, [1.0] * (dim + 1)), (1003, [1.0] * (dim - 1) + [None]), (1004, [float("nan")] * dim), (1005, [float("inf")] * dim), (1006, [0.0] * dim), (1007, [-0.0] * dim), (1008, [1e-40] * dim)]
    return rows


def got(df):
    return sorted([tuple(r) for r in df.drop("scans").collect()], key=str)


@pytest.mark.parametrize("k,rounds", [(5, 3), (1, 2), (16, 6), (40, 2)])
def test_equals_all_distances(spark, k, rounds):
    rows = table(random.Random(k))
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("x") for c in ("cluster", "v", "upper", "was", "distance")}).repartition(5)
    assert got(C.cluster(df, k=k, dim=8, rounds=rounds)) == brute(rows, k, 8, rounds)


def test_ties_and_equal_starts(spark):
    """Equal starting centroids, and vectors midway between two: the smaller number wins, the empty cluster stays."""
    rows = [(i, [float(i % 2), 0.0]) for i in range(40)] + [(100 + i, [0.5, 0.0]) for i in range(9)]
    assert got(C.cluster(spark.createDataFrame(rows, SCHEMA), k=12, dim=2, rounds=4)) == brute(rows, 12, 2, 4)


def test_bounds_spare_scans(spark):
    rng = random.Random(3)
    middles = [[rng.uniform(-50, 50) for _ in range(8)] for _ in range(8)]
    rows = [(i, [rng.gauss(m, 0.2) for m in middles[i % 8]]) for i in range(800)]
    out = C.cluster(spark.createDataFrame(rows, SCHEMA), k=8, dim=8, rounds=6)
    scans = out.agg(F.sum("scans")).first()[0]
    assert got(out) == brute(rows, 8, 8, 6) and 800 <= scans < 0.5 * 800 * 7


def test_bounds_hold_at_every_step():
    rng = np.random.default_rng(0)
    v = rng.integers(-300, 300, (500, 6))
    before, cs = None, v[:7].tolist()
    state = np.full(500, -1), np.zeros(500), np.zeros(500)
    for _ in range(8):
        cluster, upper, lower, _ = C.Move(cs, before).step(v, *[x.copy() for x in state])
        d = np.stack([C.squared(v, np.array(c)) for c in cs], axis=1)
        assert (cluster == d.argmin(axis=1)).all()
        own = np.sqrt(d[np.arange(500), cluster].astype(float))
        others = d.astype(float)
        others[np.arange(500), cluster] = np.inf
        assert (upper >= own).all() and (lower <= np.sqrt(others.min(axis=1))).all()
        state = cluster, upper, lower
        before, cs = cs, [v[cluster == c].sum(axis=0) // max(1, (cluster == c).sum()) if (cluster == c).any() else np.array(cs[c]) for c in range(7)]
        cs = [[int(x) for x in c] for c in cs]


def test_large_components(spark):
    """Distances stay exact where floats are not."""
    big = C.LIMIT - 1
    rows = [(i, [big if i % 2 else -big, float(i), big / (i + 1)]) for i in range(12)] + [(50, [C.LIMIT, 0.0, 0.0]), (51, [-1e30, 0.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    fits = [(i, e) for i, e in rows if max(map(abs, e)) < C.LIMIT]
    import math

    vs = {i: [math.floor(64 * x) for x in e] for i, e in fits}
    out = {r["vec_id"]: r for r in C.cluster(df, k=3, dim=3, rounds=0).collect()}
    first = sorted(vs, key=lambda i: hashlib.sha256(f"1:{i}".encode()).hexdigest())[:3]
    assert set(out) == set(vs)
    for i, v in vs.items():
        assert out[i]["distance"] == min(sum((x - y) ** 2 for x, y in zip(v, vs[c], strict=True)) for c in first)


def test_empty_table(spark):
    assert C.cluster(spark.createDataFrame([], SCHEMA)).collect() == []
    assert C.cluster(spark.createDataFrame([(1, [1.0])], SCHEMA)).collect() == []


def test_nearest_expression(spark):
    df = spark.createDataFrame([([1, 2],), ([9, 9],), ([5, 5],)], "v array<int>")
    assert [r[0] for r in df.select(C.nearest(F.col("v"), [[0, 0], [10, 10]])).collect()] == [0, 1, 0]
