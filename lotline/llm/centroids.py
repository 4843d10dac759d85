"""Centroid clustering of integer vectors by Lloyd's rounds with Hamerly's bounds: exact, and most vectors meet no centroid but their own.

A vector becomes integers, ``floor(SCALE * x)`` for each component, so that distances (squared, Euclidean), sums and means (``floor(sum / count)``) are exact and a result repeats bit by bit. Beside its cluster each vector keeps an upper bound of the distance to its centroid and a lower bound of the distance to the second-nearest one. When centroids move, the upper bound grows by the drift of the vector's own centroid and the lower one shrinks by the largest drift of the others. A vector stays where it is while its upper bound lies strictly below the lower one, or below half of the distance between its centroid and the nearest other one. Otherwise the upper bound is made exact, and if that doesn't decide, the vector is compared with all centroids in whole numbers. Bounds are rounded outwards, so rounding never decides; ties go to the smaller number.

Vectors stay in their partition: a round reads the table of the last one and writes its own to the shared folder (cluster and bounds beside the vector), and only sums of the vectors that changed cluster, a row for each cluster and task, are exchanged. The driver holds the centroids, at most ``k`` of ``dim`` numbers.

A vector counts if it has ``dim`` components, none of them null, not a number, or of a magnitude of ``LIMIT`` or more (infinite ones are); others, null ones among them, are left out. Starting centroids are the vectors of the least SHA-256 of ``<seed>:<id>`` (a null id is empty text), of equal ids the least vector; with fewer than ``k`` vectors there are as many clusters as vectors. Repeated vectors and ids count each; a cluster that loses all vectors keeps its centroid. An empty table gives an empty result; other columns play no part. Sums of distances beyond 2**63 are null.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotline.llm.common import drop_table, materialize, stage_tables, stage_tables_since

K, DIM, ROUNDS, SCALE, SEED = 16, 64, 3, 64, 1
#: Above any embedding's components; squared distances of ``DIM`` such numbers, scaled, stay below 2**63.
LIMIT = float(1 << 20)
STATE = "vec_id long, v array<int>, cluster int, was int, upper double, lower double, distance long, scans int"


def whole_vectors(rows: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", dim: int = DIM, scale: int = SCALE) -> DataFrame:
    """vec_id and v (whole numbers) of the vectors that count."""
    e = F.col(embedding)
    fits = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < LIMIT))
    return rows.where((F.size(e) == dim) & fits).select(F.col(vec_id).cast("long").alias("vec_id"), F.transform(e, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("int")).alias("v"))


def starting(vectors: DataFrame, k: int = K, seed: int = SEED) -> list[list[int]]:
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    return [list(r["v"]) for r in vectors.orderBy(F.sha2(name, 256), "v").limit(k).collect()]


def outwards(x: np.ndarray) -> np.ndarray:
    return np.nextafter(x * (1 + 2.0**-48), np.inf)


def inwards(x: np.ndarray) -> np.ndarray:
    return np.nextafter(x * (1 - 2.0**-48), -np.inf)


def squared(v: np.ndarray, c: np.ndarray) -> np.ndarray:
    d = v - c
    return np.einsum("ij,ij->i", d, d)


def scan(v: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cluster, upper and lower bound from all exact distances."""
    d = np.stack([squared(v, c) for c in centroids], axis=1)
    near = d.argmin(axis=1)
    upper = outwards(np.sqrt(d[np.arange(len(v)), near].astype(np.float64)))
    second = np.partition(d, 1, axis=1)[:, 1].astype(np.float64) if len(centroids) > 1 else np.full(len(v), np.inf)
    return near, upper, inwards(np.sqrt(second))


class Move:
    """What a round needs of the centroids: where they are, how far each has moved, and half the distance to the nearest other one."""

    def __init__(self, centroids: list[list[int]], before: list[list[int]] | None):
        self.c = np.array(centroids, np.int64)
        k = len(self.c)
        gaps = np.array([[float(sum((int(x) - int(y)) ** 2 for x, y in zip(a, b, strict=True))) for b in centroids] for a in centroids])
        np.fill_diagonal(gaps, np.inf)
        self.half = inwards(np.sqrt(gaps.min(axis=1)) / 2)
        self.first = before is None
        if before is not None:
            drift = outwards(np.sqrt(squared(self.c, np.array(before, np.int64)).astype(np.float64)))
            self.drift, self.others = drift, np.array([max([0.0, *np.delete(drift, i)]) for i in range(k)])

    def step(self, v: np.ndarray, cluster: np.ndarray, upper: np.ndarray, lower: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Cluster, upper, lower and whether all centroids were met."""
        if self.first:
            return *scan(v, self.c), np.ones(len(v), bool)
        upper, lower = outwards(upper + self.drift[cluster]), inwards(lower - self.others[cluster])
        safe = np.maximum(lower, self.half[cluster])
        open_ = np.flatnonzero(~(upper < safe))
        upper[open_] = outwards(np.sqrt(squared(v[open_], self.c[cluster[open_]]).astype(np.float64)))
        open_ = open_[~(upper[open_] < safe[open_])]
        cluster = cluster.copy()
        met = np.zeros(len(v), bool)
        if len(open_):
            cluster[open_], upper[open_], lower[open_] = scan(v[open_], self.c)
            met[open_] = True
        return cluster, upper, lower, met


def assign(state: DataFrame, move: Move) -> DataFrame:
    """The next state; of a first round, ``state`` is vec_id and v only. No exchange."""
    sent = state.sparkSession.sparkContext.broadcast(move)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for b in batches:
            n = b.num_rows
            v = b.column(1).flatten().to_numpy().astype(np.int64).reshape(n, -1)
            old = (np.full(n, -1), np.zeros(n), np.zeros(n), np.zeros(n, np.int64)) if m.first else tuple(b.column(i).to_numpy() for i in (2, 4, 5, 7))
            cluster, upper, lower, met = m.step(v, old[0], old[1].copy(), old[2].copy())
            own = squared(v, m.c[cluster])
            cols = [pa.array(cluster.astype(np.int32)), pa.array(old[0].astype(np.int32)), pa.array(upper), pa.array(lower), pa.array(own), pa.array((old[3] + met).astype(np.int32))]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *cols], names=["vec_id", "v", "cluster", "was", "upper", "lower", "distance", "scans"])

    return state.mapInArrow(run, STATE)


def changes(state: DataFrame, dim: int) -> dict[int, tuple[int, list[int]]]:
    """Of each cluster that won or lost vectors: the change of its count and of its sums. At most one row a cluster reaches the driver."""
    moved = state.where("cluster <> was").select("v", F.explode(F.array(F.struct(F.col("cluster").alias("c"), F.lit(1).alias("sign")), F.struct(F.col("was").alias("c"), F.lit(-1).alias("sign")))).alias("x")).where("x.c >= 0")
    sums = [F.sum(F.col("x.sign") * F.element_at("v", i + 1).cast("long")).alias(f"s{i}") for i in range(dim)]
    return {r[0]: (r[1], list(r[2:])) for r in moved.groupBy(F.col("x.c").alias("c")).agg(F.sum("x.sign"), *sums).collect()}


def cluster(rows: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", k: int = K, dim: int = DIM, rounds: int = ROUNDS, scale: int = SCALE, seed: int = SEED) -> DataFrame:
    """One row per vector that counts: vec_id, cluster, distance (squared), cluster_inertia, inertia, centroid_sha256 (of the final centroid's components, decimal, comma-joined), scans (how often it met all centroids)."""
    spark = rows.sparkSession
    state = materialize(whole_vectors(rows, vec_id, embedding, dim, scale))
    centroids, before = starting(state, k, seed), None
    if not centroids:
        return spark.createDataFrame([], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string, scans int")
    counts, sums = [0] * len(centroids), [[0] * dim for _ in centroids]
    for r in range(rounds + 1):
        done = stage_tables()
        state = materialize(assign(state, Move(centroids, before)))
        for at in stage_tables_since(done - 1)[:1]:  # the last round's table
            drop_table(spark, at)
        if r == rounds:
            break
        for c, (n, s) in changes(state, dim).items():
            counts[c] += n
            sums[c] = [x + y for x, y in zip(sums[c], s, strict=True)]
        before, centroids = centroids, [[x // n for x in s] if n else c for c, n, s in zip(centroids, counts, sums, strict=True)]
    per = {r["cluster"]: int(r["d"]) for r in state.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("d")).collect()}
    fit = lambda x: x if x < 1 << 63 else None
    table = [(c, fit(d), fit(sum(per.values())), hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest()) for c, d in sorted(per.items())]
    of = F.broadcast(spark.createDataFrame(table, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"))  # a row a cluster
    return state.join(of, "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256", "scans")


def nearest(v: Column, centroids: list[list[int]]) -> Column:
    """The number of the nearest centroid as an expression, for vectors that come later."""
    far = lambda c: F.aggregate(F.zip_with(v, F.array(*map(F.lit, c)), lambda x, y: (x.cast("long") - y) * (x.cast("long") - y)), F.lit(0).cast("long"), lambda s, x: s + x)
    return F.array_min(F.array(*[F.struct(far(c).alias("d"), F.lit(i).alias("c")) for i, c in enumerate(centroids)]))["c"]
