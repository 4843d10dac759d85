"""What the training-data operators share: reading, stage tables, prefix sums and hashing."""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import functools
import math
import uuid
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import SparkContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from lotline.session import shared_dir


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


#: Stage tables of this process.
_written: list[str] = []


def stage_tables() -> int:
    return len(_written)


def stage_tables_since(since: int) -> list[str]:
    return _written[since:]


def drop_stage_tables(spark: SparkSession, since: int = 0) -> None:
    """Removes the stage tables that this process wrote (all, or those after the first ``since``). Results that rest on them and were not yet written or collected can't be read after that."""
    while len(_written) > since:
        drop_table(spark, _written.pop())


def drop_table(spark: SparkSession, at: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(at)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def _drop_at_exit() -> None:
    """What a process didn't remove itself goes when it ends, if its session still runs."""
    spark = SparkSession.getActiveSession()
    if spark is not None and SparkContext._active_spark_context is not None:
        with contextlib.suppress(Exception):  # the JVM may be gone
            drop_stage_tables(spark)


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: the lineage ends there, and a lost executor costs no recomputation. ``drop_stage_tables`` removes the tables once results are written; what is left goes when the process ends."""
    spark = df.sparkSession
    if not _written:
        atexit.unregister(_drop_at_exit)
        atexit.register(_drop_at_exit)
    at = f"{shared_dir(spark)}/lotline-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(at)
    _written.append(at)
    return spark.read.schema(df.schema).parquet(at)


Batches = Iterator[pa.RecordBatch]


def give_back() -> None:
    """Returns to the system what this process's allocators hold unused."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(AttributeError, OSError):  # only glibc has it
        ctypes.CDLL(None).malloc_trim(0)


def released(run: Callable[[Batches], Batches]) -> Callable[[Batches], Batches]:
    """``run`` for mapInArrow, whose worker gives its memory back when the task ends: Spark keeps workers for later tasks, beside those that other stages have at work."""

    @functools.wraps(run)
    def f(batches: Batches) -> Batches:
        try:
            yield from run(batches)
        finally:
            give_back()

    return f


def uniform_hash(seed: int, *cols: Column | str) -> Column:
    """A seeded hash in [0, 2**31)."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *cols), 33)


def bits_for(rows: int, per_bucket: int) -> int:
    """Bits of a hash that deal ``rows`` into buckets of about ``per_bucket`` rows."""
    return max(1, min(30, (max(rows, 1) // per_bucket).bit_length()))


def prefix_sums(df: DataFrame, value: str, fine: str, order: Sequence[str], keys: Sequence[str] = (), out: str = "before", total: str | None = None, fine_count: int = 1 << 18) -> DataFrame:
    """Sum of ``value`` in the rows before each row, by key, in the order of ``fine`` (a long that rises with the order) and then ``order``.

    Three levels, so that no task holds a key: rows of one ``fine`` bucket, buckets of one span, spans of one key. A span is as many buckets as there are spans (``fine_count``: about how many buckets there are in all), so the second and third levels' tasks grow with the square root of the buckets. ``df`` should be a stage table, as it is read twice; ``order`` has to be total for a repeatable result. ``total``: a column for the key's sum. Null keys are a key of their own.
    """
    keys, span = list(keys), max(64, math.isqrt(max(fine_count, 1)))
    w0 = W.partitionBy(fine, *keys).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    rows = df.withColumn("__local", F.coalesce(F.sum(value).over(w0), F.lit(0)))
    sums = df.groupBy(fine, *keys).agg(F.sum(value).alias("__sum")).withColumn("__span", F.floor(F.col(fine) / span))
    w1 = W.partitionBy("__span", *keys).orderBy(fine).rowsBetween(W.unboundedPreceding, -1)
    buckets = sums.withColumn("__in_span", F.coalesce(F.sum("__sum").over(w1), F.lit(0)))
    spans = sums.groupBy("__span", *keys).agg(F.sum("__sum").alias("__span_sum"))
    w2 = W.partitionBy(*keys).orderBy("__span").rowsBetween(W.unboundedPreceding, -1)
    spans = spans.withColumn("__before_span", F.coalesce(F.sum("__span_sum").over(w2), F.lit(0)))
    if total:
        spans = spans.withColumn("__total", F.sum("__span_sum").over(W.partitionBy(*keys)))
    s = spans.select(*[F.col(c).alias(f"__s_{c}") for c in ("__span", *keys)], "__before_span", *(["__total"] if total else []))
    b = buckets.join(s, [buckets[c].eqNullSafe(s[f"__s_{c}"]) for c in ("__span", *keys)])
    b = b.select(*[F.col(c).alias(f"__b_{c}") for c in (fine, *keys)], (F.col("__in_span") + F.col("__before_span")).alias("__base"), *(["__total"] if total else []))
    joined = rows.join(b, [rows[c].eqNullSafe(b[f"__b_{c}"]) for c in (fine, *keys)])
    return joined.select(*[rows[c] for c in df.columns], (F.col("__local") + F.col("__base")).cast("long").alias(out), *([F.col("__total").cast("long").alias(total)] if total else []))


U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser over unsigned integers (a bijection)."""
    x = x.astype(U, copy=True)
    x ^= x >> U(30)
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


#: Lower case of A-Z only: the same in every engine.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(col: Column) -> Column:
    return F.translate(col, UPPER, LOWER)
