"""Which row of a key stays: ranking, first and last writes, differences of key sets.

Each takes an explicit order, as arrival has none in Spark. A key's rows are reduced by aggregates where only one row is asked for, so that copies meet before the shuffle; windows are for ranks that the result shows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def best(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key: the first in ``order``, which should be total."""
    w = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rank", F.row_number().over(w)).where("__rank = 1").drop("__rank")


def first_wins(df: DataFrame, keys: Sequence[str], arrival: str) -> DataFrame:
    """The row that came first for each key."""
    return _extreme(df, keys, arrival, F.min_by)


def last_wins(df: DataFrame, keys: Sequence[str], arrival: str) -> DataFrame:
    """The row that came last for each key."""
    return _extreme(df, keys, arrival, F.max_by)


def _extreme(df: DataFrame, keys: Sequence[str], arrival: str, by) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(by(F.struct(*rest), F.col(arrival)).alias("__row"))
    return picked.select(*[F.col(c) if c in keys else F.col(f"__row.{c}").alias(c) for c in df.columns])


def insert_new(current: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``incoming`` whose key ``current`` lacks; keys are never null."""
    return incoming.join(current.select(*keys).distinct(), list(keys), "left_anti")


def insert_or_ignore(current: DataFrame, incoming: DataFrame, keys: Sequence[str], arrival: str) -> DataFrame:
    return current.unionByName(insert_new(current, first_wins(incoming, keys, arrival), keys), allowMissingColumns=True)


def insert_or_replace(current: DataFrame, incoming: DataFrame, keys: Sequence[str], arrival: str) -> DataFrame:
    new = last_wins(incoming, keys, arrival)
    return current.join(new.select(*keys), list(keys), "left_anti").unionByName(new, allowMissingColumns=True)


def ordinals(df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str, first: int = 1) -> DataFrame:
    """The number of each row within its key, from ``first`` on; ``order`` should be total."""
    return df.withColumn(out, F.row_number().over(W.partitionBy(*keys).orderBy(*order)).cast("long") + (first - 1))


def seen_bounds(df: DataFrame, keys: Sequence[str], first: str = "first_seen", last: str = "last_seen") -> DataFrame:
    return df.groupBy(*keys).agg(F.min(first).alias(first), F.max(last).alias(last))


def keyset_after(df: DataFrame, date: str, key: str, cursor: tuple | None, page: int) -> DataFrame:
    """A page in (date, key) descending order, after the cursor."""
    if cursor is not None:
        d, k = cursor
        df = df.where((F.col(date) < d) | ((F.col(date) == d) & (F.col(key) < k)))
    return df.orderBy(F.desc(date), F.desc(key)).limit(page)


def keyset_through(df: DataFrame, key: str, row: str, cursor: object | None, page: int) -> DataFrame:
    """A page in descending order from the cursor on, the cursor's rows again; replays go by the row's id."""
    if cursor is not None:
        df = df.where(F.col(key) <= cursor)
    return df.orderBy(F.desc(key), F.desc(row)).limit(page)


def keyset_above(df: DataFrame, key: str, cursor: object | None, page: int) -> DataFrame:
    """A page in ascending order above the cursor."""
    if cursor is not None:
        df = df.where(F.col(key) > cursor)
    return df.orderBy(key).limit(page)


def carry_forward(df: DataFrame, keys: Sequence[str], order: Sequence[str], column: str, out: str) -> DataFrame:
    """The last value that isn't null, up to each row."""
    w = W.partitionBy(*keys).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    return df.withColumn(out, F.last(column, ignorenulls=True).over(w))


def changes(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str) -> DataFrame:
    """The value before, and the change."""
    before = F.lag(value).over(W.partitionBy(*keys).orderBy(*order))
    return df.withColumn("before", before).withColumn("change", F.col(value) - F.col("before"))


def most_frequent(df: DataFrame, keys: Sequence[str], value: str, position: str, out: str) -> DataFrame:
    """The value that a key has most often; of equals the one that came first. Null and '' don't count."""
    counts = df.where(F.col(value).isNotNull() & (F.col(value) != "")).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("__n"), F.min(position).alias("__first"))
    return counts.groupBy(*keys).agg(F.max_by(value, F.struct("__n", (-F.col("__first")).alias("__f"))).alias(out))
