"""Registry of the library's queries over the driver's tables, with the SQL that checks each.

The tables hold no addresses, so addresses, labels and keys are composed from columns inside the query, and in the SQL alike.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable:
    """Registers a function under its name, with its SQL if that can say the same."""

    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


from lotline.plans import queries_entities, queries_feeds, queries_importers, queries_more, queries_relations, queries_scalars, queries_scale, queries_streams  # noqa: E402, F401  they register themselves
