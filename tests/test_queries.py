"""Every query of the library against its SQL, on the smallest tables."""

import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__
from lotline.plans import catalog

DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DIR), reason="needs the driver's tables")


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for f in os.listdir(DIR):
        con.sql(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{DIR}/{f}'")
    return con


def rows(df):
    def text(v):
        if v is None or v is pd.NA or v is pd.NaT or isinstance(v, float) and v != v:
            return "null"
        return f"{v:.6g}" if isinstance(v, float) else str(v)

    df = df[sorted(df.columns)].astype(object)
    return sorted(tuple(text(float(v)) if isinstance(v, int | float) and not isinstance(v, bool) else text(v) for v in r) for r in df.itertuples(index=False))


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, sql, name):
    got = catalog.QUERIES[name](spark, DIR).toPandas()
    want = sql.sql(catalog.ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_filters_and_columns_reach_the_scan(spark):
    plan = catalog.QUERIES["j17_anti"](spark, DIR)._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(o_totalprice), GreaterThan(o_totalprice,100000.0)" in plan
    assert "ReadSchema: struct<o_custkey:bigint,o_totalprice:double>" in plan
