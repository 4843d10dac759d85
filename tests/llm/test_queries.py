"""The subpackage's queries against their SQL, on the smallest tables."""

import os

import duckdb
import pytest

from lotline.llm import queries as Q

from .. import test_queries as base

pytestmark = pytest.mark.skipif(not os.path.isdir(base.DIR), reason="needs the driver's tables")
sql = base.sql


@pytest.mark.parametrize("name", sorted(Q.oracle_sql()))
def test_query(spark, sql, name):
    got = Q.queries()[name](spark, base.DIR).toPandas()
    want = sql.sql(Q.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert base.rows(got) == base.rows(want)


def test_all_queries_are_registered():
    assert len(Q.queries()) == 14 and set(Q.oracle_sql()) < set(Q.queries()) and duckdb
