"""Every query with an SQL form gives the same rows as that SQL at the smallest scale,
by a plan without cross joins and without Python workers."""

from __future__ import annotations

import pytest
from check_oracle import compare, connect
from conftest import SF_DIR

import __spark_entry__ as entry

ORACLE = entry.oracle_sql()
QUERIES = entry.queries()
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "EvalPython", "InPandas")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [f for f in FORBIDDEN if f in plan]
    assert compare(con, df, ORACLE[name]) is None


def test_every_sql_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["customer_id", "item_id", "score", "rank"]
    assert df.limit(5).count() == 5
