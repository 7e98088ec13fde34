"""Every registered query against its SQL on the smallest tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.oracle import compare, duck

SF = "/root/testdata/sf0.001"
SQL = oracle_sql()
ALL = queries()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", list(ALL))
def test_query(spark, con, name):
    df = ALL[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    rows, result = compare(spark, con, name, lambda *_: df, SQL.get(name), SF)
    assert result in ("ok", "no sql")


def test_entry(spark):
    df = entry(spark)
    assert "OUTLIER_DETECTED" in df.columns and df.count() > 0


def test_every_sql_has_a_query():
    assert set(SQL) <= set(ALL)
