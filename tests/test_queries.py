"""Every query against its SQL check, and checks of the plans."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check import compare, connect
from tidemark.plans.catalog import QUERIES

NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def con(folder):
    return connect(folder)


@pytest.mark.parametrize("name", NAMES)
def test_query_agrees_with_sql(spark, con, folder, name):
    count, problem = compare(spark, con, name, folder)
    assert problem is None, problem


def test_every_query_has_a_check():
    assert set(QUERIES) <= set(queries())
    assert set(QUERIES) <= set(oracle_sql())


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["customer_id", "level", "type", "points_amount", "comments"]


PLANNED = [n for n in NAMES if not n.endswith("_stream")]


@pytest.mark.parametrize("name", PLANNED)
def test_plan_has_no_python_and_no_cartesian_product(spark, folder, name):
    plan = QUERIES[name](spark, folder)._jdf.queryExecution().executedPlan().toString()
    for operator in ("EvalPython", "MapInPandas", "FlatMapGroups", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert operator not in plan
