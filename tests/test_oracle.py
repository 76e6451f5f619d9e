"""Every registered query against its SQL twin on the smallest tables; the rest must yield rows."""

import pytest
from check_oracle import compare, connect

import __spark_entry__ as contract
from latewatch.plans import QUERIES, SQL




@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(SQL))
def test_twin(spark, sf, con, name):
    """Equal results, and a plan without Python workers or cross products."""
    df = QUERIES[name](spark, sf)
    assert compare(df, con, SQL[name]) == ""
    plan = df._jdf.queryExecution().executedPlan().toString()
    for bad in ("PythonUDF", "ArrowEvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in plan


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_rows_only(spark, sf, name):
    assert QUERIES[name](spark, sf).count() > 0


def test_entry(spark):
    assert contract.entry(spark).count() == 4
