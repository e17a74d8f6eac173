"""Every registered query with an oracle must match its DuckDB formulation (sf0.001)."""
import pytest

import __spark_entry__ as E
from promolift import session
from scripts.check_oracle import key, norm

from .conftest import SF_SMALL

NO_GO = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "PythonUDF"]
SQL = E.oracle_sql()
NAMES = sorted(SQL)


@pytest.fixture
def plans():
    """The plans of the stages that a query writes out on its way."""
    seen = []
    look = lambda df: seen.append(df._jdf.queryExecution().executedPlan().toString())
    session.LISTENERS.append(look)
    yield seen
    session.LISTENERS.remove(look)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, plans, name):
    """Equal rows, and no pair join or row-wise Python in any stage."""
    sdf = E.queries()[name](spark, SF_SMALL)
    plans.append(sdf._jdf.queryExecution().executedPlan().toString())
    assert not [k for k in NO_GO for p in plans if k in p]
    scols = sdf.columns
    srows = [tuple(norm(x) for x in r) for r in sdf.collect()]
    res = duck.execute(SQL[name])
    dcols = [d[0] for d in res.description]
    assert sorted(scols) == sorted(dcols)
    idx = [dcols.index(c) for c in scols]
    drows = [tuple(norm(r[i]) for i in idx) for r in res.fetchall()]
    assert len(srows) == len(drows)
    assert sorted(srows, key=key) == sorted(drows, key=key)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "campaign_lift" in df.columns


#: The year's backtest trains models for every campaign; test_backtest.py runs it for some.
YEARLY = {"backtest", "backtest_failures", "backtest_summary", "best_worst"}


@pytest.mark.parametrize("name", sorted(set(E.queries()) - set(SQL) - YEARLY))
def test_query_runs(spark, name):
    df = E.queries()[name](spark, SF_SMALL)
    assert df.columns
    df.limit(5).collect()
