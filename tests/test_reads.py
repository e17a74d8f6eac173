"""How often jobs read the order lines and the item versions."""
from promolift import session
from promolift.plans import params as P
from promolift.plans.forecast_job import campaign_items, run_forecast
from promolift.plans.registry import _inputs

from .conftest import SF_SMALL


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_forecast_reads_the_lines_for_targets_and_roll_up_only(spark):
    """What follows the roll-up reads written tables: neither results nor their parts come back to
    the order lines or to all versions of the items."""
    inp, seen = _inputs(spark, SF_SMALL), []
    look = lambda df: seen.append(plan(df))
    session.LISTENERS.append(look)
    try:
        res = run_forecast(inp.orders, inp.items, inp.campaigns, campaign_items(inp.orders, 69), P.CAMPAIGN_START, P.FORECAST_DATE, P.HORIZON,
                           single_model=True, intervals=False)
    finally:
        session.LISTENERS.remove(look)
    assert sum("l_orderkey" in p for p in seen) == 2 and sum("p_partkey" in p for p in seen) == 1
    for df in (res.summary, res.item_predictions, res.cluster_predictions, res.pre.items):
        assert "l_orderkey" not in plan(df) and "p_partkey" not in plan(df)


def test_a_backtest_reads_the_lines_once(spark):
    """Campaigns share the written valid lines, pairs and items."""
    from promolift.plans.backtest import run_backtest
    inp, seen = _inputs(spark, SF_SMALL), []
    look = lambda df: seen.append(plan(df))
    session.LISTENERS.append(look)
    try:
        out, failed = run_backtest(inp.orders, inp.items, inp.campaigns, P.BACKTEST_YEAR, max_campaigns=2, single_model=True)
    finally:
        session.LISTENERS.remove(look)
    assert out.count() > 0 and failed.count() == 0
    assert sum("l_orderkey" in p for p in seen) == 1 and not any("l_orderkey" in plan(d) for d in (out, failed))
