"""The backtest over some campaigns, and its failure table."""
import pytest

from promolift.plans import backtest as B
from promolift.plans import params as P
from promolift.plans.registry import _inputs

from .conftest import SF_SMALL


def test_two_campaigns(spark):
    inp = _inputs(spark, SF_SMALL)
    out, failed = B.run_backtest(inp.orders, inp.items, inp.campaigns, P.BACKTEST_YEAR, max_campaigns=2)
    rows = out.collect()
    assert failed.count() == 0 and len({r["campaign_id"] for r in rows}) == 2
    assert all(r["item_predicted"] >= 0 and (r["cluster_smape"] is None or r["cluster_smape"] >= 0) for r in rows)


def test_all_failing_is_an_error(spark, monkeypatch):
    inp = _inputs(spark, SF_SMALL)

    def broken(*a, **k):
        raise B.NotEnoughData("no model today")

    monkeypatch.setattr(B, "run_forecast", broken)
    with pytest.raises(RuntimeError, match="no model today"):
        B.run_backtest(inp.orders, inp.items, inp.campaigns, P.BACKTEST_YEAR, max_campaigns=2)


def test_failures_are_returned(spark, monkeypatch):
    inp = _inputs(spark, SF_SMALL)
    real, calls = B.campaign_items, []

    def first_broken(orders, cid):
        calls.append(cid)
        if cid == min(c["campaignId"] for c in B.backtest_campaigns(inp.campaigns, P.BACKTEST_YEAR).collect()):
            raise B.NotEnoughData("broken calendar")
        return real(orders, cid)

    monkeypatch.setattr(B, "campaign_items", first_broken)
    out, failed = B.run_backtest(inp.orders, inp.items, inp.campaigns, P.BACKTEST_YEAR, max_campaigns=2, single_model=True)
    assert [r["reason"] for r in failed.collect()] == ["NotEnoughData: broken calendar"]
    assert out.count() > 0


def test_no_campaign_in_the_year(spark):
    inp = _inputs(spark, SF_SMALL)
    out, failed = B.run_backtest(inp.orders, inp.items, inp.campaigns, 1900)
    assert out.count() == 0 and failed.count() == 0 and "cluster_smape" in out.columns


def test_other_errors_fail_the_job(spark, monkeypatch):
    """A lost executor or a bug is no row of the failure table."""
    inp = _inputs(spark, SF_SMALL)

    def broken(*a, **k):
        raise ZeroDivisionError("a bug")

    monkeypatch.setattr(B, "run_forecast", broken)
    with pytest.raises(ZeroDivisionError):
        B.run_backtest(inp.orders, inp.items, inp.campaigns, P.BACKTEST_YEAR, max_campaigns=2)
