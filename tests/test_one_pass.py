"""Steps that many models or campaigns share in one pass do what each of them does alone."""
import pytest
from pyspark.sql import functions as F

from promolift.operators import models as M
from promolift.operators import training as TR
from promolift.plans import backtest as B
from promolift.plans import params as P
from promolift.plans.forecast_job import NoTrainingRows, campaign_items
from promolift.plans.preprocess import materialize
from promolift.plans.registry import _inputs, _pre
from promolift.session import union_all

from .conftest import SF_SMALL
from .test_forest import frame


def written(df):
    return materialize(df, "checkpoint")


@pytest.fixture(scope="module")
def pre(spark):
    targets = written(campaign_items(_inputs(spark, SF_SMALL).orders, 69))
    return targets, _pre(spark, SF_SMALL, forecast_date=P.FORECAST_DATE, targets=targets)


@pytest.mark.parametrize("level", ["item", "cluster"])
def test_week_frames_are_those_of_each_week(pre, level):
    targets, p = pre
    targets = targets if level == "item" else None
    df = written(p.item_weekly if level == "item" else p.cluster_weekly)
    seen = []
    own = TR.week_training_frames(df, level, targets, lambda d: seen.append(d) or written(d))
    assert len(seen) == 2 and list(own) == [1, 2, 3]
    filled = written(TR.fill_feature_nulls(df, level))
    for n, f in own.items():
        alone = written(TR.week_training_frame(filled, level, n, targets)).select(f.columns)
        assert f.count() == alone.count() > 0 and f.exceptAll(alone).isEmpty() and dict(f.dtypes) == dict(alone.dtypes)


def test_week_frames_without_campaigns_or_rows(pre):
    _, p = pre
    df = written(p.cluster_weekly)
    own = TR.week_training_frames(df.where("campaign_week_1 = 0 AND campaign_week_2 = 0"), "cluster", None, written)
    assert own[1].isEmpty() and own[2].isEmpty() and not own[3].isEmpty()
    assert all(f.isEmpty() and "split" in f.columns for f in TR.week_training_frames(df.limit(0), "cluster", None, written).values())


def test_metrics_of_many_models_are_those_of_each(spark):
    frames = {f"m{n}": (written(frame(spark, 400, n)), ["x"], M.Boosting(rounds=3)) for n in (1, 2)}
    rows = M.written_rows({name: own[:2] for name, own in frames.items()})
    models = M.fit_rows(rows, frames)
    many = M.evaluate_rows(rows.withColumn("split", F.lit("test")), models)
    for name, model in models.items():
        one = M.evaluate(model, frames[name][0].withColumn("split", F.lit("test")))
        assert many[name]["n"] == one["n"] == 400
        assert all(many[name][k] == pytest.approx(one[k]) for k in one)
    nothing = M.evaluate_rows(rows, models)   # no test rows
    assert nothing["m1"]["n"] == 0 and nothing["m1"]["smape"] is None


def test_unions_in_pairs_keep_all_rows(spark):
    assert sorted(r.id for r in union_all([spark.range(i, i + 1) for i in range(5)]).collect()) == list(range(5))


def test_campaigns_fit_in_one_pass(spark, monkeypatch):
    """All campaigns' models grow together; a campaign without training rows is a failure and
    the others go on."""
    inp, passes, real = _inputs(spark, SF_SMALL), [], B.fit_jobs

    def counted(jobs, **more):
        passes.append({i: len(tasks) for i, tasks in jobs.items()})
        return real(jobs, **more) | {0: NoTrainingRows("no training rows for item-1")}

    monkeypatch.setattr(B, "fit_jobs", counted)
    out, failed = B.run_backtest(inp.orders, inp.items, inp.campaigns, P.BACKTEST_YEAR, max_campaigns=2)
    assert passes == [{0: 6, 1: 6}]
    first, second = (c["campaignId"] for c in B.backtest_campaigns(inp.campaigns, P.BACKTEST_YEAR).orderBy("campaignStart").limit(2).collect())
    assert [tuple(r) for r in failed.collect()] == [(first, "NotEnoughData: no training rows for item-1")]
    assert {r["campaign_id"] for r in out.collect()} == {second}
