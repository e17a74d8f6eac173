"""Invariants of the pipeline outputs and of the physical plans (sf0.001)."""
from pyspark.sql import functions as F

import __spark_entry__ as E

from .conftest import SF_SMALL

Q = E.queries()


def _run(spark, name):
    return Q[name](spark, SF_SMALL)


def test_cluster_intensity_in_unit_interval(spark):
    df = _run(spark, "weekly_cluster_sales")
    for c in ["campaign_week_0", "campaign_week_1", "campaign_week_2", "campaign_week_3"]:
        r = df.agg(F.min(c), F.max(c)).first()
        assert 0.0 <= r[0] <= r[1] <= 1.0


def test_baseline_shares_sum_to_one(spark):
    df = _run(spark, "item_share_in_cluster")
    sums = df.groupBy("cluster1To1Id").agg(F.sum("item_share_in_cluster").alias("s")).collect()
    assert sums and all(abs(r["s"] - 1.0) < 1e-3 for r in sums)


def test_renormalised_shares_at_most_one(spark):
    df = _run(spark, "share_renormalized")
    worst = df.groupBy("cluster1To1Id", "week_start").agg(F.sum("pred_share").alias("s")).agg(F.max("s")).first()[0]
    assert worst <= 1.0 + 1e-3


def test_gap_fill_grid_is_complete(spark):
    df = _run(spark, "gap_filled_weeks")
    n_ids = df.select("baseItemId").distinct().count()
    n_weeks = df.select("week_start").distinct().count()
    assert df.count() == n_ids * n_weeks
    assert df.groupBy("baseItemId", "week_start").count().where("count > 1").count() == 0


def test_forecast_intervals_and_effects(spark):
    iv = _run(spark, "forecast_intervals")
    assert iv.count() > 0 and iv.where("ordered = 0").count() == 0
    s = _run(spark, "campaign_summary")
    bad = s.where(F.abs(F.col("item_effect") - (F.col("item_campaign_total") - F.col("item_baseline_total"))) > 1e-3)
    assert bad.count() == 0
