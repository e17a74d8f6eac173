"""Registered queries over the wide key space, where every part is a base item of its own: the
tables behind the weekly roll-up grow with the parts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import features as FE
from ..operators import training as TR
from . import oracle as O
from . import params as P
from .registry import _filtered_items, _gap_filled_items, _weekly, finalize, register

r = O.r
LAGS = ["sales_lag_week1", "sales_rolling_4w_week1", "sales_lag_week3", "sales_rolling_4w_week3", "sales_lag_12w", "sales_lag_52w"]


@register("wide_weekly_item_sales", O.with_wide_base(f"""
SELECT baseItemId, week_start, cluster1To1Id, {r('salesQuantityKgL')} AS salesQuantityKgL, CAST(n_campaign_items_in_cluster AS BIGINT) AS n_campaign_items_in_cluster,
       {r('campaign_coverage')} AS campaign_coverage, {r('item_share_in_cluster')} AS item_share_in_cluster FROM iw1
"""))
def wide_weekly_item_sales(spark, sf):
    """A1, A3-A5 and C1."""
    iw, _ = _weekly(spark, sf, wide=True)
    return finalize(iw.select("baseItemId", "week_start", "cluster1To1Id", "salesQuantityKgL", "n_campaign_items_in_cluster", "campaign_coverage", "item_share_in_cluster"))


@register("wide_gap_filled_weeks", O.with_wide_base(f"""
SELECT baseItemId, week_start, cluster1To1Id, {r('salesQuantityKgL')} AS salesQuantityKgL, CAST(campaign_week_0 AS BIGINT) AS campaign_week_0 FROM igf
"""))
def wide_gap_filled_weeks(spark, sf):
    """W1."""
    return finalize(_gap_filled_items(spark, sf, wide=True).select("baseItemId", "week_start", "cluster1To1Id", "salesQuantityKgL", "campaign_week_0"))


@register("wide_lag_features", O.with_wide_base(f"""
SELECT baseItemId, week_start, {', '.join(r(c) + ' AS ' + c for c in LAGS)} FROM (SELECT baseItemId, week_start, {O.lag_cols('baseItemId', 4)} FROM ifilt)
"""))
def wide_lag_features(spark, sf):
    """A1, W1, A6, F8, W2 and W3 in a row."""
    f = FE.add_lag_features(_filtered_items(spark, sf, wide=True), "baseItemId", P.HORIZON)
    return finalize(f.select("baseItemId", "week_start", *LAGS))


@register("wide_training_sample", O.with_wide_base("""
, s AS (
  SELECT baseItemId, week_start, 1 AS on_campaign FROM ifilt WHERE campaign_week_1 = 1
  UNION ALL
  SELECT baseItemId, week_start, 0 FROM (
    SELECT * FROM ifilt WHERE baseItemId IN (SELECT baseItemId FROM ifilt WHERE campaign_week_1 = 1) AND campaign_week_1 = 0 AND campaign_week_0 = 1
    QUALIFY row_number() OVER (ORDER BY week_start DESC, baseItemId) <= 5 * (SELECT count(*) FROM ifilt WHERE campaign_week_1 = 1)))
SELECT baseItemId, week_start, CAST(on_campaign AS BIGINT) AS on_campaign,
       CASE WHEN rn < CAST(floor(n * 0.6::DOUBLE) AS BIGINT) THEN 'train' WHEN rn < CAST(floor(n * 0.8::DOUBLE) AS BIGINT) THEN 'val' ELSE 'test' END AS split
FROM (SELECT *, row_number() OVER (ORDER BY week_start, baseItemId) - 1 AS rn, count(*) OVER () AS n FROM s)
"""))
def wide_training_sample(spark, sf):
    """W15 and W12 of the first week's model."""
    f = TR.week_training_frame(_filtered_items(spark, sf, wide=True), "item", 1)
    return finalize(f.select("baseItemId", "week_start", F.col("campaign_week_1").alias("on_campaign"), "split"))
