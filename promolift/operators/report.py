"""Reports (R1-R5, A11, A13, A17, K1, P18)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.metrics import smape

HALO_SHARE = 0.8   # fixed: item effect above 0.8 x cluster effect reads as a halo


def verdict(item_effect: Column, cluster_effect: Column, cluster_size: Column) -> Column:
    """R2: cannibalisation verdict from the item and cluster campaign effects."""
    return (F.when(cluster_size <= 1,
                   F.when(item_effect > 0, "Positive (sole)").when(item_effect < 0, "Negative (sole)")
                   .otherwise("Neutral (sole)"))
            .when((item_effect > 0) & (cluster_effect > 0),
                  F.when(item_effect > cluster_effect * HALO_SHARE, "Halo").otherwise("Positive"))
            .when((item_effect > 0) & (cluster_effect < 0), "Cannibalization")
            .when(item_effect < 0, "Negative")
            .otherwise("Neutral"))


def pct(effect: Column, base: Column) -> Column:
    """Percentage of a base, 0 when the base is not positive."""
    return F.when(base > 0, effect / base * 100).otherwise(F.lit(0.0))


def campaign_summary(item_pred: DataFrame, cluster_pred: DataFrame, master: DataFrame,
                     cluster_sizes: DataFrame) -> DataFrame:
    """One row per item: per-week campaign / baseline units, totals, effect, cluster
    totals (kg/L) and the verdict.  ``*_pred``: (id, campaign_week, campaign_on,
    prediction_kgl)."""
    m = master.select("baseItemId", F.col("itemDesc").alias("description"),
                      F.col("cluster1To1Id").alias("cluster_id"), "itemUnitConversion")
    units = lambda c: F.when(F.col("itemUnitConversion") > 0, c / F.col("itemUnitConversion")).otherwise(0.0)  # noqa
    ip = item_pred.join(m, "baseItemId")
    aggs = []
    for wk in (1, 2, 3):
        for on, name in ((True, "campaign"), (False, "baseline")):
            aggs.append(F.sum(F.when((F.col("campaign_week") == wk) & (F.col("campaign_on") == on),
                                     units(F.col("prediction_kgl")))).alias(f"item_w{wk}_{name}"))
    s = ip.groupBy(F.col("baseItemId").alias("item_id"), "description", "cluster_id").agg(*aggs).fillna(0.0)
    s = (s.withColumn("item_campaign_total", sum(F.col(f"item_w{k}_campaign") for k in (1, 2, 3)))
         .withColumn("item_baseline_total", sum(F.col(f"item_w{k}_baseline") for k in (1, 2, 3)))
         .withColumn("item_effect", F.col("item_campaign_total") - F.col("item_baseline_total"))
         .withColumn("item_effect_pct", pct(F.col("item_effect"), F.col("item_baseline_total"))))
    ct = cluster_pred.groupBy(F.col("cluster1To1Id").alias("cluster_id")).agg(
        F.sum(F.when(F.col("campaign_on"), F.col("prediction_kgl"))).alias("cluster_campaign_total"),
        F.sum(F.when(~F.col("campaign_on"), F.col("prediction_kgl"))).alias("cluster_baseline_total"))
    s = (s.join(ct, "cluster_id", "left").fillna(0.0, subset=["cluster_campaign_total", "cluster_baseline_total"])
         .join(cluster_sizes.select(F.col("cluster1To1Id").alias("cluster_id"),
                                    F.col("num_items_in_cluster").alias("cluster_size")), "cluster_id", "left")
         .withColumn("cluster_size", F.coalesce(F.col("cluster_size"), F.lit(1)).cast("long"))
         .withColumn("cluster_effect_kg", F.col("cluster_campaign_total") - F.col("cluster_baseline_total"))
         .withColumn("cluster_effect_pct", pct(F.col("cluster_effect_kg"), F.col("cluster_baseline_total"))))
    return s.withColumn("verdict", verdict(F.col("item_effect"), F.col("cluster_effect_kg"), F.col("cluster_size")))


def forecast_totals(summary: DataFrame) -> DataFrame:
    """Grand totals of the item rows (mixed units, indicative)."""
    t = summary.agg(F.sum("item_campaign_total").alias("total_campaign"),
                    F.sum("item_baseline_total").alias("total_baseline"))
    return (t.withColumn("total_effect", F.col("total_campaign") - F.col("total_baseline"))
            .withColumn("total_effect_pct", pct(F.col("total_effect"), F.col("total_baseline"))))


def compare_with_actuals(pred: DataFrame, base: DataFrame, actual: DataFrame, key: str | list[str],
                         needs_prediction: bool = False) -> DataFrame:
    """P18 core: totals over the campaign weeks, SMAPE of actual vs predicted, lifts
    against the baseline; ids without actuals are skipped (inner join).  With
    ``needs_prediction`` (clusters) SMAPE is null where the prediction isn't positive."""
    p = pred.groupBy(key).agg(F.sum("prediction_kgl").alias("predicted"))
    b = base.groupBy(key).agg(F.sum("baseline_kgl").alias("baseline"))
    a = actual.groupBy(key).agg(F.sum("actual_kgl").alias("actual"))
    j = a.join(p, key, "left").join(b, key, "left").fillna(0.0, subset=["predicted", "baseline"])
    den = (F.abs(F.col("actual")) + F.abs(F.col("predicted"))) / 2
    sm = F.when(den == 0, F.lit(0.0)).otherwise(F.abs(F.col("actual") - F.col("predicted")) / den) * 100
    if needs_prediction:
        sm = F.when(F.col("predicted") > 0, sm)
    lift = lambda x: F.when(F.col("baseline") > 0, (x / F.col("baseline") - 1) * 100).otherwise(F.lit(0.0))  # noqa
    return (j.withColumn("smape", sm).withColumn("lift_actual", lift(F.col("actual")))
            .withColumn("lift_predicted", lift(F.col("predicted"))))


def yoy_effect(campaign: DataFrame, last_year: DataFrame, key: str) -> DataFrame:
    """Campaign total against the same three weeks a year before (A14), in percent; 0
    where last year sold nothing, null where it has no rows.  ``campaign``: key and
    campaign_total."""
    ly = F.col("last_year_w1") + F.col("last_year_w2") + F.col("last_year_w3")
    j = campaign.join(last_year.select(key, ly.alias("last_year_total")), key, "left")
    change = (F.col("campaign_total") - F.col("last_year_total")) / F.col("last_year_total") * 100
    return j.select(key, "campaign_total", "last_year_total",
                    F.when(F.col("last_year_total") > 0, change).when(F.col("last_year_total").isNotNull(), 0.0).alias("yoy_pct"))


def backtest_summary(results: DataFrame) -> DataFrame:
    """Mean / median SMAPE and mean lift error, item and cluster level."""
    return results.agg(
        F.avg("item_smape").alias("item_mean_smape"), F.median("item_smape").alias("item_median_smape"),
        F.avg(F.col("item_lift_predicted") - F.col("item_lift_actual")).alias("item_mean_lift_error"),
        F.avg("cluster_smape").alias("cluster_mean_smape"),
        F.median("cluster_smape").alias("cluster_median_smape"),
        F.avg(F.col("cluster_lift_predicted") - F.col("cluster_lift_actual")).alias("cluster_mean_lift_error"),
        F.count("*").alias("n_items"))


def best_worst(results: DataFrame, col: str = "item_smape", n: int = 5) -> DataFrame:
    """K1: the n best and n worst rows by SMAPE (top-k report; ties by id)."""
    best = results.orderBy(F.col(col).asc_nulls_last(), "campaign_id", "item_id").limit(n) \
        .withColumn("rank_kind", F.lit("best"))
    worst = results.orderBy(F.col(col).desc_nulls_last(), "campaign_id", "item_id").limit(n) \
        .withColumn("rank_kind", F.lit("worst"))
    return best.unionByName(worst)


def scenario_comparison(no: DataFrame, yes: DataFrame, key: str = "itemId") -> DataFrame:
    """Union the two scenario forecasts, sum by (key, scenario, horizon), pivot the
    scenario and add absolute and % lift (base 0 -> 1e-6)."""
    u = no.withColumn("scenario", F.lit("no_campaign")).unionByName(
        yes.withColumn("scenario", F.lit("campaign")), allowMissingColumns=True)
    p = u.groupBy(key, "horizon").pivot("scenario", ["no_campaign", "campaign"]).agg(F.sum("prediction"))
    base = F.when(F.col("no_campaign") == 0, F.lit(1e-6)).otherwise(F.col("no_campaign"))
    return (p.withColumn("abs_lift", F.col("campaign") - F.col("no_campaign"))
            .withColumn("pct_lift", (F.col("campaign") - F.col("no_campaign")) / base * 100))

