"""First-generation scenario forecast.

Per horizon h: a cluster model predicts the (cluster, week) total h weeks ahead on
log1p, an item-share model predicts the item's share of its cluster h weeks ahead on
the logit scale; all models grow in one pass.  At the snapshot week (campaign start - h
weeks) the change of each scenario is laid over the rows (C7): the focus items' campaign
flag forced off and on, and with it their rivals' flag, the counters and the cluster's
own features.  Shares are renormalised where they sum above 1 in a (cluster, week,
scenario) (W16), multiplied by the scenario's predicted cluster total (J12) and compared
per item and horizon (A11).  Ids enter the trees as means of their earlier labels
(``encoding``).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import as_date, lit_date
from ..functions.mathx import clip, logit, sigmoid
from ..functions.metrics import mae, rmsle, smape_legacy, weighted_smape
from ..operators.boosting import Boosting, Fit, fit_many
from ..operators.encoding import ordered_mean
from ..operators.legacy import legacy_cluster_frame, legacy_processed
from ..operators.models import training_rows
from ..operators.report import scenario_comparison
from ..operators.universe import base_item_id, valid_orders
from .preprocess import materialize

SHARE_FLOOR = 1e-6
G1_PARAMS = Boosting(rounds=2000, patience=None, step=0.05, leaves=63, least_rows=200)   # fixed values

CLUSTER_FEATURES = ["is_campaign_week", "cluster_sales_lag_1", "cluster_sales_rolling4w", "weeks_since_campaign",
                    "campaigns_ytd", "month", "week", "year", "cluster_mean"]
ITEM_FEATURES = ["item_mean", "cluster_mean", "is_campaign_week", "weeks_since_campaign", "other_campaign_in_cluster",
                 "campaigns_ytd", "month", "week", "item_sales_lag_1", "item_share_lag_1"]
SCENARIOS = ("no_campaign", "with_campaign")


def monday(d) -> _dt.date:
    d = as_date(d)
    return d - _dt.timedelta(days=d.weekday())


def horizons(forecast_date, start, end) -> list[int]:
    """T6 (first generation): weeks from the forecast week to each campaign week."""
    a = (monday(start) - monday(forecast_date)).days // 7
    b = (monday(end) - monday(forecast_date)).days // 7
    return list(range(a, b + 1))


def item_frame(g1: DataFrame) -> DataFrame:
    """Item share of its (week, cluster) total, the other-campaign flag and lags."""
    v = g1.withColumn("_v", F.greatest(F.col("salesQuantityKgL"), F.lit(0.0)))
    tot = v.groupBy("orderDate", "cluster1To1Id").agg(F.sum("_v").alias("_tot"),
                                                       F.max("is_campaign_week").alias("_cmax"))
    j = v.join(tot, ["orderDate", "cluster1To1Id"])
    w = Window.partitionBy("itemId").orderBy("orderDate")
    j = (j.withColumn("item_share_of_cluster", F.col("_v") / F.greatest(F.col("_tot"), F.lit(SHARE_FLOOR)))
         .withColumn("other_campaign_in_cluster", ((F.col("_cmax") == 1) & (F.col("is_campaign_week") == 0)).cast("int")))
    return (j.withColumn("item_sales_lag_1", F.coalesce(F.lag("_v", 1).over(w), F.lit(0.0)))
            .withColumn("item_share_lag_1", F.coalesce(F.lag("item_share_of_cluster", 1).over(w), F.lit(0.0)))
            .withColumn("salesQuantityKgL", F.col("_v")).drop("_v", "_tot", "_cmax"))


def cluster_rows(cl: DataFrame, h: int) -> DataFrame:
    """Cluster weeks with the total ``h`` rows ahead (``target``, null where unknown), its
    label and the cluster's mean of earlier labels."""
    w = Window.partitionBy("cluster1To1Id").orderBy("orderDate")
    d = cl.withColumn("target", F.lead("cluster_sales_kg", h).over(w)).withColumn("_known", F.lead("orderDate", h).over(w))
    d = d.withColumn("label", F.log1p(F.greatest(F.col("target"), F.lit(1e-3))))
    d = d.withColumn("label", F.when(F.col("target").isNotNull(), F.col("label")))
    return ordered_mean(d, "cluster1To1Id", "orderDate", "label", "_known", "cluster_mean").drop("_known")


def item_rows(it: DataFrame, h: int) -> DataFrame:
    """Item weeks with the share ``h`` rows ahead, its label and the item's and the cluster's
    means of earlier labels."""
    w = Window.partitionBy("itemId").orderBy("orderDate")
    d = it.withColumn("target", F.lead("item_share_of_cluster", h).over(w)).withColumn("_known", F.lead("orderDate", h).over(w))
    d = d.withColumn("label", logit(F.col("target")))
    d = ordered_mean(d, "itemId", "orderDate", "label", "_known", "item_mean")
    return ordered_mean(d, "cluster1To1Id", "orderDate", "label", "_known", "cluster_mean").drop("_known")


def overlay(items: DataFrame, focus: DataFrame) -> DataFrame:
    """C7 on a week's item rows: each row once per scenario, with the focus items' flag forced
    off and on.  What follows from flags is made anew per scenario: whether another item of
    the cluster has the campaign, and the running counters over the cluster's rows (W7), from
    their state before the week."""
    ids = focus.select(F.col(focus.columns[0]).alias("_b")).distinct()
    d = items.join(ids, base_item_id(items["itemId"]) == ids["_b"], "left").withColumn("_focus", F.col("_b").isNotNull()).drop("_b")
    on = (F.col("is_campaign_week") == 1).cast("long")
    running = lambda keys: Window.partitionBy(*keys).orderBy("itemId").rowsBetween(Window.unboundedPreceding, 0)
    week = running(["cluster1To1Id", "orderDate"])
    d = d.withColumn("_off0", F.col("weeks_since_campaign") - F.sum(1 - on).over(week)).withColumn("_on0", F.col("campaigns_ytd") - F.sum(on).over(week))
    d = d.select("*", F.explode(F.array(*[F.lit(x) for x in SCENARIOS])).alias("scenario"))
    d = d.withColumn("is_campaign_week", F.when(F.col("_focus"), (F.col("scenario") == "with_campaign").cast("int")).otherwise(F.col("is_campaign_week")))
    keys = ["cluster1To1Id", "orderDate", "scenario"]
    d = d.withColumn("weeks_since_campaign", F.col("_off0") + F.sum(1 - on).over(running(keys))).withColumn("campaigns_ytd", F.col("_on0") + F.sum(on).over(running(keys)))
    any_on = d.groupBy(*keys).agg(F.max(on).alias("_any"))
    d = d.join(any_on, keys)
    return d.withColumn("other_campaign_in_cluster", ((F.col("_any") == 1) & (on == 0)).cast("int")).drop("_off0", "_on0", "_any")


def cluster_overlay(clusters: DataFrame, items: DataFrame) -> DataFrame:
    """A week's cluster rows per scenario: flag and counters rolled up from the ``overlay`` rows
    as the cluster frame does (A8), the rest as it is."""
    up = items.groupBy("cluster1To1Id", "orderDate", "scenario").agg(
        F.max("is_campaign_week").alias("is_campaign_week"), F.avg("weeks_since_campaign").alias("weeks_since_campaign"), F.max("campaigns_ytd").alias("campaigns_ytd"))
    return clusters.drop("is_campaign_week", "weeks_since_campaign", "campaigns_ytd").join(up, ["cluster1To1Id", "orderDate"])


def _kg(prediction):
    return F.greatest(F.expm1(clip(prediction, -10, 20)), F.lit(0.0))


def run_scenarios(orders: DataFrame, items: DataFrame, campaigns: DataFrame, focus: DataFrame,
                  campaign_start, campaign_end, forecast_date, cutoff=None, params: Boosting = G1_PARAMS):
    """Returns (cluster model metrics, combined forecasts, comparison)."""
    cutoff = cutoff or forecast_date
    focus = materialize(focus, "checkpoint")   # asked for at every horizon; it may come from the order lines
    g1 = materialize(legacy_processed(valid_orders(orders), items, campaigns), "checkpoint")
    cl = materialize(legacy_cluster_frame(g1).fillna(0.0, subset=["cluster_sales_rolling4w"]), "checkpoint")
    it = materialize(item_frame(g1), "checkpoint")
    hs = horizons(forecast_date, campaign_start, campaign_end)
    frames, rows = {}, None
    for h in hs:
        known = F.date_add("orderDate", 7 * h) < lit_date(cutoff)   # the target was known before the cutoff
        for level, d, feats in (("cluster", cluster_rows(cl, h), CLUSTER_FEATURES), ("item", item_rows(it, h), ITEM_FEATURES)):
            frames[level, h] = materialize(d, "checkpoint")
            own = frames[level, h].where(F.col("label").isNotNull() & known).withColumn("split", F.lit("train")).withColumn("weight", F.lit(1.0))
            own = training_rows(own, feats, f"{level}-{h}", "label")
            rows = own if rows is None else rows.unionByName(own)
    names = {f"{level}-{h}": CLUSTER_FEATURES if level == "cluster" else ITEM_FEATURES for level, h in frames}
    models = fit_many(materialize(rows, "checkpoint"), [Fit(n, n, params) for n in names], names, task_models=1)
    metrics, combined = [], None
    for h in hs:
        cm, im = models.get(f"cluster-{h}"), models.get(f"item-{h}")
        if cm is None or im is None:
            raise ValueError(f"no training rows for horizon {h} before {cutoff}")
        held = frames["cluster", h].where(F.col("target").isNotNull() & ~(F.date_add("orderDate", 7 * h) < lit_date(cutoff)))
        a, p = F.col("target"), _kg(F.col("prediction"))
        m = cm.transform(held.select("target", *CLUSTER_FEATURES)).agg(
            mae(a, p).alias("mae"), smape_legacy(a, p).alias("smape"), weighted_smape(a, p).alias("weighted_smape"), rmsle(a, p).alias("rmsle"), F.count("*").alias("n_test")).first()
        metrics.append((h, m["mae"], m["smape"], m["weighted_smape"], m["rmsle"], m["n_test"]))
        as_of = monday(campaign_start) - _dt.timedelta(weeks=h)
        at = F.col("orderDate") == F.lit(as_of)
        snap = materialize(overlay(frames["item", h].where(at), focus), "checkpoint")
        totals = cm.transform(cluster_overlay(frames["cluster", h].where(at), snap)).select("cluster1To1Id", "scenario", _kg(F.col("prediction")).alias("pred_cluster"))
        keys = ["cluster1To1Id", "orderDate", "scenario"]
        sp = im.transform(snap.select(*keys, "itemId", "_focus", *[f for f in ITEM_FEATURES if f not in keys])).withColumn("pred_share", clip(sigmoid(F.col("prediction")), 0.0, 1.0))
        tot = sp.groupBy(*keys).agg(F.sum("pred_share").alias("_s"))
        sp = sp.join(tot, keys).withColumn("pred_share", F.when(F.col("_s") > 1, F.col("pred_share") / F.col("_s")).otherwise(F.col("pred_share")))
        comb = (sp.join(totals, ["cluster1To1Id", "scenario"], "left")
                .select("itemId", "cluster1To1Id", "scenario", F.lit(h).alias("horizon"), "_focus", "pred_share",
                        "pred_cluster", (F.col("pred_share") * F.col("pred_cluster")).alias("predicted_quantity_kg"),
                        F.lit(as_of).alias("feature_week"),
                        F.lit(as_of + _dt.timedelta(weeks=h)).alias("target_week")))
        combined = comb if combined is None else combined.unionByName(comb)
    combined = materialize(combined, "checkpoint")
    focus_rows = combined.where("_focus").select("itemId", "scenario", "horizon",
                                                 F.col("predicted_quantity_kg").alias("prediction"))
    comp = scenario_comparison(focus_rows.where(F.col("scenario") == "no_campaign").drop("scenario"),
                               focus_rows.where(F.col("scenario") == "with_campaign").drop("scenario"))
    return metrics, combined.drop("_focus"), comp
