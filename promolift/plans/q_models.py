"""Registered queries: model training, scoring and the forecast report (rows-only:
boosted trees and forests have no SQL formulation).  One forecast job per session
and scale factor is shared by these report queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.units import kgl_to_units
from ..operators import report as R
from . import params as P
from .forecast_job import campaign_items, run_forecast
from .registry import _inputs, finalize, register

_CACHE: dict = {}
FORECAST_CAMPAIGN = 69   # fixed: the last campaign of the fixture calendar is forecast


def forecast_result(spark, sf):
    key = (spark.sparkContext.applicationId, sf)
    if key not in _CACHE:
        inp = _inputs(spark, sf)
        targets = campaign_items(inp.orders, FORECAST_CAMPAIGN)
        _CACHE[key] = run_forecast(inp.orders, inp.items, inp.campaigns, targets, P.CAMPAIGN_START,
                                   P.FORECAST_DATE, P.HORIZON)
    return _CACHE[key]


@register("campaign_forecast")
def campaign_forecast(spark, sf):
    """Item and cluster predictions with the campaign on and off."""
    res = forecast_result(spark, sf)
    i = res.item_predictions.select(F.lit("item").alias("level"), F.col("baseItemId").alias("id"), "campaign_week",
                                    "campaign_on", "prediction_kgl", "q10_kgl", "q50_kgl", "q90_kgl")
    c = res.cluster_predictions.select(F.lit("cluster").alias("level"), F.col("cluster1To1Id").alias("id"),
                                       "campaign_week", "campaign_on", "prediction_kgl", "q10_kgl", "q50_kgl", "q90_kgl")
    return finalize(i.unionByName(c))


@register("forecast_intervals")
def forecast_intervals(spark, sf):
    """Quantile-forest intervals; ``ordered`` checks q10 <= q50 <= q90."""
    res = forecast_result(spark, sf)
    p = res.item_predictions
    return finalize(p.select("baseItemId", "campaign_week", "campaign_on", "q10_kgl", "q50_kgl", "q90_kgl",
                             ((F.col("q10_kgl") <= F.col("q50_kgl")) & (F.col("q50_kgl") <= F.col("q90_kgl")))
                             .alias("ordered")))


@register("campaign_summary")
def campaign_summary(spark, sf):
    """R1 + R2: one row per target item."""
    return finalize(forecast_result(spark, sf).summary)


@register("forecast_totals")
def forecast_totals(spark, sf):
    """A17."""
    return finalize(R.forecast_totals(forecast_result(spark, sf).summary))


@register("order_recommendation")
def order_recommendation(spark, sf):
    """R5 + U3: predicted campaign kg/L back to sales units (divide / round / ceil)."""
    res = forecast_result(spark, sf)
    m = res.pre.items.select("baseItemId", "itemDesc", "itemUnitConversion")
    p = res.item_predictions.where("campaign_on").join(m, "baseItemId")
    f = F.col("itemUnitConversion")
    return finalize(p.select("baseItemId", "itemDesc", "campaign_week", "prediction_kgl",
                             kgl_to_units(F.col("prediction_kgl"), f).alias("units"),
                             kgl_to_units(F.col("prediction_kgl"), f, "round").alias("units_rounded"),
                             kgl_to_units(F.col("prediction_kgl"), f, "ceil").alias("units_ceil")))


def _bundles(model):
    """(campaign week, bundle) of a level's models; week 0 for a pooled one."""
    return sorted(model.weeks.items()) if hasattr(model, "weeks") else [(0, model)]


@register("train_forecast")
def train_forecast(spark, sf):
    """Held-out metrics of the point models, per level and campaign week, with the
    rounds that were grown and the trees that are kept."""
    res = forecast_result(spark, sf)
    names = ("smape", "mape", "mae", "rmse")
    rows = [(b.level, n, *[float(b.metrics.get(m) or 0.0) for m in names], int(b.metrics.get("n") or 0), len(b.point.losses), b.point.n_trees)
            for model in (res.item_model, res.cluster_model) for n, b in _bundles(model)]
    return spark.createDataFrame(rows, "level string, campaign_week long, " + ", ".join(f"{m} double" for m in names) + ", n_test long, n_rounds long, n_trees long")


@register("feature_importance")
def feature_importance(spark, sf):
    """K6: top-10 features by importance per level and campaign week (a top-k report)."""
    from ..operators.models import feature_importance as fi
    res = forecast_result(spark, sf)
    rows = [(b.level, n, f, float(v)) for model in (res.item_model, res.cluster_model)
            for n, b in _bundles(model) for f, v in fi(b.point, b.features)]
    return spark.createDataFrame(rows, "level string, campaign_week long, feature string, importance double")


@register("single_model_forecast")
def single_model_forecast(spark, sf):
    """One pooled model per level, the option beside the week models."""
    inp = _inputs(spark, sf)
    res = run_forecast(inp.orders, inp.items, inp.campaigns, campaign_items(inp.orders, FORECAST_CAMPAIGN),
                       P.CAMPAIGN_START, P.FORECAST_DATE, P.HORIZON, single_model=True)
    i = res.item_predictions.select(F.lit("item").alias("level"), F.col("baseItemId").alias("id"), "campaign_week",
                                    "campaign_on", "prediction_kgl")
    c = res.cluster_predictions.select(F.lit("cluster").alias("level"), F.col("cluster1To1Id").alias("id"),
                                       "campaign_week", "campaign_on", "prediction_kgl")
    return finalize(i.unionByName(c))


# --- backtest (P17-P19, A13, K1) -----------------------------------------------------------

_BT: dict = {}


def backtest_result(spark, sf):
    from .backtest import run_backtest
    key = (spark.sparkContext.applicationId, sf)
    if key not in _BT:
        inp = _inputs(spark, sf)
        _BT[key] = run_backtest(inp.orders, inp.items, inp.campaigns, P.BACKTEST_YEAR)
    return _BT[key]


@register("backtest")
def backtest(spark, sf):
    """Per-item actual vs predicted vs baseline over all campaigns of a past year."""
    return finalize(backtest_result(spark, sf)[0])


@register("backtest_failures")
def backtest_failures(spark, sf):
    """Campaigns that couldn't be validated, with the reason."""
    return finalize(backtest_result(spark, sf)[1])


@register("backtest_summary")
def backtest_summary(spark, sf):
    """A13."""
    return finalize(R.backtest_summary(backtest_result(spark, sf)[0]))


@register("best_worst")
def best_worst(spark, sf):
    """K1: best and worst five items by SMAPE (a top-k report)."""
    return finalize(R.best_worst(backtest_result(spark, sf)[0]))


# --- walk-forward validation and search (P13, P14, S8) ------------------------------------

TUNING_TRIALS = 50   # search budget of each level


def _level_frames(spark, sf):
    """(level, weekly frame, written once) of both levels."""
    from .registry import _pre
    from .preprocess import materialize
    pre = _pre(spark, sf)
    return [("item", materialize(pre.item_weekly, "checkpoint")), ("cluster", materialize(pre.cluster_weekly, "checkpoint"))]


@register("walk_forward_scores")
def walk_forward_scores(spark, sf):
    """P13 with the default settings of each level: one row per (level, model week, fold)."""
    from .tune import walk_forward_cv
    rows = [(level, *r) for level, frame in _level_frames(spark, sf) for r in walk_forward_cv(frame, level)]
    return spark.createDataFrame(rows, "level string, model_week long, fold long, n_train long, n_val long, smape double")


@register("tuning_result")
def tuning_result(spark, sf):
    """P14 + S8: seeded random search at each level, best records written as JSON and read back."""
    from ..sources.io import scratch_path
    from .tune import random_search, save_best
    # one level after the other: side by side, both levels' plans meet in the driver's memory
    found = [random_search(spark, frame, level, TUNING_TRIALS) for level, frame in _level_frames(spark, sf)]
    trials = found[0].unionByName(found[1])
    path = scratch_path(spark, "best-params")
    save_best(trials, path)
    return spark.read.json(path)


# --- first-generation scenario forecast (P6, P7, J12, W16, A11) -------------------------

_SC: dict = {}


def scenario_result(spark, sf):
    from .scenario_job import run_scenarios
    key = (spark.sparkContext.applicationId, sf)
    if key not in _SC:
        inp = _inputs(spark, sf)
        _SC[key] = run_scenarios(inp.orders, inp.items, inp.campaigns, campaign_items(inp.orders, FORECAST_CAMPAIGN),
                                 P.CAMPAIGN_START, P.CAMPAIGN_END, P.FORECAST_DATE)
    return _SC[key]


@register("cluster_horizon_forecast")
def cluster_horizon_forecast(spark, sf):
    """Per-horizon cluster models: held-out MAE, SMAPE, volume-weighted SMAPE and RMSLE
    after the cutoff."""
    rows = [(int(h), *[float(v or 0.0) for v in m], int(n or 0)) for h, *m, n in scenario_result(spark, sf)[0]]
    return spark.createDataFrame(rows, "horizon long, mae double, smape double, weighted_smape double, rmsle double, n_test long")


@register("topdown_combine")
def topdown_combine(spark, sf):
    """Predicted item share x predicted cluster total per item, horizon, scenario."""
    return finalize(scenario_result(spark, sf)[1].select("itemId", "cluster1To1Id", "scenario", "horizon",
                                                         "pred_share", "pred_cluster", "predicted_quantity_kg"))


@register("scenario_forecast")
def scenario_forecast(spark, sf):
    """P7 + W16: renormalised share forecasts per scenario, feature and target week."""
    return finalize(scenario_result(spark, sf)[1])


@register("scenario_comparison")
def scenario_comparison_q(spark, sf):
    """Focus items' forecasts with and without the campaign, absolute and % lift."""
    return finalize(scenario_result(spark, sf)[2])


@register("recursive_forecast")
def recursive_forecast(spark, sf):
    """P15 + P16: three unrolled steps for all target items together with their clusters,
    campaign and no-campaign predictions, floored at 0, and the global model's."""
    from .recursive_job import run_recursive
    inp = _inputs(spark, sf)
    out = run_recursive(inp.orders, inp.items, inp.campaigns, campaign_items(inp.orders, FORECAST_CAMPAIGN),
                        P.CAMPAIGN_START, P.CAMPAIGN_END, P.FORECAST_DATE)
    return finalize(out)
