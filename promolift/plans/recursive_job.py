"""Second-generation recursive forecast (P15, P16, T3, T8, P8 simple models).

One pooled model per level (item, cluster, global) replaces the model-per-item of the
modelled code; the three grow in one pass.  The campaign weeks are unrolled as scoring
steps over a DataFrame of *all* target items.  A target's state holds the last values of
the item and of its cluster together: each step reads both levels' lags from it, scores
item and cluster with the campaign on and off, and appends the (unfloored) campaign
predictions of both, so that the cluster's new value is a lag of its item in the next
step.  Items with under ten weeks get no forecast.  Items with fewer than three campaign
weeks take their cluster's uplift on their own forecast without the campaign.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import as_date, lit_date, month_features, time_features
from ..operators.boosting import Boosting, Fit, fit_many
from ..operators.legacy import legacy_processed, multi_level_weekly
from ..operators.models import training_rows
from ..operators.scenario import MIN_CLUSTER_CAMPAIGN_WEEKS, MIN_ITEM_CAMPAIGN_WEEKS
from ..operators.universe import base_item_id, valid_orders
from .preprocess import materialize

CYCLES = ["week_sin", "week_cos", "month_sin", "month_cos"]
FEATURES = [*CYCLES, "is_campaign_week", "item_sales_lag_1", "item_sales_lag_2", "item_sales_rolling_4w",
            "cluster_sales_lag_1", "cluster_sales_rolling4w", "weeks_since_campaign", "campaigns_ytd"]
SIMPLE_PARAMS = Boosting(rounds=100, patience=None, step=0.05, leaves=31, depth=4, least_rows=10, columns=0.8, l1=0.5, l2=0.5)   # fixed values
STEPS = 3
MIN_WEEKS = 10   # fixed: fewer weeks of an item: no forecast
HISTORY = 4


def cycles(d) -> list:
    """The week and month cycles."""
    week, month = time_features(d)[2:], month_features(d)[3:]
    return [*[c.alias(n) for c, n in zip(week, CYCLES[:2])], *month]


def prediction_weeks(campaign_start, campaign_end) -> list[_dt.date]:
    """Up to three Monday-aligned weeks from the campaign start, within its end."""
    s = as_date(campaign_start)
    first = s - _dt.timedelta(days=s.weekday())
    return [first + _dt.timedelta(weeks=k) for k in range(STEPS)
            if first + _dt.timedelta(weeks=k) <= as_date(campaign_end)]


def training_levels(ml: DataFrame, g1: DataFrame) -> dict[str, DataFrame]:
    """The three levels' frames with equal feature columns.  Item rows carry their cluster's
    lags of the week; the other levels have none of an item (0), and the global level's own
    lags stand as the cluster's."""
    ml = ml.select("*", *cycles(F.col("orderDate"))).fillna(0.0, subset=["sales_lag_2"])
    zero = F.lit(0.0)
    clusters = ml.where(F.col("level") == "cluster").select(F.col("key").alias("cluster1To1Id"), "orderDate", F.col("sales_lag_1").alias("cluster_sales_lag_1"),
                                                            F.col("sales_rolling4w").alias("cluster_sales_rolling4w"))
    of_item = g1.select(F.col("itemId").alias("key"), "orderDate", "cluster1To1Id").distinct()
    item = ml.where(F.col("level") == "item").join(of_item, ["key", "orderDate"]).join(clusters, ["cluster1To1Id", "orderDate"])
    item = item.select("key", "orderDate", "cluster1To1Id", "salesQuantityKgL", "is_campaign_week", "weeks_since_campaign", "campaigns_ytd", *CYCLES,
                       F.col("sales_lag_1").alias("item_sales_lag_1"), F.col("sales_lag_2").alias("item_sales_lag_2"), F.col("sales_rolling4w").alias("item_sales_rolling_4w"),
                       "cluster_sales_lag_1", "cluster_sales_rolling4w")

    def upper(level):
        return ml.where(F.col("level") == level).select(
            "key", "orderDate", "salesQuantityKgL", "is_campaign_week", "weeks_since_campaign", "campaigns_ytd", *CYCLES,
            *[zero.alias(c) for c in ("item_sales_lag_1", "item_sales_lag_2", "item_sales_rolling_4w")],
            F.col("sales_lag_1").alias("cluster_sales_lag_1"), F.col("sales_rolling4w").alias("cluster_sales_rolling4w"))

    return {"item": item, "cluster": upper("cluster"), "global": upper("global")}


def fit_levels(levels: dict[str, DataFrame]) -> dict:
    rows = None
    for level, d in levels.items():
        # rows without a kg/L value (an item id with no usable weight) cannot be labels
        d = d.where(F.col("salesQuantityKgL").isNotNull()).withColumn("split", F.lit("train")).withColumn("weight", F.lit(1.0))
        own = training_rows(d, FEATURES, level, "salesQuantityKgL")
        rows = own if rows is None else rows.unionByName(own)
    return fit_many(materialize(rows, "checkpoint"), [Fit(x, x, SIMPLE_PARAMS) for x in levels], dict.fromkeys(levels, FEATURES))


def _last_values(d: DataFrame, key: str, name: str) -> DataFrame:
    """Each key's last values in order, and the number of its campaign weeks."""
    w = Window.partitionBy(key).orderBy(F.col("orderDate").desc())
    last = d.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= HISTORY)
    hist = last.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("orderDate", "salesQuantityKgL"))),
                                             lambda s: F.coalesce(s["salesQuantityKgL"], F.lit(0.0))).alias(f"{name}_hist"))
    weeks = d.groupBy(key).agg(F.count_if(F.col("is_campaign_week") == 1).alias(f"{name}_campaign_weeks"), F.count("*").alias(f"{name}_weeks"))
    return hist.join(weeks, key)


def initial_state(levels: dict[str, DataFrame], focus: DataFrame) -> DataFrame:
    """One row a target item with at least ten weeks: the last four values of the item and of
    its cluster, campaign weeks of both, and the item's counters."""
    ids = focus.select(F.col(focus.columns[0]).alias("_b")).distinct()
    item = levels["item"].join(ids, base_item_id(F.col("key")) == F.col("_b"), "left_semi")
    counters = item.groupBy("key").agg(F.max("campaigns_ytd").alias("base_ytd"), F.max_by("weeks_since_campaign", "orderDate").alias("last_wsc"),
                                       F.max_by("cluster1To1Id", "orderDate").alias("cluster1To1Id"))
    items = _last_values(item, "key", "item").join(counters, "key").where(F.col("item_weeks") >= MIN_WEEKS)
    clusters = _last_values(levels["cluster"].withColumnRenamed("key", "cluster1To1Id"), "cluster1To1Id", "cluster")
    return items.join(clusters, "cluster1To1Id").select(
        F.col("key").alias("itemId"), "cluster1To1Id", "item_hist", "cluster_hist", "item_campaign_weeks", "cluster_campaign_weeks",
        F.coalesce("base_ytd", F.lit(0)).alias("base_ytd"), F.coalesce("last_wsc", F.lit(0)).alias("last_wsc"))


def lags(state: DataFrame) -> list:
    """The lag features of a state's histories."""
    i, c = F.col("item_hist"), F.col("cluster_hist")
    at = lambda h, k: F.when(F.size(h) >= k, F.element_at(h, F.lit(-k))).otherwise(F.lit(0.0))

    def mean(h):
        last = F.slice(h, F.greatest(F.size(h) - (HISTORY - 1), F.lit(1)), HISTORY)
        return F.aggregate(last, F.lit(0.0), lambda a, x: a + x) / F.greatest(F.size(last), F.lit(1))

    return [at(i, 1).alias("item_sales_lag_1"), at(i, 2).alias("item_sales_lag_2"), mean(i).alias("item_sales_rolling_4w"),
            at(c, 1).alias("cluster_sales_lag_1"), mean(c).alias("cluster_sales_rolling4w")]


def advance(state: DataFrame, weeks: list[_dt.date], models: dict, keep=lambda d: materialize(d, "checkpoint")) -> tuple[DataFrame, DataFrame]:
    """The scoring steps: (forecasts, final state).  Forecasts: itemId, cluster1To1Id, step,
    week_start, campaign_on, item, cluster (floored at 0)."""
    names = state.columns
    out = None
    for k, wk in enumerate(weeks):
        sc = state.select("*", *lags(state), *cycles(F.lit(wk)), F.explode(F.array(F.lit(True), F.lit(False))).alias("campaign_on"))
        sc = (sc.withColumn("is_campaign_week", F.col("campaign_on").cast("int"))
              .withColumn("weeks_since_campaign", F.when(F.col("campaign_on"), F.lit(0)).otherwise(F.col("last_wsc") + k + 1).cast("double"))
              .withColumn("campaigns_ytd", F.when(F.col("campaign_on"), F.col("base_ytd") + k + 1).otherwise(F.col("base_ytd")).cast("double")))
        for level in ("item", "cluster"):
            sc = models[level].transform(sc).withColumnRenamed("prediction", f"{level}_new")
        sc = keep(sc.select(*names, "campaign_on", "item_new", "cluster_new"))
        floored = [F.greatest(F.col(f"{x}_new"), F.lit(0.0)).alias(x) for x in ("item", "cluster")]
        step = sc.select("itemId", "cluster1To1Id", F.lit(k + 1).alias("step"), F.lit(wk).alias("week_start"), "campaign_on", *floored)
        out = step if out is None else out.unionByName(step)
        grown = {f"{x}_hist": F.concat(F.col(f"{x}_hist"), F.array(F.col(f"{x}_new"))) for x in ("item", "cluster")}
        state = sc.where("campaign_on").withColumns(grown).select(*names)
    return out, state


def with_fallback(forecasts: DataFrame, state: DataFrame) -> DataFrame:
    """Items with fewer than three campaign weeks: the forecast without the campaign times
    the cluster's ratio of that week (1 where the base isn't positive).  ``effect_level``:
    item, cluster (at least ten cluster campaign weeks) or global, which takes the
    cluster's ratio too."""
    few = F.col("item_campaign_weeks") < MIN_ITEM_CAMPAIGN_WEEKS
    level = F.when(~few, "item").when(F.col("cluster_campaign_weeks") >= MIN_CLUSTER_CAMPAIGN_WEEKS, "cluster").otherwise("global")
    pair = forecasts.groupBy("itemId", "step").agg(*[F.max(F.when(F.col("campaign_on") == on, F.col(x))).alias(f"_{x}_{n}")
                                                     for x in ("item", "cluster") for on, n in ((True, "on"), (False, "off"))])
    d = forecasts.join(pair, ["itemId", "step"]).join(state.select("itemId", few.alias("_few"), level.alias("effect_level")), "itemId")
    ratio = F.when(F.col("_cluster_off") > 0, F.col("_cluster_on") / F.col("_cluster_off")).otherwise(F.lit(1.0))
    item = F.when(F.col("_few") & F.col("campaign_on"), F.col("_item_off") * ratio).otherwise(F.col("item"))
    return d.select("itemId", "cluster1To1Id", "step", "week_start", "campaign_on", item.alias("item"), "cluster", "effect_level")


def global_forecast(state: DataFrame, weeks: list[_dt.date], model) -> DataFrame:
    """The global model on the weeks, all from the final state: itemId, step, campaign_on, global."""
    grid = F.explode(F.array(*[F.struct(F.lit(k + 1).alias("step"), F.lit(w).alias("week_start"), F.lit(on).alias("campaign_on"))
                               for k, w in enumerate(weeks) for on in (True, False)]))
    sc = state.select("*", *lags(state), grid.alias("_g")).select("*", "_g.*").drop("_g")
    sc = (sc.select("*", *cycles(F.col("week_start"))).withColumn("is_campaign_week", F.col("campaign_on").cast("int"))
          .withColumn("weeks_since_campaign", F.when(F.col("campaign_on"), F.lit(0.0)).otherwise(F.lit(1.0)))
          .withColumn("campaigns_ytd", (F.col("base_ytd") + 1).cast("double")))
    return model.transform(sc.select("itemId", "step", "campaign_on", *FEATURES)).select("itemId", "step", "campaign_on", F.greatest("prediction", F.lit(0.0)).alias("global"))


def run_recursive(orders: DataFrame, items: DataFrame, campaigns: DataFrame, focus: DataFrame,
                  campaign_start, campaign_end, forecast_date) -> DataFrame:
    """Per target item, step and scenario: item, cluster and global forecast (kg/L)."""
    g1 = materialize(legacy_processed(valid_orders(orders), items, campaigns).where(F.col("orderDate") < lit_date(forecast_date)), "checkpoint")
    ml = materialize(multi_level_weekly(g1), "checkpoint")
    levels = {k: materialize(d, "checkpoint") for k, d in training_levels(ml, g1).items()}
    models = fit_levels(levels)
    weeks = prediction_weeks(campaign_start, campaign_end)
    state = materialize(initial_state(levels, focus), "checkpoint")
    forecasts, last = advance(state, weeks, models)
    return with_fallback(forecasts, state).join(global_forecast(last, weeks, models["global"]), ["itemId", "step", "campaign_on"])
