"""Older-generation operators: item shares, scenarios, uplift fallback, history
summaries (W8, W16, C7, F9, P16, A15, A16).

Per-(cluster, week) totals are aggregates joined back (partial aggregation), not
windows, so a large cluster does not land in one window partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .universe import on_campaign

SHARE_FLOOR = 1e-6           # fixed: denominator floor of a share
MIN_ITEM_CAMPAIGN_WEEKS = 3  # fixed: fewer item campaign weeks -> uplift fallback
MIN_CLUSTER_CAMPAIGN_WEEKS = 10


def item_share_frame(weekly: DataFrame, value: str = "salesQuantityKgL") -> DataFrame:
    """Share of the (cluster, week) total (floor 1e-6, negatives clipped to 0),
    whether the cluster has a campaign that week while this item has none, and the
    previous week's sales and share per item (0 when none)."""
    w = weekly.withColumn("_v", F.greatest(F.col(value), F.lit(0.0))) \
              .withColumn("_on", on_campaign().cast("int"))
    tot = w.groupBy("cluster1To1Id", "week_start").agg(F.sum("_v").alias("_tot"), F.sum("_on").alias("_n_on"))
    j = w.join(tot, ["cluster1To1Id", "week_start"])
    share = F.col("_v") / F.greatest(F.col("_tot"), F.lit(SHARE_FLOOR))
    other = ((F.col("_n_on") > 0) & (F.col("_on") == 0)).cast("int")
    iw = Window.partitionBy("baseItemId").orderBy("week_start")
    out = j.select("baseItemId", "cluster1To1Id", "week_start", F.col("_v").alias("item_sales"),
                   share.alias("item_share"), other.alias("other_campaign_in_cluster"))
    return (out.withColumn("item_sales_lag_1", F.coalesce(F.lag("item_sales", 1).over(iw), F.lit(0.0)))
            .withColumn("item_share_lag_1", F.coalesce(F.lag("item_share", 1).over(iw), F.lit(0.0))))


def renormalize_shares(pred: DataFrame, share_col: str = "pred_share") -> DataFrame:
    """Rescale predicted shares only where they sum to more than 1 in a
    (cluster, week)."""
    tot = pred.groupBy("cluster1To1Id", "week_start").agg(F.sum(share_col).alias("_s"))
    j = pred.join(tot, ["cluster1To1Id", "week_start"])
    return j.withColumn(share_col, F.when(F.col("_s") > 1, F.col(share_col) / F.col("_s"))
                        .otherwise(F.col(share_col))).drop("_s")


def what_if_scenarios(orders: DataFrame, focus: DataFrame, start, end) -> DataFrame:
    """Every order line twice -- scenario 0 with the focus items' campaign flag
    forced off and scenario 1 forced on inside [start, end]; other lines keep their
    own flag.  Generated with explode, not a join."""
    from ..functions.dates import lit_date
    f = focus.select(F.col(focus.columns[0]).alias("baseItemId")).distinct().withColumn("_focus", F.lit(True))
    o = orders.join(f, "baseItemId", "left")
    inside = F.coalesce(F.col("_focus"), F.lit(False)) & \
        F.col("orderDate").between(lit_date(start), lit_date(end))
    o = o.select("*", F.explode(F.array(F.lit(0), F.lit(1))).alias("scenario"))
    own = F.col("salesCampignId").isNotNull().cast("int")
    return o.withColumn("is_campaign_week", F.when(inside, F.col("scenario")).otherwise(own)).drop("_focus")


def campaign_item_rows(weekly: DataFrame, item_weeks: DataFrame) -> DataFrame:
    """weekly rows flagged by a (week, item) campaign table, flag = 1 kept."""
    flags = item_weeks.select("baseItemId", "week_start", F.lit(1).alias("_flag")).distinct()
    return weekly.join(flags, ["baseItemId", "week_start"], "left").where(F.col("_flag") == 1).drop("_flag")


def uplift_fallback(item_weekly: DataFrame, cluster_weekly: DataFrame) -> DataFrame:
    """Items with fewer than 3 campaign weeks get baseline x (cluster campaign
    mean / cluster baseline mean) (ratio 1.0 when the base is not positive); the level
    label is 'item', else 'cluster' with >= 10 cluster campaign weeks, else 'global'
    (which, as in the modelled code, still uses the cluster ratio)."""
    on = on_campaign()
    it = item_weekly.groupBy("baseItemId", "cluster1To1Id").agg(
        F.sum(on.cast("int")).alias("item_campaign_weeks"),
        F.avg(F.when(F.col("campaign_week_0") == 1, F.col("salesQuantityKgL"))).alias("item_baseline"))
    c_on = (F.col("campaign_week_1") + F.col("campaign_week_2") + F.col("campaign_week_3")) > 0
    cl = cluster_weekly.groupBy("cluster1To1Id").agg(
        F.sum(c_on.cast("int")).alias("cluster_campaign_weeks"),
        F.avg(F.when(c_on, F.col("salesQuantityKgL"))).alias("_c"),
        F.avg(F.when(F.col("campaign_week_0") == 1, F.col("salesQuantityKgL"))).alias("_b"))
    ratio = F.when(F.col("_b") > 0, F.coalesce(F.col("_c"), F.col("_b")) / F.col("_b")).otherwise(F.lit(1.0))
    j = it.join(cl, "cluster1To1Id", "left").withColumn("uplift_ratio", ratio)
    level = (F.when(F.col("item_campaign_weeks") >= MIN_ITEM_CAMPAIGN_WEEKS, "item")
             .when(F.coalesce(F.col("cluster_campaign_weeks"), F.lit(0)) >= MIN_CLUSTER_CAMPAIGN_WEEKS, "cluster")
             .otherwise("global"))
    fb = F.when(F.col("item_campaign_weeks") < MIN_ITEM_CAMPAIGN_WEEKS,
                F.coalesce(F.col("item_baseline"), F.lit(0.0)) * F.col("uplift_ratio"))
    return j.select("baseItemId", "cluster1To1Id", "item_campaign_weeks", "cluster_campaign_weeks",
                    "item_baseline", "uplift_ratio", level.alias("level"), fb.alias("fallback_campaign_kgl"))


def recent_history(weekly: DataFrame, idc: str, value: str, n: int = 12) -> DataFrame:
    """Mean, median and max of each id's last ``n`` weekly rows, and whether
    any week holds several rows."""
    w = Window.partitionBy(idc).orderBy(F.col("week_start").desc())
    last = weekly.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n)
    return last.groupBy(idc).agg(F.avg(value).alias("recent_mean"), F.median(value).alias("recent_median"),
                                 F.max(value).alias("recent_max"), F.count("*").alias("recent_weeks"),
                                 (F.count("*") > F.countDistinct("week_start")).alias("several_rows_per_week"))


def recent_cluster_average(cluster_weekly: DataFrame, weeks: int = 12) -> DataFrame:
    """A15, cluster half: mean weekly sales of a cluster from ``weeks`` weeks before its own
    last week on."""
    last = cluster_weekly.groupBy("cluster1To1Id").agg(F.max("week_start").alias("_last"))
    d = cluster_weekly.join(last, "cluster1To1Id").where(F.col("week_start") >= F.date_sub("_last", 7 * weeks))
    d = d.groupBy("cluster1To1Id", "week_start").agg(F.sum("salesQuantityKgL").alias("_s"))
    return d.groupBy("cluster1To1Id").agg(F.avg("_s").alias("recent_average"), F.count("*").alias("recent_weeks"))


def campaign_intensity(samples: DataFrame) -> DataFrame:
    """A16, cluster half: per model week the rows, those with the campaign and their mean
    intensity.  ``samples`` carries ``model_week`` and ``intensity``."""
    on = F.col("intensity") > 0
    return samples.groupBy("model_week").agg(F.count("*").alias("n_rows"), F.count_if(on).alias("n_campaign"), F.avg(F.when(on, F.col("intensity"))).alias("mean_intensity"))


def target_profile(weekly: DataFrame, idc: str, value: str = "salesQuantityKgL_log") -> DataFrame:
    """A12 per target: rows, campaign rows, weeks without sales, first and last week, range."""
    return weekly.groupBy(idc).agg(
        F.count("*").alias("n_rows"), F.count_if(on_campaign()).alias("campaign_rows"), F.count_if(F.col(value) == 0).alias("zero_weeks"),
        F.min("week_start").alias("first_week"), F.max("week_start").alias("last_week"), F.min(value).alias("min_value"), F.max(value).alias("max_value"))


def train_balance_stats(samples: DataFrame, target: str = "salesQuantityKgL_log") -> DataFrame:
    """Per campaign week, campaign vs baseline means, their ratio and counts.
    ``samples`` carries ``model_week`` and ``is_campaign``."""
    a = samples.groupBy("model_week").agg(
        F.avg(F.when(F.col("is_campaign"), F.col(target))).alias("campaign_mean"),
        F.avg(F.when(~F.col("is_campaign"), F.col(target))).alias("baseline_mean"),
        F.sum(F.col("is_campaign").cast("int")).alias("n_campaign"),
        F.sum((~F.col("is_campaign")).cast("int")).alias("n_baseline"))
    return a.withColumn("ratio", F.try_divide(F.col("campaign_mean"), F.col("baseline_mean")))
