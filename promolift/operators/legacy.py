"""First- and second-generation frames.

The first generation's cluster features run over the cluster's item-week *rows*
(total order: week, item).  A single window partitioned by cluster would put a hot
cluster into one task, so they are computed skew-free:

* each row gets its global index in the cluster = rows of earlier weeks (a prefix
  over the per-(cluster, week) counts, one row per week) + its position in the week
  (a window over one (cluster, week), bounded by the cluster's items);
* lag 1 and the 4-row rolling mean read the predecessors by an equi-join on
  (cluster, index - k), k = 1..4, which hashes evenly whatever the cluster size;
* running counters are prefix sums in the same two phases.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import lit_date
from ..functions.units import legacy_weight
from .universe import dedupe, is_empty
from .weekly import legacy_weekly_orders


def legacy_items(items: DataFrame) -> DataFrame:
    """G1 item table: one row per item id (newest version), empty cluster -> own id,
    weight by the older rule (U1b)."""
    it = dedupe(items, ["itemId"], [F.col("itemSkey").desc()])
    return it.select("itemId", F.when(is_empty(F.col("cluster1To1Id")), F.col("itemId"))
                     .otherwise(F.col("cluster1To1Id")).alias("cluster1To1Id"),
                     legacy_weight().alias("weight"))


def _row_index(df: DataFrame, key: str) -> DataFrame:
    """Adds ``_pos`` (0-based position in (key, week) by item) and ``_idx`` (0-based
    position in the key over (week, item))."""
    w = Window.partitionBy(key, "orderDate").orderBy("itemId")
    df = df.withColumn("_pos", F.row_number().over(w) - 1)
    cnt = df.groupBy(key, "orderDate").agg(F.count("*").alias("_cnt"))
    pw = Window.partitionBy(key).orderBy("orderDate").rowsBetween(Window.unboundedPreceding, -1)
    cnt = cnt.withColumn("_off", F.coalesce(F.sum("_cnt").over(pw), F.lit(0)))
    c = cnt.select(F.col(key).alias("_ck"), F.col("orderDate").alias("_cd"), "_off")
    j = df.join(c, df[key].eqNullSafe(c["_ck"]) & (df["orderDate"] == c["_cd"]))
    return j.withColumn("_idx", F.col("_off") + F.col("_pos")).drop("_off", "_ck", "_cd")


def row_lags(df: DataFrame, key: str, value: str, lag_col: str, roll_col: str, k: int = 4) -> DataFrame:
    """Previous row's value (0 when none) and the mean of the previous ``k`` rows
    (null when none) within ``key`` over (week, item) order."""
    d = _row_index(df, key)
    prev = d.select(F.col(key).alias("_k"), F.col("_idx").alias("_pidx"), F.col(value).alias("_pv"))
    asks = d.select(key, "_idx", F.explode(F.sequence(F.lit(1), F.lit(k))).alias("_lag"))
    got = (asks.join(prev, asks[key].eqNullSafe(prev["_k"]) & ((asks["_idx"] - asks["_lag"]) == prev["_pidx"]))
           .groupBy(key, "_idx").agg(F.max(F.when(F.col("_lag") == 1, F.col("_pv"))).alias(lag_col),
                                     F.avg("_pv").alias(roll_col)))
    got = got.select(F.col(key).alias("_gk"), F.col("_idx").alias("_gi"), lag_col, roll_col)
    out = d.join(got, d[key].eqNullSafe(got["_gk"]) & (d["_idx"] == got["_gi"]), "left").drop("_gk", "_gi")
    return out.withColumn(lag_col, F.coalesce(F.col(lag_col), F.lit(0.0))).drop("_pos", "_idx")


def running_counters(df: DataFrame, key: str, flag: str = "is_campaign_week") -> DataFrame:
    """weeks_since_campaign = running count of rows without the flag, and
    campaigns_ytd = running sum of the flag, both including the current row."""
    not_on = (F.col(flag) != 1).cast("long")
    wk = df.groupBy(key, "orderDate").agg(F.sum(not_on).alias("_a"), F.sum(F.col(flag).cast("long")).alias("_b"))
    pw = Window.partitionBy(key).orderBy("orderDate").rowsBetween(Window.unboundedPreceding, -1)
    wk = wk.select(key, "orderDate", F.coalesce(F.sum("_a").over(pw), F.lit(0)).alias("_oa"),
                   F.coalesce(F.sum("_b").over(pw), F.lit(0)).alias("_ob"))
    inw = Window.partitionBy(key, "orderDate").orderBy("itemId").rowsBetween(Window.unboundedPreceding, 0)
    d = df.withColumn("_ra", F.sum(not_on).over(inw)).withColumn("_rb", F.sum(F.col(flag).cast("long")).over(inw))
    wk = wk.withColumnRenamed(key, "_wk").withColumnRenamed("orderDate", "_wd")
    d = d.join(wk, d[key].eqNullSafe(wk["_wk"]) & (d["orderDate"] == wk["_wd"])).drop("_wk", "_wd")
    return (d.withColumn("weeks_since_campaign", F.col("_oa") + F.col("_ra"))
            .withColumn("campaigns_ytd", F.col("_ob") + F.col("_rb"))
            .drop("_oa", "_ob", "_ra", "_rb"))


def legacy_processed(orders: DataFrame, items: DataFrame, campaigns: DataFrame, as_of=None) -> DataFrame:
    """The first generation's processed order table (one row per item id and
    Monday week): quantities in kg/L, campaign flag on the Monday-floored date (Q25),
    cluster lag / rolling over rows (W6), counters (W7), week / month / year."""
    from .campaigns import campaign_flag_daily, item_campaign_calendar
    o = orders if as_of is None else orders.where(F.col("orderDate") <= lit_date(as_of))
    weekly = legacy_weekly_orders(o)
    cal = item_campaign_calendar(weekly, campaigns)
    it = legacy_items(items)
    d = weekly.join(it, "itemId", "left").withColumn("salesQuantityKgL", F.col("salesQuantity") * F.col("weight"))
    d = campaign_flag_daily(d.drop("salesQuantity", "weight"), cal)
    d = row_lags(d, "cluster1To1Id", "salesQuantityKgL", "cluster_sales_lag_1", "cluster_sales_rolling4w")
    d = running_counters(d, "cluster1To1Id")
    return d.select("orderDate", "itemId", "cluster1To1Id", "salesCampignId", "salesQuantityKgL",
                    "is_campaign_week", "cluster_sales_lag_1", "cluster_sales_rolling4w",
                    "weeks_since_campaign", "campaigns_ytd", F.weekofyear("orderDate").alias("week"),
                    F.month("orderDate").alias("month"), F.year("orderDate").alias("year"))


def legacy_cluster_frame(processed: DataFrame) -> DataFrame:
    """(week, cluster) roll-up of the first-generation frame."""
    return processed.groupBy("orderDate", "cluster1To1Id").agg(
        F.sum("salesQuantityKgL").alias("cluster_sales_kg"), F.max("is_campaign_week").alias("is_campaign_week"),
        F.avg("cluster_sales_lag_1").alias("cluster_sales_lag_1"),
        F.avg("cluster_sales_rolling4w").alias("cluster_sales_rolling4w"),
        F.avg("weeks_since_campaign").alias("weeks_since_campaign"), F.max("campaigns_ytd").alias("campaigns_ytd"),
        F.first("month").alias("month"), F.first("week").alias("week"), F.first("year").alias("year"))


def multi_level_weekly(processed: DataFrame) -> DataFrame:
    """A10: item, cluster and global weekly frames in one aggregate over three grouping sets
    (sum sales, max flag, min weeks_since, max ytd), then lag 1 and the 4-week rolling
    mean of the previous weeks per level key (one row per week per key)."""
    keys = ["orderDate", "cluster1To1Id", "itemId"]
    g = processed.groupingSets([keys, keys[:2], keys[:1]], *keys).agg(
        F.sum("salesQuantityKgL").alias("salesQuantityKgL"), F.max("is_campaign_week").alias("is_campaign_week"),
        F.min("weeks_since_campaign").alias("weeks_since_campaign"), F.max("campaigns_ytd").alias("campaigns_ytd"),
        F.grouping_id(*keys).alias("_gid"))
    # grouping ids: 0 = (week, cluster, item), 1 = (week, cluster), 3 = (week)
    level = F.when(F.col("_gid") == 0, "item").when(F.col("_gid") == 1, "cluster").otherwise("global")
    key = F.when(F.col("_gid") == 0, F.col("itemId")).when(F.col("_gid") == 1, F.col("cluster1To1Id")) \
        .otherwise(F.lit("all"))
    g = g.select(level.alias("level"), key.alias("key"), "orderDate", "salesQuantityKgL", "is_campaign_week",
                 "weeks_since_campaign", "campaigns_ytd")
    w = Window.partitionBy("level", "key").orderBy("orderDate")
    return (g.withColumn("sales_lag_1", F.coalesce(F.lag("salesQuantityKgL", 1).over(w), F.lit(0.0)))
            .withColumn("sales_lag_2", F.lag("salesQuantityKgL", 2).over(w))
            .withColumn("sales_rolling4w", F.coalesce(F.avg("salesQuantityKgL").over(w.rowsBetween(-4, -1)),
                                                       F.lit(0.0))))
