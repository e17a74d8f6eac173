"""Weekly roll-ups.

Plan shape: order lines are aggregated to (id, week) with map-side partial
aggregation, so a hot item or cluster collapses to one row per map task and week
before the shuffle.  After that every id holds at most one row per calendar week,
so windows partitioned by id are bounded by the number of weeks, whatever the skew
of the raw orders.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import week_start
from ..functions.units import to_kgl
from ..schemas import FLAG_COLS
from .universe import base_item_id, on_campaign

GRID_ROWS = 2_000_000   # rows of the gap-filled grid that one task makes, about


def orders_kgl(orders: DataFrame, master: DataFrame) -> DataFrame:
    """J4/J5/J6 + U2: base id, cluster and unit factor onto order lines, kg/L sales.

    ``master`` has one row per base item; the join is left to AQE, which broadcasts
    it when its measured size is under the threshold and sort-merges otherwise.  No line is
    dropped: the first one of an item without a unit in the master fails the job."""
    m = master.select("baseItemId", "cluster1To1Id", "itemUnitConversion")
    o = orders.withColumn("baseItemId", base_item_id(F.col("itemId")))
    lost = F.raise_error(F.concat(F.lit("order line of an item without a unit in the master: "), F.coalesce("itemId", F.lit("null")))).cast("double")
    return (o.join(m, "baseItemId", "left").withColumn("itemUnitConversion", F.coalesce("itemUnitConversion", lost))
            .withColumn("salesQuantityKgL", to_kgl(F.col("salesQuantity"), F.col("itemUnitConversion"))))


def weekly_item_lines(tagged: DataFrame, master: DataFrame) -> DataFrame:
    """A1 from campaign-tagged, week-aligned order lines without units: one row per (base
    item, week) as ``weekly_item_sales`` has them, with the master joined behind the roll-up.
    Rows of items that the master lacks have a null ``itemUnitConversion``."""
    w = (tagged.withColumn("baseItemId", base_item_id(F.col("itemId"))).where(F.col("baseItemId").isNotNull())
         .groupBy("baseItemId", "week_start")
         .agg(F.sum(F.greatest(F.col("salesQuantity").cast("double"), F.lit(0.0))).alias("_q"),
              *[F.max(c).alias(c) for c in FLAG_COLS],
              F.min("campaignId").alias("campaignId"), F.count("*").alias("n_lines")))
    m = master.select("baseItemId", "cluster1To1Id", "itemUnitConversion")
    return w.join(m, "baseItemId", "left").select(
        "baseItemId", "week_start", (F.col("_q") * F.col("itemUnitConversion")).alias("salesQuantityKgL"),
        *FLAG_COLS, "campaignId", "cluster1To1Id", "n_lines", "itemUnitConversion", F.col("_q").alias("salesQuantity"))


def rejected_lines(weekly: DataFrame) -> DataFrame:
    """What ``weekly_item_lines`` rows can't be mapped: per item without a unit in the
    master its weeks, order lines and quantity."""
    return weekly.where(F.col("itemUnitConversion").isNull()).groupBy("baseItemId").agg(
        F.count("*").alias("n_weeks"), F.sum("n_lines").alias("n_lines"), F.sum("salesQuantity").alias("quantity"))


def split_mapped(weekly: DataFrame, materialize_fn, most_rejected: float = 0.0, shown: int = 5) -> tuple[DataFrame, DataFrame]:
    """The rows of ``weekly_item_lines``, written once, as (mapped rows, rejects by
    item).  Fails when over ``most_rejected`` of all order lines are rejects."""
    w = materialize_fn(weekly)
    lost = F.col("itemUnitConversion").isNull()
    seen = w.agg(F.coalesce(F.sum("n_lines"), F.lit(0)).alias("n"), F.coalesce(F.sum(F.when(lost, F.col("n_lines"))), F.lit(0)).alias("lost")).first()
    rejects = rejected_lines(w)
    if seen["lost"] > most_rejected * seen["n"]:
        some = [r[0] for r in rejects.select("baseItemId").orderBy("baseItemId").limit(shown).collect()]
        raise ValueError(f"{seen['lost']} of {seen['n']} order lines are of items without a master row, among them: {some}")
    return w.where(~lost).drop("itemUnitConversion", "salesQuantity"), rejects


def require_mapped(weekly: DataFrame, materialize_fn) -> DataFrame:
    """J4/J5 without tolerance: the mapped rows; any reject fails the job."""
    return split_mapped(weekly, materialize_fn)[0]


def with_week(orders: DataFrame, anchor_weekday: int = 0, date_col: str = "deliveryDate") -> DataFrame:
    """Week start aligned to the campaign weekday (Monday = 0 by default)."""
    return orders.withColumn("week_start", week_start(F.col(date_col), anchor_weekday))


def weekly_item_sales(tagged: DataFrame) -> DataFrame:
    """A1: one row per (base item, week): kg/L sum, max of each flag, the smallest
    campaign id seen (deterministic 'first'), the item's cluster, order-line count."""
    return (tagged.where(F.col("baseItemId").isNotNull())
            .groupBy("baseItemId", "week_start")
            .agg(F.sum("salesQuantityKgL").alias("salesQuantityKgL"),
                 *[F.max(c).alias(c) for c in FLAG_COLS],
                 F.min("campaignId").alias("campaignId"),
                 F.min("cluster1To1Id").alias("cluster1To1Id"),
                 F.count("*").alias("n_lines")))


def weekly_cluster_sales(item_weekly: DataFrame, intensity: str = "fractional") -> DataFrame:
    """A2: (cluster, week) roll-up of the item-week rows.

    Each flag becomes the share of the cluster's items in that week that carry it
    (``intensity='fractional'``); ``'truncate'`` keeps only full intensity (1.0), as
    an integer cast of the fraction would.  The modal item is the one with most
    order lines, lowest id on ties."""
    flags = []
    for c in FLAG_COLS:
        v = F.avg(F.col(c).cast("double"))
        if intensity == "truncate":
            v = F.floor(v).cast("double")
        flags.append(v.alias(c))
    return (item_weekly.where(F.col("cluster1To1Id").isNotNull())
            .groupBy("cluster1To1Id", "week_start")
            .agg(F.sum("salesQuantityKgL").alias("salesQuantityKgL"),
                 F.min(F.struct((-F.col("n_lines")).alias("n"), F.col("baseItemId").alias("b")))["b"]
                  .alias("baseItemId"),
                 F.min("campaignId").alias("campaignId"),
                 *flags))


def cluster_sizes(item_weekly: DataFrame) -> DataFrame:
    """Distinct items per cluster over all weeks."""
    return (item_weekly.where(F.col("cluster1To1Id").isNotNull())
            .groupBy("cluster1To1Id").agg(F.countDistinct("baseItemId").alias("num_items_in_cluster")))


def campaign_counts(item_weekly: DataFrame) -> DataFrame:
    """A3: distinct items on campaign per (cluster, week)."""
    return (item_weekly.where(on_campaign())
            .groupBy("cluster1To1Id", "week_start")
            .agg(F.countDistinct("baseItemId").alias("n_campaign_items_in_cluster")))


def item_share_in_cluster(item_weekly: DataFrame) -> DataFrame:
    """A5: mean baseline sales of an item over the sum of those means in its cluster,
    denominator floored at 1e-6."""
    means = (item_weekly.where(F.col("campaign_week_0") == 1)
             .groupBy("cluster1To1Id", "baseItemId")
             .agg(F.avg("salesQuantityKgL").alias("_avg")))
    tot = means.groupBy("cluster1To1Id").agg(F.sum("_avg").alias("_tot"))
    return (means.join(tot, "cluster1To1Id")
            .select("cluster1To1Id", "baseItemId",
                    (F.col("_avg") / F.greatest(F.col("_tot"), F.lit(1e-6))).alias("item_share_in_cluster")))


def add_competition(item_weekly: DataFrame) -> DataFrame:
    """Campaign count, coverage, baseline share and their product per item-week."""
    df = (item_weekly
          .join(campaign_counts(item_weekly), ["cluster1To1Id", "week_start"], "left")
          .join(cluster_sizes(item_weekly).withColumnRenamed("num_items_in_cluster", "_size"),
                "cluster1To1Id", "left")
          .join(item_share_in_cluster(item_weekly), ["cluster1To1Id", "baseItemId"], "left"))
    n = F.coalesce(F.col("n_campaign_items_in_cluster"), F.lit(0)).cast("long")
    cov = n / F.greatest(F.col("_size"), F.lit(1))
    share = F.coalesce(F.col("item_share_in_cluster"), F.lit(1.0))
    return (df.withColumn("n_campaign_items_in_cluster", n)
            .withColumn("campaign_coverage", cov)
            .withColumn("item_share_in_cluster", share)
            .withColumn("coverage_x_share", cov * share)
            .drop("_size"))


def fill_missing_weeks(weekly: DataFrame, id_col: str, bounds=None,
                       ffill=("cluster1To1Id", "campaignId"), int_flags: bool = True) -> DataFrame:
    """Every id x every week between the global first and last week.

    Missing weeks get sales 0 and all four flags 0; ``cluster1To1Id`` and
    ``campaignId`` are forward-filled within the id; other columns stay null.  Only measured
    rows are exchanged, in parts of about ``GRID_ROWS`` rows of the grid: each of them makes the
    weeks up to the id's next one with ``sequence`` (no join of a grid), the first also those
    before it."""
    r = weekly.agg(F.min("week_start").alias("a"), F.max("week_start").alias("b"), F.approx_count_distinct(id_col).alias("ids")).first()
    lo, hi = bounds or (r["a"], r["b"])
    if lo is None:
        return weekly
    lo, hi = F.lit(lo), F.lit(hi)
    spread = math.ceil(r["ids"] * ((bounds or r)[1] - (bounds or r)[0]).days / 7 / GRID_ROWS)
    df = weekly.repartition(spread, id_col) if spread > 1 else weekly
    # the row's week; null off the grid, where a row counts only if its id has no other
    off = F.col(id_col).isNull() | (F.col("week_start") < lo) | (F.col("week_start") > hi) | (F.datediff("week_start", lo) % 7 != 0)
    df = df.withColumn("_w", F.when(~off, F.col("week_start")))
    w = Window.partitionBy(id_col).orderBy("_w")
    df = df.withColumns({"_before": F.lag("_w").over(w), "_after": F.lead("_w").over(w), "_last": F.lead(F.lit(1)).over(w).isNull()})
    filled = [c for c in ffill if c in weekly.columns and c != id_col]
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    df = df.withColumns({f"_f_{c}": F.last(F.when(F.col("_w").isNotNull(), F.col(c)), ignorenulls=True).over(upto) for c in filled})
    df = df.where(F.col("_w").isNotNull() | F.col("_last"))
    first = F.when(F.col("_w").isNull() | F.col("_before").isNull(), lo).otherwise(F.col("_w"))
    last = F.when(F.col("_last"), hi).otherwise(F.greatest(F.col("_w"), F.date_sub("_after", 7)))
    df = df.withColumn("_week", F.explode(F.sequence(first, last, F.expr("INTERVAL 7 DAYS"))))
    own, cols = F.col("_week") == F.col("_w"), []
    for c in weekly.columns:
        v = F.when(own, F.col(c))
        if c in (id_col, "week_start"):
            continue
        if c == "salesQuantityKgL":
            v = F.coalesce(v, F.lit(0.0))
        elif c in FLAG_COLS:
            v = F.coalesce(v, F.lit(0)).cast("int" if int_flags else "double")
        elif c in filled:
            v = F.when(F.col("_week") >= F.col("_w"), F.col(f"_f_{c}"))
        cols.append(v.alias(c))
    return df.select(id_col, F.col("_week").alias("week_start"), *cols)


def mark_post_campaign_weeks(df: DataFrame, id_col: str, n: int = 2) -> DataFrame:
    """1 when campaign week 3 was set in any of the previous ``n`` rows."""
    w = Window.partitionBy(id_col).orderBy("week_start").rowsBetween(-n, -1)
    return df.withColumn("is_post_campaign",
                         F.coalesce((F.max(F.col("campaign_week_3")).over(w) > 0).cast("int"), F.lit(0)))


def legacy_weekly_orders(orders: DataFrame) -> DataFrame:
    """A9 (first generation): Monday weeks on the order date, quantity summed per item
    id, gaps filled between each item's own first and last week, modal non-zero
    campaign id per week (lowest on ties), 0 when none."""
    o = orders.withColumn("orderWeek", week_start(F.col("orderDate"), 0))
    sums = o.groupBy("itemId", "orderWeek").agg(F.sum("salesQuantity").alias("salesQuantity"))
    span = sums.groupBy("itemId").agg(F.min("orderWeek").alias("_a"), F.max("orderWeek").alias("_b"))
    grid = span.select("itemId", F.explode(F.sequence("_a", "_b", F.expr("INTERVAL 7 DAYS"))).alias("orderWeek"))
    cnt = (o.where(F.col("salesCampignId").isNotNull() & (F.col("salesCampignId") != 0))
           .groupBy("itemId", "orderWeek", "salesCampignId").agg(F.count("*").alias("_n")))
    mode = cnt.groupBy("itemId", "orderWeek").agg(
        F.min(F.struct((-F.col("_n")).alias("n"), F.col("salesCampignId").alias("c")))["c"].alias("salesCampignId"))
    return (grid.join(sums, ["itemId", "orderWeek"], "left")
            .join(mode, ["itemId", "orderWeek"], "left")
            .select(F.col("orderWeek").alias("orderDate"), "itemId",
                    F.coalesce("salesQuantity", F.lit(0.0)).alias("salesQuantity"),
                    F.coalesce("salesCampignId", F.lit(0)).cast("long").alias("salesCampignId")))
