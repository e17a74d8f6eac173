"""Registered queries: one per operator of the inventory, each a Spark job over the
driver tables, most with an independent DuckDB formulation (``plans.oracle``).

Every query reads the whole tables (no id subsets, no row caps); a ``limit`` only
appears where the feature is a top-k report.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import dates as D
from ..functions.dates import week_start
from ..operators import campaigns as C
from ..operators import features as FE
from ..operators import universe as U
from ..operators import weekly as WK
from ..sources import fixtures as FX
from . import oracle as O
from . import params as P

from .registry import (QUERIES, SQL, _filtered_items, _gap_filled_items, _inputs,  # noqa: F401
                       _normalized_items, _pre, _tagged, _weekly, finalize, register)


r = O.r
ON_CAMPAIGN_SQL = "(campaign_week_1 = 1 OR campaign_week_2 = 1 OR campaign_week_3 = 1)"


# =====================================================================================
# Flagship: per-item campaign lift (first end-to-end slice)
# =====================================================================================

def item_campaign_lift_df(spark: SparkSession, sf: str) -> DataFrame:
    iw, _ = _weekly(spark, sf)
    camp = U.on_campaign()
    agg = iw.groupBy("baseItemId", "cluster1To1Id").agg(
        F.sum(camp.cast("int")).alias("campaign_weeks"),
        F.sum((F.col("campaign_week_0") == 1).cast("int")).alias("baseline_weeks"),
        F.avg(F.when(camp, F.col("salesQuantityKgL"))).alias("avg_campaign_kgl"),
        F.median(F.when(F.col("campaign_week_0") == 1, F.col("salesQuantityKgL"))).alias("median_baseline_kgl"))
    return finalize(agg.withColumn(
        "campaign_lift",
        F.when(F.col("median_baseline_kgl") > 0, F.col("avg_campaign_kgl") / F.col("median_baseline_kgl"))))


register("item_campaign_lift", O.with_base(f"""
SELECT baseItemId, cluster1To1Id,
       CAST(sum(CASE WHEN {ON_CAMPAIGN_SQL} THEN 1 ELSE 0 END) AS BIGINT) AS campaign_weeks,
       CAST(sum(CASE WHEN campaign_week_0 = 1 THEN 1 ELSE 0 END) AS BIGINT) AS baseline_weeks,
       {r(f"avg(CASE WHEN {ON_CAMPAIGN_SQL} THEN salesQuantityKgL END)")} AS avg_campaign_kgl,
       {r("median(CASE WHEN campaign_week_0 = 1 THEN salesQuantityKgL END)")} AS median_baseline_kgl,
       {r(f"CASE WHEN median(CASE WHEN campaign_week_0 = 1 THEN salesQuantityKgL END) > 0 THEN avg(CASE WHEN {ON_CAMPAIGN_SQL} THEN salesQuantityKgL END) / median(CASE WHEN campaign_week_0 = 1 THEN salesQuantityKgL END) END")} AS campaign_lift
FROM iw1 GROUP BY baseItemId, cluster1To1Id
"""))(item_campaign_lift_df)


# =====================================================================================
# Scans, filters, item master
# =====================================================================================

@register("scan_filtered_orders", O.with_base(f"""
SELECT orderDate, deliveryDate, itemId, itemSkey, salesCampignId, {r('salesQuantity')} AS salesQuantity
FROM valid WHERE deliveryDate >= DATE '{P.DELIVERY_FLOOR}'
"""))
def scan_filtered_orders(spark, sf):
    o = U.valid_orders(FX.fact_order(spark, sf), P.DELIVERY_FLOOR)
    return finalize(o.select("orderDate", "deliveryDate", "itemId", "itemSkey", "salesCampignId", "salesQuantity"))


@register("orders_for_campaigns", O.with_base(f"""
SELECT f.salesCampignId, count(*) AS n_lines, count(DISTINCT f.itemId) AS n_items,
       {r('sum(f.salesQuantity)')} AS quantity
FROM valid f WHERE f.salesCampignId IN (SELECT campaignId FROM cal WHERE year(campaignStart) = {P.BACKTEST_YEAR})
GROUP BY f.salesCampignId
"""))
def orders_for_campaigns(spark, sf):
    inp = _inputs(spark, sf)
    keys = inp.campaigns.where(F.year("campaignStart") == P.BACKTEST_YEAR).select("campaignId")
    o = U.orders_for_keys(U.valid_orders(inp.orders), keys, "salesCampignId")
    return finalize(o.groupBy("salesCampignId").agg(
        F.count("*").alias("n_lines"), F.countDistinct("itemId").alias("n_items"),
        F.sum("salesQuantity").alias("quantity")))


@register("asof_orders", O.with_base(f"""
SELECT regexp_replace(itemId, '^[MSK]', '') AS baseItemId, count(*) AS n_lines, max(orderDate) AS last_order,
       {r('sum(salesQuantity)')} AS quantity
FROM valid WHERE orderDate < DATE '{P.FORECAST_DATE}' GROUP BY 1
"""))
def asof_orders(spark, sf):
    o = U.asof_orders(U.valid_orders(FX.fact_order(spark, sf)), P.FORECAST_DATE)
    return finalize(o.groupBy(U.base_item_id(F.col("itemId")).alias("baseItemId")).agg(
        F.count("*").alias("n_lines"), F.max("orderDate").alias("last_order"),
        F.sum("salesQuantity").alias("quantity")))


@register("base_item_map", O.with_base("SELECT DISTINCT itemId, baseItemId FROM dimb"))
def base_item_map(spark, sf):
    return finalize(U.item_id_map(FX.dim_item(spark, sf)))


@register("harmonized_clusters", O.with_base("SELECT baseItemId, cluster1To1Id FROM clus"))
def harmonized_clusters(spark, sf):
    return finalize(U.harmonized_clusters(FX.dim_item(spark, sf)))


@register("latest_item_version", O.with_base("SELECT baseItemId, itemId, itemSkey, itemDesc FROM latest"))
def latest_item_version(spark, sf):
    return finalize(U.latest_item_version(FX.dim_item(spark, sf)).select("baseItemId", "itemId", "itemSkey", "itemDesc"))


@register("unit_conversion", O.with_base(
    f"SELECT baseItemId, itemSkey, cluster1To1Id, {r('itemUnitConversion')} AS itemUnitConversion FROM master"))
def unit_conversion(spark, sf):
    m = U.item_master(FX.dim_item(spark, sf))
    return finalize(m.select("baseItemId", "itemSkey", "cluster1To1Id", "itemUnitConversion"))


@register("unmapped_items", O.with_base(
    "SELECT DISTINCT itemId FROM fact WHERE itemId NOT IN (SELECT itemId FROM dim)"))
def unmapped_items(spark, sf):
    return finalize(U.unmapped_items(FX.fact_order(spark, sf), FX.dim_item(spark, sf)))


@register("orders_kgl", O.with_base(f"""
SELECT baseItemId, cluster1To1Id, count(*) AS n_lines,
       CAST(sum(CASE WHEN salesQuantity < 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_returns,
       {r('sum(salesQuantityKgL)')} AS kgl, {r('max(salesQuantityKgL)')} AS max_kgl
FROM kgl GROUP BY baseItemId, cluster1To1Id
"""))
def orders_kgl(spark, sf):
    inp = _inputs(spark, sf)
    k = WK.orders_kgl(U.valid_orders(inp.orders), U.item_master(inp.items))
    return finalize(k.groupBy("baseItemId", "cluster1To1Id").agg(
        F.count("*").alias("n_lines"), F.sum((F.col("salesQuantity") < 0).cast("int")).alias("n_returns"),
        F.sum("salesQuantityKgL").alias("kgl"), F.max("salesQuantityKgL").alias("max_kgl")))


@register("conversion_stats", O.with_base(f"""
SELECT count(*) AS n_rows,
       CAST(sum(CASE WHEN itemId <> baseItemId THEN 1 ELSE 0 END) AS BIGINT) AS n_variant_rows,
       count(DISTINCT CASE WHEN itemId <> baseItemId THEN itemId END) AS n_variant_ids,
       CAST(sum(CASE WHEN salesQuantity * itemUnitConversion < 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_negative,
       {r('sum(salesQuantity)')} AS units, {r('sum(salesQuantityKgL)')} AS kgl,
       {r('CASE WHEN sum(salesQuantity) > 0 THEN sum(salesQuantityKgL) / sum(salesQuantity) ELSE 0 END')} AS avg_factor
FROM kgl
"""))
def conversion_stats(spark, sf):
    """Rows converted from variants, distinct variants, negatives, average factor."""
    inp = _inputs(spark, sf)
    k = WK.orders_kgl(U.valid_orders(inp.orders), U.item_master(inp.items))
    var = F.col("itemId") != F.col("baseItemId")
    a = k.agg(F.count("*").alias("n_rows"), F.sum(var.cast("int")).alias("n_variant_rows"),
              F.countDistinct(F.when(var, F.col("itemId"))).alias("n_variant_ids"),
              F.sum((F.col("salesQuantity") * F.col("itemUnitConversion") < 0).cast("int")).alias("n_negative"),
              F.sum("salesQuantity").alias("units"), F.sum("salesQuantityKgL").alias("kgl"))
    return finalize(a.withColumn("avg_factor", F.when(F.col("units") > 0, F.col("kgl") / F.col("units"))
                                 .otherwise(F.lit(0.0))))


# =====================================================================================
# Campaign tagging and week alignment
# =====================================================================================

@register("campaign_tagging", O.with_base("""
SELECT campaignId, week_start, CAST(late_delivery AS BIGINT) AS late_delivery,
       CAST(campaign_week_0 AS BIGINT) AS campaign_week_0, CAST(campaign_week_1 AS BIGINT) AS campaign_week_1,
       CAST(campaign_week_2 AS BIGINT) AS campaign_week_2, CAST(campaign_week_3 AS BIGINT) AS campaign_week_3,
       count(*) AS n_lines
FROM tagged_f GROUP BY ALL
"""))
def campaign_tagging(spark, sf):
    t, _ = _tagged(spark, sf)
    return finalize(t.groupBy("campaignId", "week_start", "late_delivery", "campaign_week_0", "campaign_week_1",
                              "campaign_week_2", "campaign_week_3").agg(F.count("*").alias("n_lines")))


@register("week_alignment", O.with_base(f"""
SELECT DISTINCT deliveryDate AS d, {O.wk('deliveryDate', 0)} AS week_monday,
       {O.wk('deliveryDate', P.WEEKDAY)} AS week_campaign, {O.wk('deliveryDate', 6)} AS week_sunday
FROM valid
"""))
def week_alignment(spark, sf):
    o = U.valid_orders(FX.fact_order(spark, sf)).select(F.col("deliveryDate").alias("d")).distinct()
    return finalize(o.select("d", week_start(F.col("d"), 0).alias("week_monday"),
                             week_start(F.col("d"), P.WEEKDAY).alias("week_campaign"),
                             week_start(F.col("d"), 6).alias("week_sunday")))


@register("item_campaign_calendar", O.with_base("""
SELECT DISTINCT f.itemId, c.campaignId, c.campaignStart AS campaignStartDate, c.campaignEnd AS campaignEndDate
FROM valid f JOIN cal c ON f.salesCampignId = c.campaignId
WHERE f.salesCampignId IS NOT NULL AND f.salesCampignId <> 0
"""))
def item_campaign_calendar(spark, sf):
    inp = _inputs(spark, sf)
    return finalize(C.item_campaign_calendar(U.valid_orders(inp.orders), inp.campaigns))


@register("campaign_flag_daily")
def campaign_flag_daily(spark, sf):
    """J2 (first generation): daily flag from the (item, campaign) calendar."""
    inp = _inputs(spark, sf)
    v = U.valid_orders(inp.orders)
    cal = C.item_campaign_calendar(v, inp.campaigns)
    f = C.campaign_flag_daily(v, cal)
    return finalize(f.groupBy("orderDate", "is_campaign_week").agg(F.count("*").alias("n_lines")))


SQL["campaign_flag_daily"] = O.with_base("""
SELECT v.orderDate, CAST(coalesce(v.orderDate >= i.s AND v.orderDate <= i.e, false) AS BIGINT) AS is_campaign_week,
       count(*) AS n_lines
FROM valid v LEFT JOIN (
  SELECT DISTINCT f.itemId, c.campaignId, c.campaignStart AS s, c.campaignEnd AS e
  FROM valid f JOIN cal c ON f.salesCampignId = c.campaignId) i
  ON v.itemId = i.itemId AND v.salesCampignId = i.campaignId
GROUP BY ALL
""")


# =====================================================================================
# Weekly layer
# =====================================================================================

@register("weekly_item_sales", O.with_base(f"""
SELECT baseItemId, week_start, {r('salesQuantityKgL')} AS salesQuantityKgL,
       CAST(campaign_week_0 AS BIGINT) AS campaign_week_0, CAST(campaign_week_1 AS BIGINT) AS campaign_week_1,
       CAST(campaign_week_2 AS BIGINT) AS campaign_week_2, CAST(campaign_week_3 AS BIGINT) AS campaign_week_3,
       campaignId, cluster1To1Id, n_lines
FROM iw0
"""))
def weekly_item_sales(spark, sf):
    t, _ = _tagged(spark, sf)
    return finalize(WK.weekly_item_sales(t))


@register("weekly_cluster_sales", O.with_base(f"""
SELECT cluster1To1Id, week_start, {r('salesQuantityKgL')} AS salesQuantityKgL, baseItemId, campaignId,
       {r('campaign_week_0')} AS campaign_week_0, {r('campaign_week_1')} AS campaign_week_1,
       {r('campaign_week_2')} AS campaign_week_2, {r('campaign_week_3')} AS campaign_week_3
FROM cw1
"""))
def weekly_cluster_sales(spark, sf):
    _, cw = _weekly(spark, sf)
    return finalize(cw)


@register("campaign_competition", O.with_base(f"""
SELECT baseItemId, week_start, cluster1To1Id, n_campaign_items_in_cluster,
       {r('campaign_coverage')} AS campaign_coverage, {r('item_share_in_cluster')} AS item_share_in_cluster,
       {r('coverage_x_share')} AS coverage_x_share
FROM iw1
"""))
def campaign_competition(spark, sf):
    iw, _ = _weekly(spark, sf)
    return finalize(iw.select("baseItemId", "week_start", "cluster1To1Id", "n_campaign_items_in_cluster",
                              "campaign_coverage", "item_share_in_cluster", "coverage_x_share"))


@register("cluster_sizes", O.with_base("SELECT cluster1To1Id, sz AS num_items_in_cluster FROM csize"))
def cluster_sizes(spark, sf):
    iw, _ = _weekly(spark, sf)
    return finalize(WK.cluster_sizes(iw))


@register("item_share_in_cluster", O.with_base(
    f"SELECT cluster1To1Id, baseItemId, {r('share')} AS item_share_in_cluster FROM bshare"))
def item_share_in_cluster(spark, sf):
    iw, _ = _weekly(spark, sf)
    return finalize(WK.item_share_in_cluster(iw))


@register("gap_filled_weeks", O.with_base(f"""
SELECT baseItemId, week_start, {r('salesQuantityKgL')} AS salesQuantityKgL,
       CAST(campaign_week_0 AS BIGINT) AS campaign_week_0, CAST(campaign_week_1 AS BIGINT) AS campaign_week_1,
       CAST(campaign_week_2 AS BIGINT) AS campaign_week_2, CAST(campaign_week_3 AS BIGINT) AS campaign_week_3,
       campaignId, cluster1To1Id, n_campaign_items_in_cluster, {r('campaign_coverage')} AS campaign_coverage,
       {r('item_share_in_cluster')} AS item_share_in_cluster, {r('coverage_x_share')} AS coverage_x_share
FROM igf
"""))
def gap_filled_weeks(spark, sf):
    return finalize(_gap_filled_items(spark, sf))


@register("post_campaign_weeks", O.with_base(
    "SELECT baseItemId, week_start, CAST(campaign_week_3 AS BIGINT) AS campaign_week_3, "
    "CAST(is_post_campaign AS BIGINT) AS is_post_campaign FROM ipost"))
def post_campaign_weeks(spark, sf):
    g = WK.mark_post_campaign_weeks(_gap_filled_items(spark, sf), "baseItemId")
    return finalize(g.select("baseItemId", "week_start", "campaign_week_3", "is_post_campaign"))


@register("item_normalizers", O.with_base(f"SELECT baseItemId, {r('normalizer')} AS normalizer FROM inorm"))
def item_normalizers(spark, sf):
    _, norms = _normalized_items(spark, sf)
    return finalize(norms)


@register("normalized_sales", O.with_base(
    f"SELECT baseItemId, week_start, {r('salesQuantityKgL_log')} AS salesQuantityKgL_log FROM inormed"))
def normalized_sales(spark, sf):
    n, _ = _normalized_items(spark, sf)
    return finalize(n.select("baseItemId", "week_start", "salesQuantityKgL_log"))


@register("cluster_normalized_sales", O.with_base(f"""
SELECT cluster1To1Id, week_start, {r('salesQuantityKgL_log')} AS salesQuantityKgL_log,
       CAST(is_post_campaign AS BIGINT) AS is_post_campaign FROM cnormed
"""))
def cluster_normalized_sales(spark, sf):
    _, cw = _weekly(spark, sf)
    g = WK.mark_post_campaign_weeks(WK.fill_missing_weeks(cw, "cluster1To1Id", int_flags=False), "cluster1To1Id")
    n, _ = FE.normalize(g, "cluster1To1Id")
    return finalize(n.select("cluster1To1Id", "week_start", "salesQuantityKgL_log", "is_post_campaign"))


@register("campaign_items_only", O.with_base(
    f"SELECT baseItemId, week_start, {r('salesQuantityKgL_log')} AS salesQuantityKgL_log FROM ifilt"))
def campaign_items_only(spark, sf):
    return finalize(_filtered_items(spark, sf).select("baseItemId", "week_start", "salesQuantityKgL_log"))


@register("time_features", O.with_base(f"""
SELECT DISTINCT week_start, CAST(weekofyear(week_start) AS BIGINT) AS week_of_year,
       CAST(year(week_start) AS BIGINT) AS year,
       {r('sin(2 * pi() * weekofyear(week_start) / 52)')} AS week_of_year_sin,
       {r('cos(2 * pi() * weekofyear(week_start) / 52)')} AS week_of_year_cos
FROM igf
"""))
def time_features(spark, sf):
    w = _gap_filled_items(spark, sf).select("week_start").distinct()
    return finalize(FE.add_time_features(w))


@register("lag_features", O.with_base(f"""
SELECT baseItemId, week_start, {', '.join(r(c) + ' AS ' + c for c in [
    'sales_lag_week1', 'sales_rolling_4w_week1', 'sales_lag_week2', 'sales_rolling_4w_week2',
    'sales_lag_week3', 'sales_rolling_4w_week3', 'sales_lag_12w', 'sales_lag_52w'])}
FROM (SELECT baseItemId, week_start, {O.lag_cols('baseItemId', 4)} FROM ifilt)
"""))
def lag_features(spark, sf):
    f = FE.add_lag_features(_filtered_items(spark, sf), "baseItemId", P.HORIZON)
    return finalize(f.select("baseItemId", "week_start", "sales_lag_week1", "sales_rolling_4w_week1",
                             "sales_lag_week2", "sales_rolling_4w_week2", "sales_lag_week3",
                             "sales_rolling_4w_week3", "sales_lag_12w", "sales_lag_52w"))


from . import q_features, q_frames, q_given, q_legacy, q_models, q_more, q_wide  # noqa: E402,F401  (register on import)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return {k: v for k, v in SQL.items() if k in QUERIES}
