"""Registered queries: universe, hygiene, I/O, training frames, non-model forecasts,
metrics and reports."""

from __future__ import annotations

import math


from pyspark.sql import functions as F

from ..functions import metrics as MT
from ..functions.dates import as_date, last_complete_week
from ..functions.mathx import logit, sigmoid
from ..operators import campaigns as C
from ..operators import features as FE
from ..operators import forecast as FC
from ..operators import report as R
from ..operators import training as TR
from ..operators import universe as U
from ..operators import weekly as WK
from ..sources import calendar as CAL
from ..sources import fixtures as FX
from ..sources import io as IO
from . import oracle as O
from . import params as P
from .registry import _filtered_items, _inputs, _normalized_items, _tagged, _weekly, finalize, register

r = O.r
ONC = "(campaign_week_1 = 1 OR campaign_week_2 = 1 OR campaign_week_3 = 1)"
CUTOFF = last_complete_week(P.FORECAST_DATE, P.CAMPAIGN_START)
CAMP_ISO_WEEK = as_date(P.CAMPAIGN_START).isocalendar()[1]


def _wb(extra: str, final: str) -> str:
    return O.with_base(", " + extra.strip() + "\n" + final) if extra else O.with_base(final)


def _norms(spark, sf):
    return _normalized_items(spark, sf)[1]


# --- P4 / W10 / J11 / A14 / W9 ---------------------------------------------------------

@register("seasonal_baseline", _wb(f"""
sb AS (
  SELECT f.baseItemId, (exp(f.salesQuantityKgL_log) - 1) * coalesce(n.normalizer, 1000.0) AS kgl,
         weekofyear(f.week_start) BETWEEN {CAMP_ISO_WEEK - 2} AND {CAMP_ISO_WEEK + 2} AS near
  FROM ifilt f LEFT JOIN inorm n ON f.baseItemId = n.baseItemId WHERE f.week_start <= DATE '{CUTOFF}'),
sba AS (
  SELECT baseItemId, median(CASE WHEN near THEN kgl END) AS mn, avg(CASE WHEN near THEN kgl END) AS an,
         median(kgl) AS ma, avg(kgl) AS aa, max(CAST(near AS INTEGER)) AS hn FROM sb GROUP BY baseItemId),
sbb AS (
  SELECT baseItemId, CASE WHEN hn = 1 THEN mn ELSE ma END AS med, CASE WHEN hn = 1 THEN an ELSE aa END AS av FROM sba)
""", f"""
SELECT baseItemId, CAST(w AS BIGINT) AS campaign_week,
       {r("CASE WHEN med > 0 AND med < 1000000 THEN med WHEN av > 0 AND av < 1000000 THEN av ELSE 1000.0 END")} AS baseline_kgl
FROM sbb, (VALUES (1), (2), (3)) t(w)
"""))
def seasonal_baseline(spark, sf):
    n, norms = _normalized_items(spark, sf)
    return finalize(FC.seasonal_baseline(U.campaign_items_only(n), "item", P.FORECAST_DATE, P.CAMPAIGN_START, norms))


@register("latest_state", O.with_base(f"""
SELECT baseItemId, week_start, {r('salesQuantityKgL_log')} AS salesQuantityKgL_log FROM ifilt
WHERE week_start <= DATE '{P.FORECAST_DATE}'
QUALIFY row_number() OVER (PARTITION BY baseItemId ORDER BY week_start DESC) = 1
"""))
def latest_state(spark, sf):
    l = FC.latest_state(_filtered_items(spark, sf), "baseItemId", P.FORECAST_DATE)
    return finalize(l.select("baseItemId", "week_start", "salesQuantityKgL_log"))


@register("baseline_52w", O.with_base(f"""
SELECT a.baseItemId, a.week_start, {r('b.salesQuantityKgL_log')} AS salesQuantityKgL_log_lag_52w
FROM ifilt a LEFT JOIN ifilt b ON a.baseItemId = b.baseItemId AND b.week_start = a.week_start - 364
"""))
def baseline_52w(spark, sf):
    j = FC.lag_date_features(_filtered_items(spark, sf), "baseItemId", 52)
    return finalize(j.select("baseItemId", "week_start", "salesQuantityKgL_log_lag_52w"))


#: Campaign 69 starts on 2001-07-10; a year back, aligned to Monday: 2000-07-10.
_LY = "DATE '2000-07-10'"


def _ly_sql(key: str, source: str) -> str:
    weeks = ", ".join(
        f"sum(CASE WHEN date_diff('day', {_LY}, week_start) // 7 = {k - 1} THEN salesQuantityKgL ELSE 0 END) AS last_year_w{k}" for k in (1, 2, 3))
    return f"""ly_{key} AS (SELECT {key}, {weeks} FROM {source}
  WHERE week_start >= {_LY} AND week_start < {_LY} + 21 GROUP BY {key})"""


@register("last_year_sales", _wb(_ly_sql("baseItemId", "iw0"), f"""
SELECT i.baseItemId, {r('last_year_w1')} AS last_year_w1, {r('last_year_w2')} AS last_year_w2, {r('last_year_w3')} AS last_year_w3
FROM (SELECT DISTINCT baseItemId FROM iw0) i LEFT JOIN ly_baseItemId l ON i.baseItemId = l.baseItemId
"""))
def last_year_sales(spark, sf):
    """A14, item half."""
    t, _ = _tagged(spark, sf)
    return finalize(FC.last_year_sales(WK.weekly_item_sales(t), "baseItemId", P.CAMPAIGN_START))


@register("cluster_last_year_sales", _wb(_ly_sql("cluster1To1Id", "cw1"), f"""
SELECT i.cluster1To1Id, {r('last_year_w1')} AS last_year_w1, {r('last_year_w2')} AS last_year_w2, {r('last_year_w3')} AS last_year_w3
FROM (SELECT DISTINCT cluster1To1Id FROM cw1) i LEFT JOIN ly_cluster1To1Id l ON i.cluster1To1Id = l.cluster1To1Id
"""))
def cluster_last_year_sales(spark, sf):
    """A14, cluster half."""
    return finalize(FC.last_year_sales(_weekly(spark, sf)[1], "cluster1To1Id", P.CAMPAIGN_START))


# --- R3, P18, A13, K1 on plain numbers -------------------------------------------------
# The campaign's actual weeks (from 2001-07-10 on) stand for the prediction in R3; in P18
# last year's weeks are the prediction and the seasonal median of P4 the baseline.

_ACT = """act_{k} AS (SELECT {k}, sum(salesQuantityKgL) AS actual FROM {src}
  WHERE week_start >= DATE '2001-07-10' AND week_start < DATE '2001-07-31' GROUP BY {k})"""


def _actual(weekly, key):
    from ..functions.dates import lit_date
    w = weekly.where((F.col("week_start") >= lit_date(P.CAMPAIGN_START)) & (F.col("week_start") <= lit_date(P.CAMPAIGN_END)))
    return w.groupBy(key).agg(F.sum("salesQuantityKgL").alias("actual_kgl"))


def _yoy_sql(key: str, source: str) -> str:
    return _wb(_ly_sql(key, source) + ", " + _ACT.format(k=key, src=source), f"""
SELECT a.{key}, {r('a.actual')} AS campaign_total, {r('last_year_w1 + last_year_w2 + last_year_w3')} AS last_year_total,
  {r(f"CASE WHEN l.{key} IS NULL THEN NULL WHEN last_year_w1 + last_year_w2 + last_year_w3 > 0 THEN (a.actual - (last_year_w1 + last_year_w2 + last_year_w3)) / (last_year_w1 + last_year_w2 + last_year_w3) * 100 ELSE 0 END")} AS yoy_pct
FROM act_{key} a LEFT JOIN ly_{key} l ON a.{key} = l.{key}
""")


@register("yoy_effect", _yoy_sql("baseItemId", "iw0"))
def yoy_effect(spark, sf):
    """R3, item level."""
    iw, _ = _weekly(spark, sf)
    total = _actual(iw, "baseItemId").withColumnRenamed("actual_kgl", "campaign_total")
    return finalize(R.yoy_effect(total, FC.last_year_sales(iw, "baseItemId", P.CAMPAIGN_START), "baseItemId"))


@register("cluster_yoy_effect", _yoy_sql("cluster1To1Id", "cw1"))
def cluster_yoy_effect(spark, sf):
    """R3, cluster level."""
    _, cw = _weekly(spark, sf)
    total = _actual(cw, "cluster1To1Id").withColumnRenamed("actual_kgl", "campaign_total")
    return finalize(R.yoy_effect(total, FC.last_year_sales(cw, "cluster1To1Id", P.CAMPAIGN_START), "cluster1To1Id"))


_COMPARE = f"""
{_ly_sql("baseItemId", "iw0")}, {_ACT.format(k="baseItemId", src="iw0")},
sb AS (
  SELECT f.baseItemId, (exp(f.salesQuantityKgL_log) - 1) * coalesce(n.normalizer, 1000.0) AS kgl,
         weekofyear(f.week_start) BETWEEN 26 AND 30 AS near
  FROM ifilt f LEFT JOIN inorm n ON f.baseItemId = n.baseItemId WHERE f.week_start <= DATE '2001-06-05'),
sbase AS (
  SELECT baseItemId, CASE WHEN bool_or(near) THEN median(CASE WHEN near THEN kgl END) ELSE median(kgl) END AS med,
         CASE WHEN bool_or(near) THEN avg(CASE WHEN near THEN kgl END) ELSE avg(kgl) END AS av
  FROM sb GROUP BY baseItemId),
cmp AS (
  SELECT a.baseItemId, a.actual, coalesce(l.last_year_w1 + l.last_year_w2 + l.last_year_w3, 0) AS predicted,
         coalesce(3 * CASE WHEN s.med > 0 AND s.med < 1e6 THEN s.med WHEN s.av > 0 AND s.av < 1e6 THEN s.av
                           WHEN s.baseItemId IS NOT NULL THEN 1000.0 END, 0) AS baseline
  FROM act_baseItemId a LEFT JOIN ly_baseItemId l ON a.baseItemId = l.baseItemId LEFT JOIN sbase s ON a.baseItemId = s.baseItemId),
scored AS (
  SELECT *, CASE WHEN abs(actual) + abs(predicted) = 0 THEN 0.0 ELSE abs(actual - predicted) / ((abs(actual) + abs(predicted)) / 2) END * 100 AS smape,
         CASE WHEN baseline > 0 THEN (actual / baseline - 1) * 100 ELSE 0.0 END AS lift_actual,
         CASE WHEN baseline > 0 THEN (predicted / baseline - 1) * 100 ELSE 0.0 END AS lift_predicted
  FROM cmp)
"""


def _compared(spark, sf):
    n, norms = _normalized_items(spark, sf)
    iw, _ = _weekly(spark, sf)
    base = FC.seasonal_baseline(U.campaign_items_only(n), "item", P.FORECAST_DATE, P.CAMPAIGN_START, norms)
    ly = FC.last_year_sales(iw, "baseItemId", P.CAMPAIGN_START)
    pred = ly.select("baseItemId", F.explode(F.array(*[F.coalesce(f"last_year_w{k}", F.lit(0.0)) for k in (1, 2, 3)]))
                     .alias("prediction_kgl"))
    return R.compare_with_actuals(pred, base, _actual(iw, "baseItemId"), "baseItemId")


@register("backtest_compare", _wb(_COMPARE, f"""
SELECT baseItemId, {', '.join(f"{r(c)} AS {c}" for c in ('actual', 'predicted', 'baseline', 'smape', 'lift_actual', 'lift_predicted'))} FROM scored
"""))
def backtest_compare(spark, sf):
    """P18 on last year's sales as the prediction and the seasonal median as baseline."""
    return finalize(_compared(spark, sf).select("baseItemId", "actual", "predicted", "baseline", "smape", "lift_actual", "lift_predicted"))


def _as_results(c):
    """P18 rows under the names of a backtest's item half."""
    names = {x: f"item_{x}" for x in ("smape", "lift_actual", "lift_predicted")}
    c = c.select(F.lit(69).cast("long").alias("campaign_id"), F.col("baseItemId").alias("item_id"),
                 *[F.col(a).alias(b) for a, b in names.items()])
    return c.withColumns({f"cluster_{x}": F.lit(None).cast("double") for x in names})


@register("backtest_compare_summary", _wb(_COMPARE, f"""
SELECT {r('avg(smape)')} AS item_mean_smape, {r('median(smape)')} AS item_median_smape,
       {r('avg(lift_predicted - lift_actual)')} AS item_mean_lift_error, count(*) AS n_items FROM scored
"""))
def backtest_compare_summary(spark, sf):
    """A13 over the rows of ``backtest_compare``."""
    s = R.backtest_summary(_as_results(_compared(spark, sf)))
    return finalize(s.select("item_mean_smape", "item_median_smape", "item_mean_lift_error", "n_items"))


@register("backtest_compare_best_worst", _wb(_COMPARE, f"""
SELECT item_id, item_smape, rank_kind FROM (
  SELECT baseItemId AS item_id, {r('smape')} AS item_smape, 'best' AS rank_kind FROM scored QUALIFY row_number() OVER (ORDER BY smape, baseItemId) <= 5
  UNION ALL
  SELECT baseItemId, {r('smape')}, 'worst' FROM scored QUALIFY row_number() OVER (ORDER BY smape DESC, baseItemId) <= 5)
"""))
def backtest_compare_best_worst(spark, sf):
    """K1 over the rows of ``backtest_compare`` (a top-k report)."""
    return finalize(R.best_worst(_as_results(_compared(spark, sf))).select("item_id", "item_smape", "rank_kind"))


@register("horizon_targets", O.with_base(f"""
SELECT baseItemId, week_start, {r('target')} AS target FROM (
  SELECT baseItemId, week_start, lead(salesQuantityKgL_log, {P.HORIZON}) OVER (PARTITION BY baseItemId ORDER BY week_start) AS target
  FROM ifilt) WHERE target IS NOT NULL
"""))
def horizon_targets(spark, sf):
    t = TR.horizon_targets(_filtered_items(spark, sf), "baseItemId", "salesQuantityKgL_log", P.HORIZON)
    return finalize(t.select("baseItemId", "week_start", "target"))


# --- W12-W15 ---------------------------------------------------------------------------

@register("balanced_sample", O.with_base("""
SELECT baseItemId, week_start, CAST(campaign_week_1 AS BIGINT) AS campaign_week_1 FROM (
  SELECT * FROM ifilt WHERE campaign_week_1 = 1
  UNION ALL
  SELECT * FROM (
    SELECT * FROM ifilt
    WHERE baseItemId IN (SELECT baseItemId FROM ifilt WHERE campaign_week_1 = 1)
      AND campaign_week_1 = 0 AND campaign_week_0 = 1
    QUALIFY row_number() OVER (ORDER BY week_start DESC, baseItemId) <= 5 * (SELECT count(*) FROM ifilt WHERE campaign_week_1 = 1)))
"""))
def balanced_sample(spark, sf):
    s = TR.balanced_sample(_filtered_items(spark, sf), "item", 1)
    return finalize(s.select("baseItemId", "week_start", "campaign_week_1"))


@register("temporal_split", O.with_base(f"""
SELECT baseItemId, week_start,
       CASE WHEN rn < floor(n * {TR.TRAIN_RATIO!r}::DOUBLE) THEN 'train'
            WHEN rn < floor(n * {TR.TRAIN_RATIO + TR.VAL_RATIO!r}::DOUBLE) THEN 'val' ELSE 'test' END AS split
FROM (SELECT baseItemId, week_start, row_number() OVER (ORDER BY week_start, baseItemId) - 1 AS rn,
             count(*) OVER () AS n FROM ifilt WHERE campaign_week_0 = 1 OR {ONC})
"""))
def temporal_split(spark, sf):
    d = _filtered_items(spark, sf).where((F.col("campaign_week_0") == 1) | U.on_campaign())
    return finalize(TR.temporal_split(d, "baseItemId").select("baseItemId", "week_start", "split"))


@register("cutoff_split", O.with_base(f"""
SELECT split, count(*) AS n_rows, count(DISTINCT baseItemId) AS n_items FROM (
  SELECT baseItemId, CASE WHEN week_start < DATE '{P.FORECAST_DATE}' THEN 'train' ELSE 'test' END AS split FROM ifilt)
GROUP BY split
"""))
def cutoff_split(spark, sf):
    s = TR.cutoff_split(_filtered_items(spark, sf), P.FORECAST_DATE)
    return finalize(s.groupBy("split").agg(F.count("*").alias("n_rows"), F.countDistinct("baseItemId").alias("n_items")))


@register("walk_forward_folds")
def walk_forward_folds(spark, sf):
    weeks = _filtered_items(spark, sf).select("week_start").distinct()
    f = TR.walk_forward_folds(weeks, 3)
    return finalize(f.groupBy("fold", "role").agg(F.count("*").alias("n_weeks"), F.min("week_start").alias("first_week"),
                                                  F.max("week_start").alias("last_week")))


from .registry import SQL as _SQL  # noqa: E402

_SQL["walk_forward_folds"] = _wb("""
wk AS (SELECT week_start, row_number() OVER (ORDER BY week_start) - 1 AS wr, count(*) OVER () AS nw
       FROM (SELECT DISTINCT week_start FROM ifilt)),
folds AS (
  SELECT week_start, f AS fold,
         CASE WHEN wr <= least((nw // 4) * (f + 1), nw - 1) THEN 'train' WHEN wr <= least((nw // 4) * (f + 2), nw - 1) THEN 'val' END AS role
  FROM wk, (VALUES (0), (1), (2)) t(f))
""", """
SELECT CAST(fold AS BIGINT) AS fold, role, count(*) AS n_weeks, min(week_start) AS first_week, max(week_start) AS last_week
FROM folds WHERE role IS NOT NULL GROUP BY fold, role
""")


@register("hash_split", O.with_base("""
SELECT split, count(*) AS n_rows FROM (
  SELECT CASE WHEN b < 60 THEN 'train' WHEN b < 80 THEN 'val' ELSE 'test' END AS split FROM (
    SELECT CAST('0x' || substr(md5('42|' || baseItemId || '|' || CAST(week_start AS VARCHAR)), 1, 7) AS BIGINT) % 100 AS b FROM ifilt))
GROUP BY split
"""))
def hash_split(spark, sf):
    """Stable hash split of the item-weeks."""
    s = TR.hash_split(_filtered_items(spark, sf), ["baseItemId", "week_start"])
    return finalize(s.groupBy("split").agg(F.count("*").alias("n_rows")))


# --- F4 / F7 / F10 / S5b / K2 / K5 / A12 / A19 -----------------------------------------

@register("item_universe", O.with_base("""
SELECT d.itemId, d.itemSkey, d.baseItemId, c.cluster1To1Id
FROM dimb d JOIN clus c ON d.baseItemId = c.baseItemId
WHERE c.cluster1To1Id IN (
  SELECT c2.cluster1To1Id FROM clus c2 WHERE c2.baseItemId IN (
    SELECT DISTINCT regexp_replace(itemId, '^[MSK]', '') FROM valid WHERE salesCampignId IN (SELECT campaignId FROM cal)))
  OR d.baseItemId IN (SELECT DISTINCT regexp_replace(itemId, '^[MSK]', '') FROM valid
                      WHERE salesCampignId IN (SELECT campaignId FROM cal))
"""))
def item_universe(spark, sf):
    inp = _inputs(spark, sf)
    u = U.item_universe(U.valid_orders(inp.orders), inp.items, inp.campaigns)
    return finalize(u.select("itemId", "itemSkey", "baseItemId", "cluster1To1Id"))


def _bt_start():
    return "1999-12-28"   # fixed: start of campaign 53, the first one of the backtest year


@register("leakage_guard", _wb(f"""
it AS (SELECT d.itemId, c.cluster1To1Id FROM dimb d JOIN clus c ON d.baseItemId = c.baseItemId),
tg AS (SELECT v.itemId, c.campaignStart > DATE '{_bt_start()}' AS fut FROM valid v JOIN cal c ON v.salesCampignId = c.campaignId),
pastit AS (SELECT DISTINCT itemId FROM tg WHERE NOT fut),
onlyfut AS (SELECT DISTINCT itemId FROM tg WHERE fut AND itemId NOT IN (SELECT itemId FROM pastit)),
badc AS (SELECT DISTINCT cluster1To1Id FROM it WHERE itemId IN (SELECT itemId FROM onlyfut) AND trim(cluster1To1Id) <> ''),
excl AS (SELECT DISTINCT itemId FROM it WHERE cluster1To1Id IN (SELECT cluster1To1Id FROM badc)
         AND itemId NOT IN (SELECT itemId FROM pastit))
""", f"""
SELECT 'items' AS tbl, count(*) AS n_rows FROM it WHERE itemId NOT IN (SELECT itemId FROM excl)
UNION ALL SELECT 'orders', count(*) FROM valid WHERE itemId NOT IN (SELECT itemId FROM excl)
UNION ALL SELECT 'campaigns', count(*) FROM cal WHERE campaignStart <= DATE '{_bt_start()}'
"""))
def leakage_guard(spark, sf):
    inp = _inputs(spark, sf)
    items = inp.items.drop("cluster1To1Id").withColumn("baseItemId", U.base_item_id(F.col("itemId"))) \
        .join(U.harmonized_clusters(inp.items), "baseItemId")
    i, o, c = U.leakage_guard(U.valid_orders(inp.orders), items, inp.campaigns, _bt_start())
    out = (i.select(F.lit("items").alias("tbl")).groupBy("tbl").count()
           .unionByName(o.select(F.lit("orders").alias("tbl")).groupBy("tbl").count())
           .unionByName(c.select(F.lit("campaigns").alias("tbl")).groupBy("tbl").count()))
    return finalize(out.withColumnRenamed("count", "n_rows"))


@register("eligible_items", O.with_base("SELECT baseItemId, count(*) AS n_weeks FROM iw0 GROUP BY 1 HAVING count(*) >= 10"))
def eligible_items(spark, sf):
    t, _ = _tagged(spark, sf)
    return finalize(U.eligible_ids(WK.weekly_item_sales(t), "baseItemId", 10))


@register("missing_items", O.with_base("""
SELECT DISTINCT baseItemId FROM dimb WHERE baseItemId NOT IN (SELECT baseItemId FROM iw0 WHERE campaign_week_1 = 1)
"""))
def missing_items(spark, sf):
    """Requested ids (the whole item master) absent from the processed campaign table."""
    inp = _inputs(spark, sf)
    t, _ = _tagged(spark, sf)
    processed = WK.weekly_item_sales(t).where(F.col("campaign_week_1") == 1).select("baseItemId")
    req = U.item_id_map(inp.items).select("baseItemId").distinct()
    return finalize(req.join(processed, "baseItemId", "left_anti"))


@register("top_campaign_items", O.with_base(f"""
SELECT baseItemId, count(*) AS campaign_weeks FROM iw0 WHERE {ONC}
GROUP BY baseItemId ORDER BY campaign_weeks DESC, baseItemId LIMIT 10
"""))
def top_campaign_items(spark, sf):
    """K2: top-10 items by campaign weeks (a top-k report; ties by id)."""
    t, _ = _tagged(spark, sf)
    iw = WK.weekly_item_sales(t)
    return finalize(iw.where(U.on_campaign()).groupBy("baseItemId").agg(F.count("*").alias("campaign_weeks"))
                    .orderBy(F.desc("campaign_weeks"), "baseItemId").limit(10))


@register("duplicate_orders", O.with_base("""
SELECT orderDate, deliveryDate, itemId, count(*) AS n FROM valid GROUP BY ALL HAVING count(*) > 1
"""))
def duplicate_orders(spark, sf):
    """K5: repeated (order date, delivery date, item) keys."""
    v = U.valid_orders(FX.fact_order(spark, sf))
    return finalize(v.groupBy("orderDate", "deliveryDate", "itemId").agg(F.count("*").alias("n")).where("n > 1"))


@register("data_quality_profile", O.with_base(f"""
SELECT count(*) AS n_rows, count(DISTINCT baseItemId) AS n_items,
       CAST(sum(CASE WHEN {ONC} THEN 1 ELSE 0 END) AS BIGINT) AS campaign_rows,
       CAST(sum(CASE WHEN campaign_week_0 = 1 THEN 1 ELSE 0 END) AS BIGINT) AS baseline_rows,
       CAST(sum(CASE WHEN salesQuantityKgL_log = 0 THEN 1 ELSE 0 END) AS BIGINT) AS zero_weeks,
       {r('min(salesQuantityKgL_log)')} AS min_log, {r('median(salesQuantityKgL_log)')} AS median_log,
       {r('max(salesQuantityKgL_log)')} AS max_log
FROM ifilt
"""))
def data_quality_profile(spark, sf):
    """One conditional-count aggregate over the processed item frame."""
    from ..functions.stats import exact_median
    d = _filtered_items(spark, sf)
    med = exact_median(d, "salesQuantityKgL_log")   # global: distributed exact selection
    return finalize(d.agg(
        F.count("*").alias("n_rows"), F.countDistinct("baseItemId").alias("n_items"),
        F.sum(U.on_campaign().cast("int")).alias("campaign_rows"),
        F.sum((F.col("campaign_week_0") == 1).cast("int")).alias("baseline_rows"),
        F.sum((F.col("salesQuantityKgL_log") == 0).cast("int")).alias("zero_weeks"),
        F.min("salesQuantityKgL_log").alias("min_log"), F.lit(med).cast("double").alias("median_log"),
        F.max("salesQuantityKgL_log").alias("max_log")))


@register("campaign_history_counts", O.with_base(f"""
SELECT cluster1To1Id, count(DISTINCT CASE WHEN {ONC} THEN baseItemId END) AS items_with_campaign,
       CAST(sum(CASE WHEN {ONC} THEN 1 ELSE 0 END) AS BIGINT) AS item_campaign_weeks,
       count(DISTINCT CASE WHEN {ONC} THEN week_start END) AS cluster_campaign_weeks,
       (SELECT count(DISTINCT week_start) FROM iw0 WHERE {ONC}) AS global_campaign_weeks
FROM iw0 GROUP BY cluster1To1Id
"""))
def campaign_history_counts(spark, sf):
    """Campaign items and weeks per cluster, plus the global campaign-week count."""
    t, _ = _tagged(spark, sf)
    iw = WK.weekly_item_sales(t)
    on = U.on_campaign()
    g = iw.where(on).agg(F.countDistinct("week_start")).first()[0]   # one scalar
    per = iw.groupBy("cluster1To1Id").agg(
        F.countDistinct(F.when(on, F.col("baseItemId"))).alias("items_with_campaign"),
        F.sum(on.cast("int")).alias("item_campaign_weeks"),
        F.countDistinct(F.when(on, F.col("week_start"))).alias("cluster_campaign_weeks"))
    return finalize(per.withColumn("global_campaign_weeks", F.lit(g).cast("long")))


# --- I/O round trips (S2, S4, S6, S9, S10, S11) -----------------------------------------

WEEKLY_SQL = f"""
SELECT baseItemId, week_start, {r('salesQuantityKgL')} AS salesQuantityKgL, campaignId, n_lines FROM iw0
WHERE campaign_week_0 = 1
"""


def _weekly_for_io(spark, sf):
    t, _ = _tagged(spark, sf)
    return WK.weekly_item_sales(t).select("baseItemId", "week_start", "salesQuantityKgL", "campaignId", "n_lines",
                                          "campaign_week_0")


@register("parquet_roundtrip", O.with_base(WEEKLY_SQL))
def parquet_roundtrip(spark, sf):
    """S6 + S1: write Parquet, read back with projection and a pushed predicate."""
    path = IO.scratch_path(spark, "weekly-parquet")
    IO.write_table(_weekly_for_io(spark, sf), path, "parquet", partition_by=["campaign_week_0"])
    back = IO.read_table(spark, path, "parquet", ["baseItemId", "week_start", "salesQuantityKgL", "campaignId",
                                                  "n_lines"], F.col("campaign_week_0") == 1)
    return finalize(back)


@register("csv_roundtrip", O.with_base(WEEKLY_SQL))
def csv_roundtrip(spark, sf):
    """S7 + S2: write CSV with a header, read back recursively with an explicit schema."""
    from pyspark.sql import types as T
    path = IO.scratch_path(spark, "weekly-csv")
    df = _weekly_for_io(spark, sf)
    IO.write_table(df, path, "csv")
    schema = T.StructType([T.StructField("baseItemId", T.StringType()), T.StructField("week_start", T.DateType()),
                           T.StructField("salesQuantityKgL", T.DoubleType()), T.StructField("campaignId", T.LongType()),
                           T.StructField("n_lines", T.LongType()), T.StructField("campaign_week_0", T.IntegerType())])
    back = IO.read_table(spark, path, "csv", ["baseItemId", "week_start", "salesQuantityKgL", "campaignId", "n_lines"],
                         "campaign_week_0 = 1", schema=schema)
    return finalize(back)


@register("materialize_snapshot", O.with_base(WEEKLY_SQL))
def materialize_snapshot(spark, sf):
    """Snapshot into the shared folder, then filter the snapshot."""
    s = IO.snapshot(_weekly_for_io(spark, sf), "weekly")
    return finalize(s.where("campaign_week_0 = 1").drop("campaign_week_0"))


@register("calendar_unpivot", O.with_base("SELECT campaignId, campaignStart, campaignEnd FROM cal"))
def calendar_unpivot(spark, sf):
    """Calendar -> workbook layout (one column per campaign) -> long form."""
    return finalize(CAL.to_long(CAL.to_wide(FX.campaigns(spark, sf))))


@register("harmonize_types", O.with_base("""
SELECT 'itemId' AS column_name, CASE WHEN count(itemId) = count(TRY_CAST(itemId AS DOUBLE)) THEN 'double' ELSE 'string' END AS dtype FROM dim
UNION ALL SELECT 'itemSkey', CASE WHEN count(itemSkey) = count(TRY_CAST(CAST(itemSkey AS VARCHAR) AS DOUBLE)) THEN 'double' ELSE 'string' END FROM dim
UNION ALL SELECT 'cluster1To1Id', CASE WHEN count(cluster1To1Id) = count(TRY_CAST(cluster1To1Id AS DOUBLE)) THEN 'double' ELSE 'string' END FROM dim
UNION ALL SELECT 'netWeight', CASE WHEN count(wnet) = count(TRY_CAST(CAST(wnet AS VARCHAR) AS DOUBLE)) THEN 'double' ELSE 'string' END FROM dim
"""))
def harmonize_types(spark, sf):
    """S10 on an all-string copy of the item master."""
    d = FX.dim_item(spark, sf).select(F.col("itemId"), F.col("itemSkey").cast("string").alias("itemSkey"),
                                      F.col("cluster1To1Id"),
                                      F.col("netWeightKgComparisonUnit").cast("string").alias("netWeight"))
    h = IO.harmonize_types(d)
    rows = [(f.name, "double" if f.dataType.typeName() == "double" else "string") for f in h.schema.fields]
    return spark.createDataFrame(rows, "column_name string, dtype string")


@register("normalize_with_saved", O.with_base(
    f"SELECT baseItemId, week_start, {r('salesQuantityKgL_log')} AS salesQuantityKgL_log FROM inormed"))
def normalize_with_saved(spark, sf):
    """Normalizers saved as Parquet, reloaded and applied (forecasting mode)."""
    g = WK.mark_post_campaign_weeks(WK.fill_missing_weeks(_weekly(spark, sf)[0], "baseItemId"), "baseItemId")
    path = IO.scratch_path(spark, "item-normalizers")
    IO.write_table(FE.compute_normalizers(g, "baseItemId"), path)
    n, _ = FE.normalize(g, "baseItemId", spark.read.parquet(path))
    return finalize(n.select("baseItemId", "week_start", "salesQuantityKgL_log"))


# --- metrics, math, verdicts -------------------------------------------------------------

@register("metrics", O.with_base(f"""
SELECT campaign_week_0 AS is_baseline,
  {r("avg(CASE WHEN (abs(a) + abs(p)) / 2 = 0 THEN 0.0 ELSE abs(a - p) / ((abs(a) + abs(p)) / 2) END) * 100")} AS smape,
  {r("avg(abs(a - p))")} AS mae,
  {r("avg(CASE WHEN a <> 0 THEN abs((a - p) / a) END) * 100")} AS mape,
  {r("sqrt(avg((a - p) * (a - p)))")} AS rmse,
  {r("avg(2.0 * abs(a - p) / CASE WHEN abs(a) + abs(p) = 0 THEN 1e-6 ELSE abs(a) + abs(p) END) * 100")} AS smape_legacy,
  {r("sum(2.0 * abs(a - p) / CASE WHEN abs(a) + abs(p) = 0 THEN 1e-6 ELSE abs(a) + abs(p) END * 100 * greatest(a, 0.0)) / CASE WHEN sum(greatest(a, 0.0)) = 0 THEN 1e-6 ELSE sum(greatest(a, 0.0)) END")} AS weighted_smape,
  {r("sqrt(avg((ln(1 + greatest(p, 0.0)) - ln(1 + a)) * (ln(1 + greatest(p, 0.0)) - ln(1 + a))))")} AS rmsle
FROM (SELECT CAST(campaign_week_0 AS BIGINT) AS campaign_week_0, exp(salesQuantityKgL_log) - 1 AS a,
             exp(coalesce(lag(salesQuantityKgL_log, {P.HORIZON + 1}) OVER (PARTITION BY baseItemId ORDER BY week_start), 0.0)) - 1 AS p
      FROM ifilt)
GROUP BY campaign_week_0
"""))
def metrics(spark, sf):
    """E1-E7 of a naive forecast (value h+1 weeks back) against actuals, by row type."""
    f = FE.add_lag_features(_filtered_items(spark, sf), "baseItemId", P.HORIZON)
    a, p = F.expm1(F.col("salesQuantityKgL_log")), F.expm1(F.col("sales_lag_week1"))
    return finalize(f.groupBy(F.col("campaign_week_0").cast("long").alias("is_baseline")).agg(*MT.all_metrics(a, p)))


@register("denormalize", O.with_base(f"""
SELECT f.baseItemId, f.week_start,
       {r("(exp(least(greatest(f.salesQuantityKgL_log, -10.0), 20.0)) - 1) * coalesce(n.normalizer, 1000.0)")} AS kgl
FROM ifilt f LEFT JOIN inorm n ON f.baseItemId = n.baseItemId
"""))
def denormalize(spark, sf):
    """M1: back from the normalised log scale to kg/L."""
    f = _filtered_items(spark, sf).join(_norms(spark, sf), "baseItemId", "left")
    return finalize(f.select("baseItemId", "week_start",
                             FC.denormalize_log(F.col("salesQuantityKgL_log"), F.col("normalizer")).alias("kgl")))


@register("share_logit", O.with_base(f"""
SELECT cluster1To1Id, baseItemId, {r("ln(least(greatest(share, 1e-4), 1 - 1e-4) / (1 - least(greatest(share, 1e-4), 1 - 1e-4)))")} AS share_logit,
       {r("1 / (1 + exp(-ln(least(greatest(share, 1e-4), 1 - 1e-4) / (1 - least(greatest(share, 1e-4), 1 - 1e-4)))))")} AS share_back
FROM bshare
"""))
def share_logit(spark, sf):
    """M2: logit of the baseline share (eps 1e-4) and the sigmoid back."""
    s = WK.item_share_in_cluster(_weekly(spark, sf)[0])
    z = logit(F.col("item_share_in_cluster"))
    return finalize(s.select("cluster1To1Id", "baseItemId", z.alias("share_logit"), sigmoid(z).alias("share_back")))


@register("verdicts")
def verdicts(spark, sf):
    """R2 on observed effects: item effect = mean campaign-week kg/L - median baseline;
    cluster effect likewise on the cluster frame; cluster size from A4."""
    iw, cw = _weekly(spark, sf)
    on = U.on_campaign()
    ie = iw.groupBy("baseItemId", "cluster1To1Id").agg(
        (F.coalesce(F.avg(F.when(on, F.col("salesQuantityKgL"))), F.lit(0.0))
         - F.coalesce(F.median(F.when(F.col("campaign_week_0") == 1, F.col("salesQuantityKgL"))), F.lit(0.0)))
        .alias("item_effect"))
    c_on = (F.col("campaign_week_1") + F.col("campaign_week_2") + F.col("campaign_week_3")) > 0
    ce = cw.groupBy("cluster1To1Id").agg(
        (F.coalesce(F.avg(F.when(c_on, F.col("salesQuantityKgL"))), F.lit(0.0))
         - F.coalesce(F.median(F.when(F.col("campaign_week_0") == 1, F.col("salesQuantityKgL"))), F.lit(0.0)))
        .alias("cluster_effect"))
    j = ie.join(ce, "cluster1To1Id", "left").join(WK.cluster_sizes(iw), "cluster1To1Id", "left")
    j = j.withColumn("cluster_effect", F.coalesce("cluster_effect", F.lit(0.0)))
    return finalize(j.select("baseItemId", "cluster1To1Id", "item_effect", "cluster_effect",
                             R.verdict(F.col("item_effect"), F.col("cluster_effect"),
                                       F.col("num_items_in_cluster")).alias("verdict")))


_SQL["verdicts"] = _wb(f"""
ie AS (
  SELECT baseItemId, cluster1To1Id,
         coalesce(avg(CASE WHEN {ONC} THEN salesQuantityKgL END), 0) - coalesce(median(CASE WHEN campaign_week_0 = 1 THEN salesQuantityKgL END), 0) AS item_effect
  FROM iw0 GROUP BY 1, 2),
ce AS (
  SELECT cluster1To1Id,
         coalesce(avg(CASE WHEN campaign_week_1 + campaign_week_2 + campaign_week_3 > 0 THEN salesQuantityKgL END), 0)
         - coalesce(median(CASE WHEN campaign_week_0 = 1 THEN salesQuantityKgL END), 0) AS cluster_effect
  FROM cw1 GROUP BY 1),
vj AS (
  SELECT i.baseItemId, i.cluster1To1Id, i.item_effect, coalesce(c.cluster_effect, 0.0) AS cluster_effect, s.sz
  FROM ie i LEFT JOIN ce c ON i.cluster1To1Id = c.cluster1To1Id LEFT JOIN csize s ON i.cluster1To1Id = s.cluster1To1Id)
""", f"""
SELECT baseItemId, cluster1To1Id, {r('item_effect')} AS item_effect, {r('cluster_effect')} AS cluster_effect,
  CASE WHEN sz <= 1 THEN (CASE WHEN item_effect > 0 THEN 'Positive (sole)' WHEN item_effect < 0 THEN 'Negative (sole)' ELSE 'Neutral (sole)' END)
       WHEN item_effect > 0 AND cluster_effect > 0 THEN (CASE WHEN item_effect > cluster_effect * 0.8 THEN 'Halo' ELSE 'Positive' END)
       WHEN item_effect > 0 AND cluster_effect < 0 THEN 'Cannibalization'
       WHEN item_effect < 0 THEN 'Negative' ELSE 'Neutral' END AS verdict
FROM vj
""")


# --- T6-T8 forecast plan, P19 campaign selection ------------------------------------------

@register("forecast_plan", O.with_base(f"""
SELECT c.campaignId, c.campaignStart - 28 AS forecast_date,
       CAST(date_diff('day', c.campaignStart - 28, c.campaignStart) // 7 AS BIGINT) AS horizon_weeks,
       CAST(c.campaignStart + 20 AS DATE) AS campaign_end,
       CAST(c.campaignStart - 28 - CAST(((((isodow(c.campaignStart - 28) - isodow(c.campaignStart)) % 7) + 7) % 7 + 7) AS INTEGER) AS DATE) AS cutoff_week,
       CAST(w AS BIGINT) AS campaign_week, CAST(c.campaignStart + 7 * (w - 1) AS DATE) AS week_start,
       CAST(weekofyear(c.campaignStart + 7 * (w - 1)) AS BIGINT) AS week_of_year,
       {r('sin(2 * pi() * weekofyear(c.campaignStart + 7 * (w - 1)) / 52)')} AS week_of_year_sin,
       {r('cos(2 * pi() * weekofyear(c.campaignStart + 7 * (w - 1)) / 52)')} AS week_of_year_cos
FROM cal c, (VALUES (1), (2), (3)) t(w)
"""))
def forecast_plan(spark, sf):
    """T6-T8 per campaign: forecast date 4 weeks ahead, horizon, end, last complete
    aligned week and the three future weeks with their time features."""
    c = FX.campaigns(spark, sf)
    fd = F.date_sub("campaignStart", 28)
    back = F.pmod(F.weekday(fd) - F.weekday("campaignStart"), F.lit(7)) + 7
    wk = F.explode(F.array(F.lit(1), F.lit(2), F.lit(3))).alias("campaign_week")
    p = c.select("campaignId", fd.alias("forecast_date"),
                 F.floor(F.datediff("campaignStart", fd) / 7).cast("long").alias("horizon_weeks"),
                 F.date_add("campaignStart", 20).alias("campaign_end"),
                 F.date_sub(fd, back.cast("int")).alias("cutoff_week"), "campaignStart", wk)
    p = p.withColumn("week_start", F.date_add("campaignStart", (F.col("campaign_week") - 1) * 7))
    return finalize(p.select("campaignId", "forecast_date", "horizon_weeks", "campaign_end", "cutoff_week",
                             "campaign_week", "week_start", F.weekofyear("week_start").alias("week_of_year"),
                             F.sin(F.lit(2 * math.pi) * F.weekofyear("week_start") / 52).alias("week_of_year_sin"),
                             F.cos(F.lit(2 * math.pi) * F.weekofyear("week_start") / 52).alias("week_of_year_cos")))


@register("backtest_campaigns", O.with_base(f"""
SELECT campaignId, campaignStart, campaignEnd FROM cal
WHERE year(campaignStart) = {P.BACKTEST_YEAR} AND year(campaignEnd) = {P.BACKTEST_YEAR}
"""))
def backtest_campaigns(spark, sf):
    """Campaigns whose start and end both fall in the backtest year."""
    c = FX.campaigns(spark, sf)
    return finalize(c.where((F.year("campaignStart") == P.BACKTEST_YEAR) & (F.year("campaignEnd") == P.BACKTEST_YEAR)))


# --- first generation: A9 ----------------------------------------------------------------

@register("legacy_weekly_orders", _wb(f"""
lw AS (SELECT *, {O.wk('orderDate', 0)} AS ow FROM valid),
sums AS (SELECT itemId, ow, sum(salesQuantity) AS q FROM lw GROUP BY 1, 2),
span AS (SELECT itemId, min(ow) AS a, max(ow) AS b FROM sums GROUP BY 1),
grid AS (SELECT itemId, CAST(unnest(generate_series(CAST(a AS TIMESTAMP), CAST(b AS TIMESTAMP), INTERVAL 7 DAY)) AS DATE) AS ow FROM span),
cnt AS (SELECT itemId, ow, salesCampignId, count(*) AS n FROM lw WHERE salesCampignId IS NOT NULL AND salesCampignId <> 0 GROUP BY 1, 2, 3),
md AS (SELECT itemId, ow, salesCampignId FROM cnt QUALIFY row_number() OVER (PARTITION BY itemId, ow ORDER BY n DESC, salesCampignId) = 1)
""", f"""
SELECT g.ow AS orderDate, g.itemId, {r('coalesce(s.q, 0.0)')} AS salesQuantity, CAST(coalesce(m.salesCampignId, 0) AS BIGINT) AS salesCampignId
FROM grid g LEFT JOIN sums s ON g.itemId = s.itemId AND g.ow = s.ow LEFT JOIN md m ON g.itemId = m.itemId AND g.ow = m.ow
"""))
def legacy_weekly_orders(spark, sf):
    return finalize(WK.legacy_weekly_orders(U.valid_orders(FX.fact_order(spark, sf))))
