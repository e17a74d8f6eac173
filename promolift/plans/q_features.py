"""Registered queries: feature layer."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import features as FE
from ..operators import weekly as WK
from . import oracle as O
from . import params as P
from .registry import _filtered_items, _pre, _weekly, finalize, register

r = O.r
ONC = "(campaign_week_1 = 1 OR campaign_week_2 = 1 OR campaign_week_3 = 1)"


def _cluster_normed(spark, sf):
    _, cw = _weekly(spark, sf)
    g = WK.mark_post_campaign_weeks(WK.fill_missing_weeks(cw, "cluster1To1Id", int_flags=False), "cluster1To1Id")
    n, _ = FE.normalize(g, "cluster1To1Id")
    return n


def _cluster_lagged(spark, sf):
    return FE.add_cluster_aliases(FE.add_lag_features(_cluster_normed(spark, sf), "cluster1To1Id", P.HORIZON))


LAGS = ["sales_lag_week1", "sales_rolling_4w_week1", "sales_lag_week2", "sales_rolling_4w_week2",
        "sales_lag_week3", "sales_rolling_4w_week3", "sales_lag_12w", "sales_lag_52w"]

CLAGS_SQL = f"""
clag AS (SELECT cluster1To1Id, week_start, {O.lag_cols('cluster1To1Id', 4)} FROM cnormed)
"""


def _wb(extra_ctes: str, final: str) -> str:
    """Base CTE chain + extra CTEs + final select."""
    return O.with_base(", " + extra_ctes.strip() + "\n" + final) if extra_ctes else O.with_base(final)


@register("cluster_lag_features", _wb(CLAGS_SQL, f"""
SELECT cluster1To1Id, week_start, {', '.join(r(c) + ' AS ' + c for c in LAGS)} FROM clag
"""))
def cluster_lag_features(spark, sf):
    return finalize(_cluster_lagged(spark, sf).select("cluster1To1Id", "week_start", *LAGS))


@register("item_cluster_context", _wb(CLAGS_SQL, f"""
SELECT i.baseItemId, i.week_start, i.cluster1To1Id,
       {', '.join(r(f'coalesce(c.sales_{k}, 0.0)') + f' AS cluster_sales_{k}' for k in
                  ['lag_week1', 'lag_week2', 'lag_week3', 'rolling_4w_week1', 'rolling_4w_week2', 'rolling_4w_week3'])}
FROM ifilt i LEFT JOIN clag c ON i.cluster1To1Id = c.cluster1To1Id AND i.week_start = c.week_start
"""))
def item_cluster_context(spark, sf):
    j = FE.add_cluster_context(_filtered_items(spark, sf), _cluster_lagged(spark, sf))
    return finalize(j.select("baseItemId", "week_start", "cluster1To1Id", *FE.CLUSTER_CONTEXT))


@register("campaign_item_share", _wb("""
camp AS (SELECT baseItemId, cluster1To1Id, week_start FROM ifilt WHERE (campaign_week_1 = 1 OR campaign_week_2 = 1 OR campaign_week_3 = 1)),
bl AS (SELECT baseItemId, cluster1To1Id, week_start, salesQuantityKgL_log AS v FROM ifilt WHERE campaign_week_0 = 1),
shr AS (
  SELECT c.cluster1To1Id, c.week_start, c.baseItemId,
         coalesce((SELECT sum(b.v) FROM bl b WHERE b.baseItemId = c.baseItemId AND b.week_start < c.week_start
                   AND b.week_start >= c.week_start - 84), 0.0) AS item_recent,
         coalesce((SELECT sum(b.v) FROM bl b WHERE b.cluster1To1Id = c.cluster1To1Id AND b.week_start < c.week_start
                   AND b.week_start >= c.week_start - 84), 0.0) AS cluster_recent
  FROM camp c)
""", f"""
SELECT cluster1To1Id, week_start, baseItemId, {r('item_recent')} AS item_recent, {r('cluster_recent')} AS cluster_recent,
       {r('CASE WHEN cluster_recent > 0 THEN item_recent / cluster_recent ELSE 0.0 END')} AS campaign_item_share
FROM shr
"""))
def campaign_item_share(spark, sf):
    return finalize(FE.campaign_item_share(_filtered_items(spark, sf)))


CAT_SQL = """
icat AS (
  SELECT f.*, m.categoryLevel1Id, m.categoryLevel2Id, m.categoryLevel3Id, m.categoryLevel4Id
  FROM ifilt f LEFT JOIN master m ON f.baseItemId = m.baseItemId),
ibl AS (SELECT baseItemId, median(salesQuantityKgL_log) AS bl FROM icat WHERE campaign_week_0 = 1 GROUP BY baseItemId),
obs AS (
  SELECT c.*, c.salesQuantityKgL_log - b.bl AS lift FROM icat c LEFT JOIN ibl b ON c.baseItemId = b.baseItemId
  WHERE (c.campaign_week_1 = 1 OR c.campaign_week_2 = 1 OR c.campaign_week_3 = 1)),
lv1 AS (SELECT categoryLevel1Id, avg(lift) AS m, count(lift) AS n FROM obs WHERE categoryLevel1Id IS NOT NULL GROUP BY 1),
lv2 AS (SELECT categoryLevel2Id, avg(lift) AS m, count(lift) AS n FROM obs WHERE categoryLevel2Id IS NOT NULL GROUP BY 1),
lv3 AS (SELECT categoryLevel3Id, avg(lift) AS m, count(lift) AS n FROM obs WHERE categoryLevel3Id IS NOT NULL GROUP BY 1),
lv4 AS (SELECT categoryLevel4Id, avg(lift) AS m, count(lift) AS n FROM obs WHERE categoryLevel4Id IS NOT NULL GROUP BY 1),
cl0 AS (
  SELECT i.baseItemId, i.week_start, i.categoryLevel4Id,
         coalesce(a.m, 0.0) AS cat_lift_l1, coalesce(b.m, 0.0) AS cat_lift_l2, coalesce(c.m, 0.0) AS cat_lift_l3,
         coalesce(d.m, 0.0) AS cat_lift_l4,
         coalesce(b.n, 0)::DOUBLE AS n2, coalesce(c.n, 0)::DOUBLE AS n3, coalesce(d.n, 0) AS cat_n_obs_l4
  FROM icat i LEFT JOIN lv1 a ON i.categoryLevel1Id = a.categoryLevel1Id
  LEFT JOIN lv2 b ON i.categoryLevel2Id = b.categoryLevel2Id
  LEFT JOIN lv3 c ON i.categoryLevel3Id = c.categoryLevel3Id
  LEFT JOIN lv4 d ON i.categoryLevel4Id = d.categoryLevel4Id),
cl1 AS (SELECT *, (1 - n2 / (n2 + 10)) * cat_lift_l1 + n2 / (n2 + 10) * cat_lift_l2 AS b2 FROM cl0),
cl2 AS (SELECT *, (1 - n3 / (n3 + 10)) * b2 + n3 / (n3 + 10) * cat_lift_l3 AS b3 FROM cl1),
cl3 AS (SELECT *, (1 - cat_n_obs_l4::DOUBLE / (cat_n_obs_l4 + 10)) * b3
                 + cat_n_obs_l4::DOUBLE / (cat_n_obs_l4 + 10) * cat_lift_l4 AS best_cat_lift FROM cl2),
cw4 AS (SELECT DISTINCT categoryLevel4Id, week_start FROM obs WHERE categoryLevel4Id IS NOT NULL),
cw4s AS (
  SELECT *, CASE WHEN lag(week_start) OVER (PARTITION BY categoryLevel4Id ORDER BY week_start) IS NULL
                   OR date_diff('day', lag(week_start) OVER (PARTITION BY categoryLevel4Id ORDER BY week_start), week_start) > 21
                 THEN 1 ELSE 0 END AS new_c
  FROM cw4),
rec AS (
  SELECT k.categoryLevel4Id, k.week_start,
         (SELECT max(s.week_start) FROM cw4s s WHERE s.categoryLevel4Id = k.categoryLevel4Id AND s.week_start < k.week_start) AS lastw,
         (SELECT sum(s.new_c) FROM cw4s s WHERE s.categoryLevel4Id = k.categoryLevel4Id AND s.week_start < k.week_start) AS ncamp
  FROM (SELECT DISTINCT categoryLevel4Id, week_start FROM icat) k),
catfeat AS (
  SELECT c.baseItemId, c.week_start, c.cat_lift_l1, c.cat_lift_l2, c.cat_lift_l3, c.cat_lift_l4, c.best_cat_lift,
         CAST(c.cat_n_obs_l4 AS BIGINT) AS cat_n_obs_l4,
         CAST(CASE WHEN r.lastw IS NULL THEN 104 ELSE date_diff('day', r.lastw, c.week_start) // 7 END AS BIGINT)
             AS weeks_since_last_campaign_l4,
         CAST(coalesce(r.ncamp, 0) AS BIGINT) AS n_campaigns_historical_l4
  FROM cl3 c LEFT JOIN rec r ON c.categoryLevel4Id = r.categoryLevel4Id AND c.week_start = r.week_start)
"""

CAT_COLS = ["cat_lift_l1", "cat_lift_l2", "cat_lift_l3", "cat_lift_l4", "best_cat_lift"]


@register("category_lift", _wb(CAT_SQL, f"""
SELECT 'L1' AS level, categoryLevel1Id AS category, {r('m')} AS mean_lift, n AS n_obs FROM lv1
UNION ALL SELECT 'L2', categoryLevel2Id, {r('m')}, n FROM lv2
UNION ALL SELECT 'L3', categoryLevel3Id, {r('m')}, n FROM lv3
UNION ALL SELECT 'L4', categoryLevel4Id, {r('m')}, n FROM lv4
"""))
def category_lift(spark, sf):
    from ..operators.universe import item_master
    from ..sources import fixtures as FX
    observed = FE.campaign_deviations(_filtered_items(spark, sf), item_master(FX.dim_item(spark, sf)))
    lifts = FE.category_lifts(observed)
    return finalize(lifts.select(F.concat(F.lit("L"), F.col("level").cast("string")).alias("level"), "category", "mean_lift", "n_obs"))


def _cat_features(spark, sf):
    from ..operators.universe import item_master
    from ..sources import fixtures as FX
    return FE.add_category_lift_features(_filtered_items(spark, sf), item_master(FX.dim_item(spark, sf)))


@register("shrunk_category_lift", _wb(CAT_SQL, f"""
SELECT baseItemId, week_start, {', '.join(r(c) + ' AS ' + c for c in CAT_COLS)}, cat_n_obs_l4 FROM catfeat
"""))
def shrunk_category_lift(spark, sf):
    return finalize(_cat_features(spark, sf).select("baseItemId", "week_start", *CAT_COLS, "cat_n_obs_l4"))


@register("category_recency", _wb(CAT_SQL, """
SELECT baseItemId, week_start, weeks_since_last_campaign_l4, n_campaigns_historical_l4 FROM catfeat
"""))
def category_recency(spark, sf):
    return finalize(_cat_features(spark, sf).select("baseItemId", "week_start", "weeks_since_last_campaign_l4",
                                                    "n_campaigns_historical_l4"))


# --- C4: the whole preprocessing, selected columns -------------------------------------

ITEM_FEATURES = ["baseItemId", "week_start", "cluster1To1Id", "campaign_week_0", "campaign_week_1",
                 "campaign_week_2", "campaign_week_3", "salesQuantityKgL_log", "n_campaign_items_in_cluster",
                 "campaign_coverage", "item_share_in_cluster", "coverage_x_share", "best_cat_lift",
                 "cat_n_obs_l4", "weeks_since_last_campaign_l4", "n_campaigns_historical_l4",
                 "week_of_year", "week_of_year_sin", "sales_lag_week1", "sales_rolling_4w_week2",
                 "sales_lag_week3", "sales_lag_52w", "cluster_sales_lag_week1", "cluster_sales_rolling_4w_week3"]

ITEM_FEATURES_SQL = CAT_SQL + "," + CLAGS_SQL + f""",
ilag AS (SELECT baseItemId, week_start, {O.lag_cols('baseItemId', 4)} FROM ifilt),
ifeat AS (
  SELECT f.baseItemId, f.week_start, f.cluster1To1Id, f.campaign_week_0, f.campaign_week_1, f.campaign_week_2,
         f.campaign_week_3, f.salesQuantityKgL_log, f.n_campaign_items_in_cluster, f.campaign_coverage,
         f.item_share_in_cluster, f.coverage_x_share, c.best_cat_lift, c.cat_n_obs_l4,
         c.weeks_since_last_campaign_l4, c.n_campaigns_historical_l4,
         weekofyear(f.week_start) AS week_of_year, sin(2 * pi() * weekofyear(f.week_start) / 52) AS week_of_year_sin,
         l.sales_lag_week1, l.sales_rolling_4w_week2, l.sales_lag_week3, l.sales_lag_52w,
         coalesce(g.sales_lag_week1, 0.0) AS cluster_sales_lag_week1,
         coalesce(g.sales_rolling_4w_week3, 0.0) AS cluster_sales_rolling_4w_week3
  FROM ifilt f
  JOIN catfeat c ON f.baseItemId = c.baseItemId AND f.week_start = c.week_start
  JOIN ilag l ON f.baseItemId = l.baseItemId AND f.week_start = l.week_start
  LEFT JOIN clag g ON f.cluster1To1Id = g.cluster1To1Id AND f.week_start = g.week_start)
"""


def _sel(cols, ints=()):
    out = []
    for c in cols:
        if c in ("baseItemId", "cluster1To1Id", "week_start"):
            out.append(c)
        elif c in ints:
            out.append(f"CAST({c} AS BIGINT) AS {c}")
        else:
            out.append(f"{r(c)} AS {c}")
    return ", ".join(out)


ITEM_INTS = ("campaign_week_0", "campaign_week_1", "campaign_week_2", "campaign_week_3",
             "n_campaign_items_in_cluster", "cat_n_obs_l4", "weeks_since_last_campaign_l4",
             "n_campaigns_historical_l4", "week_of_year")


@register("item_features", _wb(ITEM_FEATURES_SQL, f"SELECT {_sel(ITEM_FEATURES, ITEM_INTS)} FROM ifeat"))
def item_features(spark, sf):
    pre = _pre(spark, sf)
    return finalize(pre.item_weekly.select(*ITEM_FEATURES))


CLUSTER_FEATURES = ["cluster1To1Id", "week_start", "baseItemId", "campaign_week_0", "campaign_week_1",
                    "campaign_week_2", "campaign_week_3", "salesQuantityKgL_log", "week_of_year",
                    "week_of_year_cos", "cluster_sales_lag_week1", "cluster_sales_rolling_4w_week1",
                    "cluster_sales_lag_week3", "sales_lag_12w", "num_items_in_cluster"]


@register("cluster_features", _wb(CLAGS_SQL + """,
nitems AS (SELECT cluster1To1Id, count(DISTINCT baseItemId) AS n FROM ifilt WHERE cluster1To1Id IS NOT NULL GROUP BY 1),
cfeat AS (
  SELECT c.cluster1To1Id, c.week_start, c.baseItemId, c.campaign_week_0, c.campaign_week_1, c.campaign_week_2,
         c.campaign_week_3, c.salesQuantityKgL_log, weekofyear(c.week_start) AS week_of_year,
         cos(2 * pi() * weekofyear(c.week_start) / 52) AS week_of_year_cos,
         g.sales_lag_week1 AS cluster_sales_lag_week1, g.sales_rolling_4w_week1 AS cluster_sales_rolling_4w_week1,
         g.sales_lag_week3 AS cluster_sales_lag_week3, g.sales_lag_12w,
         coalesce(n.n, 1) AS num_items_in_cluster
  FROM cnormed c JOIN clag g ON c.cluster1To1Id = g.cluster1To1Id AND c.week_start = g.week_start
  LEFT JOIN nitems n ON c.cluster1To1Id = n.cluster1To1Id)
""", f"""
SELECT cluster1To1Id, week_start, baseItemId, {_sel(CLUSTER_FEATURES[3:], ('week_of_year', 'num_items_in_cluster'))}
FROM cfeat
"""))
def cluster_features(spark, sf):
    pre = _pre(spark, sf)
    return finalize(pre.cluster_weekly.select(*CLUSTER_FEATURES))


@register("weekly_cluster_sales_truncated", O.with_base(f"""
SELECT cluster1To1Id, week_start, {r('floor(campaign_week_0)')} AS campaign_week_0,
       {r('floor(campaign_week_1)')} AS campaign_week_1, {r('floor(campaign_week_2)')} AS campaign_week_2,
       {r('floor(campaign_week_3)')} AS campaign_week_3
FROM cw1
"""))
def weekly_cluster_sales_truncated(spark, sf):
    """Q1: the 'truncate' intensity option (only full intensity survives)."""
    from .preprocess import tagged_orders
    from ..sources import fixtures as FX
    inp = FX.load_inputs(spark, sf)
    t, _ = tagged_orders(inp.orders, inp.items, inp.campaigns, P.CAMPAIGN_START)
    cw = WK.weekly_cluster_sales(WK.weekly_item_sales(t), intensity="truncate")
    return finalize(cw.select("cluster1To1Id", "week_start", "campaign_week_0", "campaign_week_1",
                              "campaign_week_2", "campaign_week_3"))
