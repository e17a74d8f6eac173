"""Registered queries: older-generation operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import scenario as S
from ..operators import training as TR
from ..operators import universe as U
from . import oracle as O
from . import params as P
from .forecast_job import campaign_items
from .registry import _filtered_items, _inputs, _tagged, _weekly, finalize, register
from .registry import SQL as _SQL

r = O.r
ONC = "(campaign_week_1 = 1 OR campaign_week_2 = 1 OR campaign_week_3 = 1)"


def _wb(extra: str, final: str) -> str:
    return O.with_base(", " + extra.strip() + "\n" + final)


W8_SQL = f"""
w8a AS (SELECT baseItemId, cluster1To1Id, week_start, greatest(salesQuantityKgL, 0.0) AS v,
               CAST({ONC} AS INTEGER) AS onc FROM iw1),
w8t AS (SELECT cluster1To1Id, week_start, sum(v) AS tot, sum(onc) AS n_on FROM w8a GROUP BY 1, 2),
w8 AS (
  SELECT a.baseItemId, a.cluster1To1Id, a.week_start, a.v AS item_sales, a.v / greatest(t.tot, 1e-6) AS item_share,
         CAST(t.n_on > 0 AND a.onc = 0 AS INTEGER) AS other_campaign_in_cluster
  FROM w8a a JOIN w8t t ON a.cluster1To1Id = t.cluster1To1Id AND a.week_start = t.week_start),
w8l AS (
  SELECT *, coalesce(lag(item_sales, 1) OVER (PARTITION BY baseItemId ORDER BY week_start), 0.0) AS item_sales_lag_1,
         coalesce(lag(item_share, 1) OVER (PARTITION BY baseItemId ORDER BY week_start), 0.0) AS item_share_lag_1 FROM w8)
"""


@register("item_share_frame", _wb(W8_SQL, f"""
SELECT baseItemId, cluster1To1Id, week_start, {r('item_sales')} AS item_sales, {r('item_share')} AS item_share,
       CAST(other_campaign_in_cluster AS BIGINT) AS other_campaign_in_cluster,
       {r('item_sales_lag_1')} AS item_sales_lag_1, {r('item_share_lag_1')} AS item_share_lag_1
FROM w8l
"""))
def item_share_frame(spark, sf):
    return finalize(S.item_share_frame(_weekly(spark, sf)[0]))


@register("share_renormalized", _wb(W8_SQL + """,
ps AS (SELECT cluster1To1Id, week_start, baseItemId, coalesce(item_share_lag_1, 0.0) AS pred_share FROM w8l),
pt AS (SELECT cluster1To1Id, week_start, sum(pred_share) AS s FROM ps GROUP BY 1, 2)
""", f"""
SELECT p.cluster1To1Id, p.week_start, p.baseItemId,
       {r('CASE WHEN t.s > 1 THEN p.pred_share / t.s ELSE p.pred_share END')} AS pred_share
FROM ps p JOIN pt t ON p.cluster1To1Id = t.cluster1To1Id AND p.week_start = t.week_start
"""))
def share_renormalized(spark, sf):
    """W16 on last week's shares used as the predicted shares."""
    f = S.item_share_frame(_weekly(spark, sf)[0])
    p = f.select("cluster1To1Id", "week_start", "baseItemId",
                 F.coalesce(F.col("item_share_lag_1"), F.lit(0.0)).alias("pred_share"))
    return finalize(S.renormalize_shares(p))


@register("what_if_scenarios", O.with_base(f"""
SELECT s AS scenario,
       CAST(CASE WHEN k.baseItemId IN (SELECT regexp_replace(itemId, '^[MSK]', '') FROM valid WHERE salesCampignId = 69)
                      AND k.orderDate BETWEEN DATE '{P.CAMPAIGN_START}' AND DATE '{P.CAMPAIGN_END}' THEN s
                 ELSE CAST(k.salesCampignId IS NOT NULL AS INTEGER) END AS BIGINT) AS is_campaign_week,
       count(*) AS n_lines, {r('sum(k.salesQuantityKgL)')} AS kgl
FROM kgl k, (VALUES (0), (1)) t(s)
GROUP BY 1, 2
"""))
def what_if_scenarios(spark, sf):
    """C7 for the forecast campaign's items over its window."""
    inp = _inputs(spark, sf)
    from ..operators.weekly import orders_kgl
    k = orders_kgl(U.valid_orders(inp.orders), U.item_master(inp.items))
    s = S.what_if_scenarios(k, campaign_items(inp.orders, 69), P.CAMPAIGN_START, P.CAMPAIGN_END)
    return finalize(s.groupBy(F.col("scenario").cast("long").alias("scenario"), "is_campaign_week")
                    .agg(F.count("*").alias("n_lines"), F.sum("salesQuantityKgL").alias("kgl")))


@register("campaign_item_rows", O.with_base(f"""
SELECT i.baseItemId, i.week_start, {r('i.salesQuantityKgL')} AS salesQuantityKgL FROM iw1 i
WHERE (i.baseItemId, i.week_start) IN (SELECT DISTINCT baseItemId, week_start FROM tagged_f WHERE cwn > 0)
"""))
def campaign_item_rows(spark, sf):
    """weekly rows of the (week, item) pairs that carry campaign lines."""
    t, _ = _tagged(spark, sf)
    flags = t.where(F.col("campaign_week_0") == 0).select("baseItemId", "week_start")
    return finalize(S.campaign_item_rows(_weekly(spark, sf)[0], flags)
                    .select("baseItemId", "week_start", "salesQuantityKgL"))


@register("uplift_fallback", _wb(f"""
ui AS (SELECT baseItemId, cluster1To1Id, CAST(sum(CASE WHEN {ONC} THEN 1 ELSE 0 END) AS BIGINT) AS icw,
              avg(CASE WHEN campaign_week_0 = 1 THEN salesQuantityKgL END) AS ib FROM iw1 GROUP BY 1, 2),
uc AS (SELECT cluster1To1Id,
              CAST(sum(CASE WHEN campaign_week_1 + campaign_week_2 + campaign_week_3 > 0 THEN 1 ELSE 0 END) AS BIGINT) AS ccw,
              avg(CASE WHEN campaign_week_1 + campaign_week_2 + campaign_week_3 > 0 THEN salesQuantityKgL END) AS c,
              avg(CASE WHEN campaign_week_0 = 1 THEN salesQuantityKgL END) AS b FROM cw1 GROUP BY 1),
uj AS (SELECT i.*, u.ccw, CASE WHEN u.b > 0 THEN coalesce(u.c, u.b) / u.b ELSE 1.0 END AS ratio
       FROM ui i LEFT JOIN uc u ON i.cluster1To1Id = u.cluster1To1Id)
""", f"""
SELECT baseItemId, cluster1To1Id, icw AS item_campaign_weeks, ccw AS cluster_campaign_weeks, {r('ib')} AS item_baseline,
       {r('ratio')} AS uplift_ratio,
       CASE WHEN icw >= 3 THEN 'item' WHEN coalesce(ccw, 0) >= 10 THEN 'cluster' ELSE 'global' END AS level,
       {r('CASE WHEN icw < 3 THEN coalesce(ib, 0.0) * ratio END')} AS fallback_campaign_kgl
FROM uj
"""))
def uplift_fallback(spark, sf):
    iw, cw = _weekly(spark, sf)
    return finalize(S.uplift_fallback(iw, cw))


@register("recent_history", O.with_base(f"""
SELECT baseItemId, {r('avg(salesQuantityKgL)')} AS recent_mean, {r('median(salesQuantityKgL)')} AS recent_median,
       {r('max(salesQuantityKgL)')} AS recent_max, count(*) AS recent_weeks,
       CAST(count(*) > count(DISTINCT week_start) AS BIGINT) AS several_rows_per_week
FROM (SELECT * FROM iw1 QUALIFY row_number() OVER (PARTITION BY baseItemId ORDER BY week_start DESC) <= 12)
GROUP BY baseItemId
"""))
def recent_history(spark, sf):
    """A15 on the item weekly roll-up."""
    return finalize(S.recent_history(_weekly(spark, sf)[0], "baseItemId", "salesQuantityKgL"))


def _a16_sql():
    parts = []
    for k in (1, 2, 3):
        parts.append(f"""
  SELECT {k} AS model_week, true AS is_campaign, salesQuantityKgL_log FROM ifilt WHERE campaign_week_{k} = 1
  UNION ALL
  SELECT {k}, false, salesQuantityKgL_log FROM (
    SELECT * FROM ifilt
    WHERE baseItemId IN (SELECT baseItemId FROM ifilt WHERE campaign_week_{k} = 1)
      AND campaign_week_{k} = 0 AND campaign_week_0 = 1
    QUALIFY row_number() OVER (ORDER BY week_start DESC, baseItemId) <= 5 * (SELECT count(*) FROM ifilt WHERE campaign_week_{k} = 1))""")
    return "a16 AS (" + "\n  UNION ALL".join(parts) + ")"


@register("train_balance_stats", _wb(_a16_sql(), f"""
SELECT CAST(model_week AS BIGINT) AS model_week,
       {r('avg(CASE WHEN is_campaign THEN salesQuantityKgL_log END)')} AS campaign_mean,
       {r('avg(CASE WHEN NOT is_campaign THEN salesQuantityKgL_log END)')} AS baseline_mean,
       CAST(sum(CASE WHEN is_campaign THEN 1 ELSE 0 END) AS BIGINT) AS n_campaign,
       CAST(sum(CASE WHEN NOT is_campaign THEN 1 ELSE 0 END) AS BIGINT) AS n_baseline,
       {r('avg(CASE WHEN is_campaign THEN salesQuantityKgL_log END) / avg(CASE WHEN NOT is_campaign THEN salesQuantityKgL_log END)')} AS ratio
FROM a16 GROUP BY model_week
"""))
def train_balance_stats(spark, sf):
    """A16 over the three balanced week samples."""
    f = _filtered_items(spark, sf)
    parts = []
    for k in (1, 2, 3):
        s = TR.balanced_sample(f, "item", k)
        parts.append(s.select(F.lit(k).alias("model_week"), (F.col(f"campaign_week_{k}") == 1).alias("is_campaign"),
                              "salesQuantityKgL_log"))
    u = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return finalize(S.train_balance_stats(u))


@register("request_rejections")
def request_rejections(spark, sf):
    """F12 [rows]: one forecast request per calendar campaign (its items, forecast date
    7*(id mod 16) days before the start), checked against the item master; 'today' is
    the last order date.  Rejected requests with their first failing reason."""
    inp = _inputs(spark, sf)
    v = U.valid_orders(inp.orders).where(F.col("salesCampignId").isNotNull())
    ids = (v.select(F.col("salesCampignId").alias("campaignId"), U.base_item_id(F.col("itemId")).alias("b"))
           .distinct().groupBy("campaignId").agg(F.concat_ws(",", F.array_sort(F.collect_set("b"))).alias("item_ids")))
    req = (inp.campaigns.join(ids, "campaignId", "left")
           .select(F.col("campaignId").cast("string").alias("request_id"),
                   F.coalesce("item_ids", F.lit("")).alias("item_ids"),
                   F.date_sub("campaignStart", (F.col("campaignId") % 16 * 7).cast("int")).cast("string")
                   .alias("forecast_date"),
                   F.col("campaignStart").cast("string").alias("campaign_start")))
    today = inp.orders.agg(F.max("orderDate")).first()[0]
    return finalize(U.request_rejections(req, inp.items, today=today))


# --- first generation: C5, C6, W6, W7, A8; second generation: A10 ------------------------

G1_SQL = f"""
lw AS (SELECT *, {O.wk('orderDate', 0)} AS ow FROM valid),
sums AS (SELECT itemId, ow, sum(salesQuantity) AS q FROM lw GROUP BY 1, 2),
span AS (SELECT itemId, min(ow) AS a, max(ow) AS b FROM sums GROUP BY 1),
grid AS (SELECT itemId, CAST(unnest(generate_series(CAST(a AS TIMESTAMP), CAST(b AS TIMESTAMP), INTERVAL 7 DAY)) AS DATE) AS ow FROM span),
cnt AS (SELECT itemId, ow, salesCampignId, count(*) AS n FROM lw WHERE salesCampignId IS NOT NULL AND salesCampignId <> 0 GROUP BY 1, 2, 3),
md AS (SELECT itemId, ow, salesCampignId FROM cnt QUALIFY row_number() OVER (PARTITION BY itemId, ow ORDER BY n DESC, salesCampignId) = 1),
lwo AS (
  SELECT g.ow AS orderDate, g.itemId, coalesce(s.q, 0.0) AS salesQuantity, CAST(coalesce(m.salesCampignId, 0) AS BIGINT) AS salesCampignId
  FROM grid g LEFT JOIN sums s ON g.itemId = s.itemId AND g.ow = s.ow LEFT JOIN md m ON g.itemId = m.itemId AND g.ow = m.ow),
licc AS (
  SELECT DISTINCT w.itemId, c.campaignId, c.campaignStart AS s, c.campaignEnd AS e
  FROM lwo w JOIN cal c ON w.salesCampignId = c.campaignId WHERE w.salesCampignId <> 0),
litems AS (
  SELECT itemId, CASE WHEN cluster1To1Id IS NULL OR trim(cluster1To1Id) = '' THEN itemId ELSE cluster1To1Id END AS cluster1To1Id,
         coalesce(CASE WHEN wprep <> 0 THEN wprep END, CASE WHEN wnet <> 0 THEN wnet END, wgross) AS weight
  FROM dim QUALIFY row_number() OVER (PARTITION BY itemId ORDER BY itemSkey DESC) = 1),
lp0 AS (
  SELECT w.orderDate, w.itemId, i.cluster1To1Id, w.salesCampignId, w.salesQuantity * i.weight AS salesQuantityKgL,
         CAST(coalesce(w.orderDate >= c.s AND w.orderDate <= c.e, false) AS INTEGER) AS is_campaign_week
  FROM lwo w LEFT JOIN litems i ON w.itemId = i.itemId
  LEFT JOIN licc c ON w.itemId = c.itemId AND w.salesCampignId = c.campaignId),
lp AS (
  SELECT *, coalesce(lag(salesQuantityKgL) OVER (PARTITION BY cluster1To1Id ORDER BY orderDate, itemId), 0.0) AS cluster_sales_lag_1,
         avg(salesQuantityKgL) OVER (PARTITION BY cluster1To1Id ORDER BY orderDate, itemId ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING) AS cluster_sales_rolling4w,
         sum(CASE WHEN is_campaign_week <> 1 THEN 1 ELSE 0 END) OVER (PARTITION BY cluster1To1Id ORDER BY orderDate, itemId ROWS UNBOUNDED PRECEDING) AS weeks_since_campaign,
         sum(is_campaign_week) OVER (PARTITION BY cluster1To1Id ORDER BY orderDate, itemId ROWS UNBOUNDED PRECEDING) AS campaigns_ytd
  FROM lp0)
"""


def _g1(spark, sf, as_of=None):
    from ..operators.legacy import legacy_processed
    from ..session import cut_lineage
    inp = _inputs(spark, sf)
    return cut_lineage(legacy_processed(U.valid_orders(inp.orders), inp.items, inp.campaigns, as_of), "g1")


@register("legacy_cluster_lags", _wb(G1_SQL, f"""
SELECT orderDate, itemId, cluster1To1Id, {r('salesQuantityKgL')} AS salesQuantityKgL,
       {r('cluster_sales_lag_1')} AS cluster_sales_lag_1, {r('cluster_sales_rolling4w')} AS cluster_sales_rolling4w
FROM lp
"""))
def legacy_cluster_lags(spark, sf):
    """Row-based cluster lag / rolling mean of the first generation."""
    return finalize(_g1(spark, sf).select("orderDate", "itemId", "cluster1To1Id", "salesQuantityKgL",
                                          "cluster_sales_lag_1", "cluster_sales_rolling4w"))


@register("legacy_campaign_counters", _wb(G1_SQL, """
SELECT orderDate, itemId, cluster1To1Id, CAST(is_campaign_week AS BIGINT) AS is_campaign_week,
       CAST(weeks_since_campaign AS BIGINT) AS weeks_since_campaign, CAST(campaigns_ytd AS BIGINT) AS campaigns_ytd
FROM lp
"""))
def legacy_campaign_counters(spark, sf):
    """Running counters over the cluster's rows."""
    return finalize(_g1(spark, sf).select("orderDate", "itemId", "cluster1To1Id", "is_campaign_week",
                                          "weeks_since_campaign", "campaigns_ytd"))


@register("legacy_cluster_frame", _wb(G1_SQL, f"""
SELECT orderDate, cluster1To1Id, {r('sum(salesQuantityKgL)')} AS cluster_sales_kg,
       CAST(max(is_campaign_week) AS BIGINT) AS is_campaign_week, {r('avg(cluster_sales_lag_1)')} AS cluster_sales_lag_1,
       {r('avg(cluster_sales_rolling4w)')} AS cluster_sales_rolling4w, {r('avg(weeks_since_campaign)')} AS weeks_since_campaign,
       CAST(max(campaigns_ytd) AS BIGINT) AS campaigns_ytd, CAST(month(orderDate) AS BIGINT) AS month,
       CAST(weekofyear(orderDate) AS BIGINT) AS week, CAST(year(orderDate) AS BIGINT) AS year
FROM lp GROUP BY orderDate, cluster1To1Id
"""))
def legacy_cluster_frame(spark, sf):
    """A8."""
    from ..operators.legacy import legacy_cluster_frame as lcf
    return finalize(lcf(_g1(spark, sf)))


@register("multi_level_weekly", _wb(G1_SQL + """,
ml AS (
  SELECT 'item' AS level, itemId AS key, orderDate, sum(salesQuantityKgL) AS s, max(is_campaign_week) AS f,
         min(weeks_since_campaign) AS wsc, max(campaigns_ytd) AS ytd FROM lp GROUP BY orderDate, cluster1To1Id, itemId
  UNION ALL
  SELECT 'cluster', cluster1To1Id, orderDate, sum(salesQuantityKgL), max(is_campaign_week), min(weeks_since_campaign),
         max(campaigns_ytd) FROM lp GROUP BY orderDate, cluster1To1Id
  UNION ALL
  SELECT 'global', 'all', orderDate, sum(salesQuantityKgL), max(is_campaign_week), min(weeks_since_campaign),
         max(campaigns_ytd) FROM lp GROUP BY orderDate)
""", f"""
SELECT level, key, orderDate, {r('s')} AS salesQuantityKgL, CAST(f AS BIGINT) AS is_campaign_week,
       CAST(wsc AS BIGINT) AS weeks_since_campaign, CAST(ytd AS BIGINT) AS campaigns_ytd,
       {r('coalesce(lag(s, 1) OVER (PARTITION BY level, key ORDER BY orderDate), 0.0)')} AS sales_lag_1,
       {r('lag(s, 2) OVER (PARTITION BY level, key ORDER BY orderDate)')} AS sales_lag_2,
       {r('coalesce(avg(s) OVER (PARTITION BY level, key ORDER BY orderDate ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING), 0.0)')} AS sales_rolling4w
FROM ml
"""))
def multi_level_weekly(spark, sf):
    """A10 + W11: item, cluster and global weekly frames of the second generation."""
    from ..operators.legacy import multi_level_weekly as mlw
    return finalize(mlw(_g1(spark, sf)))


FEATURE_SNAPSHOT_WEEK = "2000-06-05"   # fixed: a Monday inside the history


@register("feature_snapshot", _wb(G1_SQL.replace("FROM valid)", f"FROM valid WHERE orderDate <= DATE '{FEATURE_SNAPSHOT_WEEK}')", 1), f"""
SELECT orderDate, itemId, cluster1To1Id, {r('salesQuantityKgL')} AS salesQuantityKgL,
       {r('cluster_sales_lag_1')} AS cluster_sales_lag_1, {r('cluster_sales_rolling4w')} AS cluster_sales_rolling4w,
       CAST(weeks_since_campaign AS BIGINT) AS weeks_since_campaign, CAST(campaigns_ytd AS BIGINT) AS campaigns_ytd
FROM lp WHERE orderDate = DATE '{FEATURE_SNAPSHOT_WEEK}'
"""))
def feature_snapshot(spark, sf):
    """First-generation features recomputed on orders up to a week; that week's rows."""
    g = _g1(spark, sf, as_of=FEATURE_SNAPSHOT_WEEK).where(F.col("orderDate") == F.lit(FEATURE_SNAPSHOT_WEEK).cast("date"))
    return finalize(g.select("orderDate", "itemId", "cluster1To1Id", "salesQuantityKgL", "cluster_sales_lag_1",
                             "cluster_sales_rolling4w", "weeks_since_campaign", "campaigns_ytd"))


_SQL["request_rejections"] = _wb("""
rq AS (
  SELECT CAST(c.campaignId AS VARCHAR) AS request_id, coalesce(i.ids, '') AS item_ids,
         CAST(c.campaignStart - CAST((c.campaignId % 16) * 7 AS INTEGER) AS DATE) AS fd, c.campaignStart AS cs
  FROM cal c LEFT JOIN (
    SELECT salesCampignId, string_agg(DISTINCT regexp_replace(itemId, '^[MSK]', ''), ',') AS ids
    FROM valid WHERE salesCampignId IS NOT NULL GROUP BY salesCampignId) i ON c.campaignId = i.salesCampignId),
dr AS (
  SELECT request_id,
         CASE WHEN item_ids IS NULL OR trim(item_ids) = '' THEN 'no item ids'
              WHEN fd IS NULL THEN 'bad forecast date'
              WHEN cs IS NULL THEN 'bad campaign start'
              WHEN fd > (SELECT max(orderDate) FROM fact) THEN 'forecast date in the future'
              WHEN fd >= cs THEN 'forecast date not before campaign start'
              WHEN floor(date_diff('day', fd, cs) / 7) > 12 THEN 'horizon too long'
              WHEN floor(date_diff('day', fd, cs) / 7) < 0 THEN 'horizon too short' END AS reason
  FROM rq),
rid AS (SELECT request_id, trim(unnest(string_split(item_ids, ','))) AS item_id FROM rq),
rbad AS (SELECT DISTINCT request_id, 'bad item id' AS reason FROM rid
         WHERE item_id = '' OR NOT regexp_matches(item_id, '^[0-9A-Za-z-]+$')),
runk AS (SELECT DISTINCT request_id, 'unknown item id' AS reason FROM rid
         WHERE regexp_matches(item_id, '^[0-9A-Za-z-]+$') AND item_id NOT IN (SELECT baseItemId FROM dimb))
""", """
SELECT request_id, min(reason) AS reason FROM (
  SELECT request_id, reason FROM dr WHERE reason IS NOT NULL
  UNION ALL SELECT request_id, reason FROM rbad
  UNION ALL SELECT request_id, reason FROM runk)
GROUP BY request_id
""")
