"""Independent DuckDB formulations of the registered queries (the correctness oracle).

The driver registers the raw tables (part, orders, lineitem, ...) as views.  The
fixture mapping and the pipeline steps are re-expressed here in plain SQL as a chain
of CTEs; each query appends its final SELECT.  Outputs are cast explicitly and every
double is rounded to 4 places (``+ 0.0`` turns -0.0 into 0.0), exactly as the Spark
side's finaliser does.
"""

from __future__ import annotations

from . import params as P


def wk(d: str, weekday: int) -> str:
    """Week start of date ``d`` for weeks beginning on ``weekday`` (0 = Monday)."""
    return f"({d} - CAST((((isodow({d}) - 1 - {weekday}) % 7) + 7) % 7 AS INTEGER))"


def r(x: str) -> str:
    """4-place rounding as round(x * 1e4 * (1 + 1e-11)) / 1e4: both engines round the
    same IEEE product, and the tiny relative nudge keeps exact .5 ties from flipping
    when the two engines' sums differ in the last bits."""
    return (f"(round(CAST({x} AS DOUBLE) * 10000.0::DOUBLE * 1.00000000001::DOUBLE)"
            f" / 10000.0::DOUBLE + 0.0)")


def item_id_sql(k: str) -> str:
    return (f"(CASE ({k} // 200) % 4 WHEN 0 THEN '' WHEN 1 THEN 'M' WHEN 2 THEN 'S' ELSE 'K' END"
            f" || CAST({k} % 200 AS VARCHAR))")


BASE = f"""
cal AS (
  SELECT CAST(i + 1 AS BIGINT) AS campaignId,
         CAST(DATE '1995-01-03' + CAST(35 * i AS INTEGER) AS DATE) AS campaignStart,
         CAST(DATE '1995-01-03' + CAST(35 * i + 20 AS INTEGER) AS DATE) AS campaignEnd
  FROM range(0, 100000) t(i)
  WHERE DATE '1995-01-03' + CAST(35 * i AS INTEGER) <= (SELECT max(CAST(o_orderdate AS DATE)) FROM orders)
),
dim AS (
  SELECT {item_id_sql('p_partkey')} AS itemId, p_name AS itemDesc, CAST(p_partkey AS BIGINT) AS itemSkey,
         CASE WHEN p_partkey % 11 = 0 THEN '' ELSE p_brand END AS cluster1To1Id,
         CASE WHEN p_size % 3 = 0 THEN p_size / 10.0::DOUBLE END AS wprep,
         CASE WHEN p_size % 3 = 1 THEN p_size / 20.0::DOUBLE ELSE 0.0::DOUBLE END AS wnet,
         CASE WHEN p_size % 4 <> 0 THEN p_retailprice / 1000.0::DOUBLE END AS wgross,
         p_type AS l1, p_type || '-' || p_brand AS l2,
         p_type || '-' || p_brand || '-' || CAST(p_size // 10 AS VARCHAR) AS l3,
         p_type || '-' || p_brand || '-' || CAST(p_size // 10 AS VARCHAR) || '-' || p_name AS l4
  FROM part
),
fact_raw AS (
  SELECT CAST(o.o_orderdate AS DATE) AS orderDate, l.l_linenumber AS ln, l.l_partkey AS pk,
         l.l_quantity AS q, l.l_returnflag AS rf, o.o_orderstatus AS st,
         date_diff('day', DATE '1995-01-03', CAST(o.o_orderdate AS DATE)) AS dd
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
),
fact AS (
  SELECT orderDate, CAST(orderDate + ln AS DATE) AS deliveryDate, {item_id_sql('pk')} AS itemId,
         CAST(pk AS BIGINT) AS itemSkey,
         CASE WHEN dd >= 0 AND dd % 35 < 21 AND ((pk % 200) + dd // 35 + 1) % 8 = 0
              THEN CAST(dd // 35 + 1 AS BIGINT) END AS salesCampignId,
         CASE WHEN rf = 'R' AND ln = 5 THEN -q ELSE q END AS salesQuantity,
         1 AS orderCategoryId, CAST(NULL AS TIMESTAMP) AS orderCancelledDatetime,
         CASE WHEN st = 'P' THEN 'Y' ELSE 'N' END AS cancelFlag
  FROM fact_raw
),
valid AS (
  SELECT * FROM fact WHERE orderCategoryId = 1 AND orderCancelledDatetime IS NULL AND cancelFlag = 'N'
),
dimb AS (SELECT *, regexp_replace(itemId, '^[MSK]', '') AS baseItemId FROM dim),
latest AS (
  SELECT * FROM dimb QUALIFY row_number() OVER (PARTITION BY baseItemId ORDER BY itemSkey DESC) = 1
),
firstclus AS (
  SELECT baseItemId, cluster1To1Id FROM dimb WHERE cluster1To1Id IS NOT NULL AND trim(cluster1To1Id) <> ''
  QUALIFY row_number() OVER (PARTITION BY baseItemId ORDER BY itemSkey) = 1
),
clus AS (
  SELECT b.baseItemId, coalesce(f.cluster1To1Id, b.baseItemId) AS cluster1To1Id
  FROM (SELECT DISTINCT baseItemId FROM dimb) b LEFT JOIN firstclus f ON b.baseItemId = f.baseItemId
),
master AS (
  SELECT l.baseItemId, l.itemId, l.itemDesc, l.itemSkey, c.cluster1To1Id,
         coalesce(CASE WHEN l.wprep > 0 THEN l.wprep END, CASE WHEN l.wnet > 0 THEN l.wnet END,
                  CASE WHEN l.wgross > 0 THEN l.wgross END, 1.0::DOUBLE) AS itemUnitConversion,
         l.l1 AS categoryLevel1Id, l.l2 AS categoryLevel2Id, l.l3 AS categoryLevel3Id, l.l4 AS categoryLevel4Id
  FROM latest l JOIN clus c ON l.baseItemId = c.baseItemId
),
kgl AS (
  SELECT v.*, m.baseItemId, m.cluster1To1Id, m.itemUnitConversion,
         greatest(v.salesQuantity * m.itemUnitConversion, 0.0) AS salesQuantityKgL
  FROM valid v JOIN master m ON regexp_replace(v.itemId, '^[MSK]', '') = m.baseItemId
),
tag0 AS (
  SELECT k.*, c.campaignId, c.campaignStart AS cs, c.campaignEnd AS ce,
         coalesce(k.orderDate >= c.campaignStart AND k.orderDate <= c.campaignEnd
                  AND k.deliveryDate > c.campaignEnd, false) AS late_delivery
  FROM kgl k LEFT JOIN cal c ON k.salesCampignId = c.campaignId
),
tag1 AS (
  SELECT * REPLACE (CASE WHEN late_delivery THEN orderDate ELSE deliveryDate END AS deliveryDate) FROM tag0
),
tagged AS (
  SELECT *, {wk('deliveryDate', P.WEEKDAY)} AS week_start,
         CASE WHEN deliveryDate >= cs AND deliveryDate <= ce
              THEN CAST(floor(date_diff('day', cs, deliveryDate) / 7) + 1 AS INTEGER) ELSE 0 END AS cwn
  FROM tag1
),
tagged_f AS (
  SELECT *, CAST(cwn = 0 AS INTEGER) AS campaign_week_0, CAST(cwn = 1 AS INTEGER) AS campaign_week_1,
         CAST(cwn = 2 AS INTEGER) AS campaign_week_2, CAST(cwn = 3 AS INTEGER) AS campaign_week_3
  FROM tagged
),
iw0 AS (
  SELECT baseItemId, week_start, sum(salesQuantityKgL) AS salesQuantityKgL,
         max(campaign_week_0) AS campaign_week_0, max(campaign_week_1) AS campaign_week_1,
         max(campaign_week_2) AS campaign_week_2, max(campaign_week_3) AS campaign_week_3,
         min(campaignId) AS campaignId, min(cluster1To1Id) AS cluster1To1Id, count(*) AS n_lines
  FROM tagged_f GROUP BY baseItemId, week_start
),
cw0 AS (
  SELECT cluster1To1Id, week_start, sum(salesQuantityKgL) AS salesQuantityKgL,
         min(campaignId) AS campaignId,
         avg(campaign_week_0::DOUBLE) AS campaign_week_0, avg(campaign_week_1::DOUBLE) AS campaign_week_1,
         avg(campaign_week_2::DOUBLE) AS campaign_week_2, avg(campaign_week_3::DOUBLE) AS campaign_week_3
  FROM iw0 GROUP BY cluster1To1Id, week_start
),
cw_modal AS (
  SELECT cluster1To1Id, week_start, baseItemId FROM iw0
  QUALIFY row_number() OVER (PARTITION BY cluster1To1Id, week_start ORDER BY n_lines DESC, baseItemId) = 1
),
ccount AS (
  SELECT cluster1To1Id, week_start, count(DISTINCT baseItemId) AS n_campaign_items_in_cluster
  FROM iw0 WHERE campaign_week_1 = 1 OR campaign_week_2 = 1 OR campaign_week_3 = 1
  GROUP BY cluster1To1Id, week_start
),
csize AS (SELECT cluster1To1Id, count(DISTINCT baseItemId) AS sz FROM iw0 GROUP BY cluster1To1Id),
bavg AS (
  SELECT cluster1To1Id, baseItemId, avg(salesQuantityKgL) AS a FROM iw0 WHERE campaign_week_0 = 1
  GROUP BY cluster1To1Id, baseItemId
),
bshare AS (
  SELECT cluster1To1Id, baseItemId, a / greatest(sum(a) OVER (PARTITION BY cluster1To1Id), 1e-6) AS share FROM bavg
),
iw1 AS (
  SELECT i.baseItemId, i.week_start, i.salesQuantityKgL, i.campaign_week_0, i.campaign_week_1,
         i.campaign_week_2, i.campaign_week_3, i.campaignId, i.cluster1To1Id,
         CAST(coalesce(c.n_campaign_items_in_cluster, 0) AS BIGINT) AS n_campaign_items_in_cluster,
         coalesce(c.n_campaign_items_in_cluster, 0) / greatest(s.sz, 1)::DOUBLE AS campaign_coverage,
         coalesce(b.share, 1.0) AS item_share_in_cluster,
         coalesce(c.n_campaign_items_in_cluster, 0) / greatest(s.sz, 1)::DOUBLE * coalesce(b.share, 1.0) AS coverage_x_share
  FROM iw0 i
  LEFT JOIN ccount c ON i.cluster1To1Id = c.cluster1To1Id AND i.week_start = c.week_start
  LEFT JOIN csize s ON i.cluster1To1Id = s.cluster1To1Id
  LEFT JOIN bshare b ON i.cluster1To1Id = b.cluster1To1Id AND i.baseItemId = b.baseItemId
),
ibounds AS (SELECT min(week_start) AS mn, max(week_start) AS mx FROM iw1),
iweeks AS (
  SELECT CAST(unnest(generate_series(CAST(mn AS TIMESTAMP), CAST(mx AS TIMESTAMP), INTERVAL 7 DAY)) AS DATE) AS week_start
  FROM ibounds
),
igrid AS (SELECT i.baseItemId, w.week_start FROM (SELECT DISTINCT baseItemId FROM iw1) i CROSS JOIN iweeks w),
igf AS (
  SELECT g.baseItemId, g.week_start, coalesce(d.salesQuantityKgL, 0.0) AS salesQuantityKgL,
         CAST(coalesce(d.campaign_week_0, 0) AS INTEGER) AS campaign_week_0,
         CAST(coalesce(d.campaign_week_1, 0) AS INTEGER) AS campaign_week_1,
         CAST(coalesce(d.campaign_week_2, 0) AS INTEGER) AS campaign_week_2,
         CAST(coalesce(d.campaign_week_3, 0) AS INTEGER) AS campaign_week_3,
         last_value(d.campaignId IGNORE NULLS) OVER (PARTITION BY g.baseItemId ORDER BY g.week_start
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS campaignId,
         last_value(d.cluster1To1Id IGNORE NULLS) OVER (PARTITION BY g.baseItemId ORDER BY g.week_start
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cluster1To1Id,
         d.n_campaign_items_in_cluster, d.campaign_coverage, d.item_share_in_cluster, d.coverage_x_share
  FROM igrid g LEFT JOIN iw1 d ON g.baseItemId = d.baseItemId AND g.week_start = d.week_start
),
ipost AS (
  SELECT *, CAST(coalesce(max(campaign_week_3) OVER (PARTITION BY baseItemId ORDER BY week_start
             ROWS BETWEEN 2 PRECEDING AND 1 PRECEDING) > 0, false) AS INTEGER) AS is_post_campaign
  FROM igf
),
inorm0 AS (
  SELECT baseItemId, median(salesQuantityKgL) AS med, avg(salesQuantityKgL) AS av FROM ipost
  WHERE campaign_week_0 = 1 AND is_post_campaign = 0 GROUP BY baseItemId
),
inorm AS (SELECT baseItemId, CASE WHEN med > 0 THEN med ELSE av END AS normalizer FROM inorm0),
iglobal AS (SELECT median(salesQuantityKgL) AS g FROM ipost),
inormed AS (
  SELECT p.*, ln(1 + CASE WHEN eff = 0 THEN NULL ELSE p.salesQuantityKgL / eff END) AS salesQuantityKgL_log
  FROM (SELECT p.*, CASE WHEN n.normalizer > 0 THEN n.normalizer ELSE (SELECT g FROM iglobal) END AS eff
        FROM ipost p LEFT JOIN inorm n ON p.baseItemId = n.baseItemId) p
),
cw1 AS (
  SELECT c.cluster1To1Id, c.week_start, c.salesQuantityKgL, m.baseItemId, c.campaignId,
         c.campaign_week_0, c.campaign_week_1, c.campaign_week_2, c.campaign_week_3
  FROM cw0 c JOIN cw_modal m ON c.cluster1To1Id = m.cluster1To1Id AND c.week_start = m.week_start
),
cbounds AS (SELECT min(week_start) AS mn, max(week_start) AS mx FROM cw1),
cweeks AS (
  SELECT CAST(unnest(generate_series(CAST(mn AS TIMESTAMP), CAST(mx AS TIMESTAMP), INTERVAL 7 DAY)) AS DATE) AS week_start
  FROM cbounds
),
cgrid AS (SELECT i.cluster1To1Id, w.week_start FROM (SELECT DISTINCT cluster1To1Id FROM cw1) i CROSS JOIN cweeks w),
cgf AS (
  SELECT g.cluster1To1Id, g.week_start, coalesce(d.salesQuantityKgL, 0.0) AS salesQuantityKgL, d.baseItemId,
         coalesce(d.campaign_week_0, 0.0) AS campaign_week_0, coalesce(d.campaign_week_1, 0.0) AS campaign_week_1,
         coalesce(d.campaign_week_2, 0.0) AS campaign_week_2, coalesce(d.campaign_week_3, 0.0) AS campaign_week_3,
         last_value(d.campaignId IGNORE NULLS) OVER (PARTITION BY g.cluster1To1Id ORDER BY g.week_start
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS campaignId
  FROM cgrid g LEFT JOIN cw1 d ON g.cluster1To1Id = d.cluster1To1Id AND g.week_start = d.week_start
),
cpost AS (
  SELECT *, CAST(coalesce(max(campaign_week_3) OVER (PARTITION BY cluster1To1Id ORDER BY week_start
             ROWS BETWEEN 2 PRECEDING AND 1 PRECEDING) > 0, false) AS INTEGER) AS is_post_campaign
  FROM cgf
),
cnorm0 AS (
  SELECT cluster1To1Id, median(salesQuantityKgL) AS med, avg(salesQuantityKgL) AS av FROM cpost
  WHERE campaign_week_0 = 1 AND is_post_campaign = 0 GROUP BY cluster1To1Id
),
cnorm AS (SELECT cluster1To1Id, CASE WHEN med > 0 THEN med ELSE av END AS normalizer FROM cnorm0),
cglobal AS (SELECT median(salesQuantityKgL) AS g FROM cpost),
cnormed AS (
  SELECT p.*, ln(1 + CASE WHEN eff = 0 THEN NULL ELSE p.salesQuantityKgL / eff END) AS salesQuantityKgL_log
  FROM (SELECT p.*, CASE WHEN n.normalizer > 0 THEN n.normalizer ELSE (SELECT g FROM cglobal) END AS eff
        FROM cpost p LEFT JOIN cnorm n ON p.cluster1To1Id = n.cluster1To1Id) p
),
ifilt AS (
  SELECT * EXCLUDE (lastcw) FROM (
    SELECT *, max(CASE WHEN campaign_week_1 = 1 OR campaign_week_2 = 1 OR campaign_week_3 = 1 THEN week_start END)
              OVER (PARTITION BY baseItemId) AS lastcw FROM inormed)
  WHERE week_start <= lastcw
)
"""


def with_base(final_select: str) -> str:
    return "WITH " + BASE.strip().rstrip(",") + "\n" + final_select


def with_wide_base(final_select: str) -> str:
    """The same chain where every part is a base item of its own (wide key space)."""
    wide = BASE.replace(item_id_sql("p_partkey"), "CAST(p_partkey AS VARCHAR)").replace(item_id_sql("pk"), "CAST(pk AS VARCHAR)")
    return "WITH " + wide.strip().rstrip(",") + "\n" + final_select


def lag_cols(id_col: str, h: int, src: str = "salesQuantityKgL_log") -> str:
    parts = []
    for n in (1, 2, 3):
        L = h + n
        parts.append(f"coalesce(lag({src}, {L}) OVER (PARTITION BY {id_col} ORDER BY week_start), 0.0) AS sales_lag_week{n}")
        parts.append(f"coalesce(avg({src}) OVER (PARTITION BY {id_col} ORDER BY week_start "
                     f"ROWS BETWEEN {L + 3} PRECEDING AND {L} PRECEDING), 0.0) AS sales_rolling_4w_week{n}")
    parts.append(f"coalesce(lag({src}, 12) OVER (PARTITION BY {id_col} ORDER BY week_start), 0.0) AS sales_lag_12w")
    parts.append(f"coalesce(lag({src}, 52) OVER (PARTITION BY {id_col} ORDER BY week_start), 0.0) AS sales_lag_52w")
    return ",\n       ".join(parts)
