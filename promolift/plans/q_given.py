"""Registered queries: reports on predictions that SQL can make (history means), lag-date
features, rejected lines and the growing processed table."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.dates import month_features
from ..functions.units import kgl_to_units
from ..operators import features as FE
from ..operators import forecast as FC
from ..operators import report as R
from ..operators import scenario as S
from ..operators import training as TR
from ..operators import universe as U
from ..operators import weekly as WK
from ..sources import fixtures as FX
from ..sources import io as IO
from ..sources import processed as PR
from . import oracle as O
from . import params as P
from .forecast_job import campaign_items, plan_tables, run_lag_date
from .preprocess import weekly_lines
from .q_features import CAT_SQL, CLAGS_SQL, ITEM_FEATURES_SQL
from .q_frames import _sample
from .q_models import FORECAST_CAMPAIGN
from .registry import _filtered_items, _inputs, _pre, _weekly, finalize, register

r = O.r


def _with(extra: str, final: str) -> str:
    return O.with_base(", " + extra.strip() + "\n" + final)


# --- reports on given predictions (R1, R2, A17, U3, R5, A11) ------------------------------
# Prediction of a campaign week N: an id's mean of the weeks that had it, without the
# campaign its mean of plain weeks; 0 where it has none.

_GIVEN = """
wk3 AS (SELECT w FROM (VALUES (1), (2), (3)) t(w)),
gi AS (
  SELECT baseItemId, w, coalesce(avg(CASE WHEN (w = 1 AND campaign_week_1 = 1) OR (w = 2 AND campaign_week_2 = 1) OR (w = 3 AND campaign_week_3 = 1) THEN salesQuantityKgL END), 0) AS on_kgl,
         coalesce(avg(CASE WHEN campaign_week_0 = 1 THEN salesQuantityKgL END), 0) AS off_kgl
  FROM iw0 CROSS JOIN wk3 GROUP BY baseItemId, w),
gc AS (
  SELECT cluster1To1Id, w, coalesce(avg(CASE WHEN (w = 1 AND campaign_week_1 > 0) OR (w = 2 AND campaign_week_2 > 0) OR (w = 3 AND campaign_week_3 > 0) THEN salesQuantityKgL END), 0) AS on_kgl,
         coalesce(avg(CASE WHEN campaign_week_0 > 0 THEN salesQuantityKgL END), 0) AS off_kgl
  FROM cw0 CROSS JOIN wk3 GROUP BY cluster1To1Id, w),
"""


def _history_predictions(weekly, idc):
    """(id, campaign_week, campaign_on, prediction_kgl)."""
    mean = lambda c: F.coalesce(F.avg(F.when(c, F.col("salesQuantityKgL"))), F.lit(0.0))
    means = weekly.groupBy(idc).agg(*[mean(F.col(f"campaign_week_{n}") > 0).alias(f"w{n}") for n in range(4)])
    rows = [F.struct(F.lit(n).alias("campaign_week"), F.lit(on).alias("campaign_on"), F.col(f"w{n if on else 0}").alias("prediction_kgl")) for n in (1, 2, 3) for on in (True, False)]
    return means.select(idc, F.inline(F.array(*rows)))


def _history_summary(spark, sf):
    iw, cw = _weekly(spark, sf)
    inp = _inputs(spark, sf)
    sizes = WK.cluster_sizes(iw)
    return R.campaign_summary(_history_predictions(iw, "baseItemId"), _history_predictions(cw, "cluster1To1Id"), U.item_master(inp.items), sizes)


_SUMMARY = _GIVEN + """
gs AS (
  SELECT g.baseItemId AS item_id, m.itemDesc AS description, m.cluster1To1Id AS cluster_id,
         sum(CASE WHEN w = 1 THEN on_kgl / itemUnitConversion END) AS a1, sum(CASE WHEN w = 2 THEN on_kgl / itemUnitConversion END) AS a2, sum(CASE WHEN w = 3 THEN on_kgl / itemUnitConversion END) AS a3,
         sum(CASE WHEN w = 1 THEN off_kgl / itemUnitConversion END) AS b1
  FROM gi g JOIN master m ON g.baseItemId = m.baseItemId GROUP BY ALL),
gt AS (SELECT cluster1To1Id, sum(on_kgl) AS con, sum(off_kgl) AS coff FROM gc GROUP BY 1),
gsum AS (
  SELECT gs.*, a1 + a2 + a3 AS tot, 3 * b1 AS base, a1 + a2 + a3 - 3 * b1 AS eff, con, coff, con - coff AS ceff, coalesce(z.sz, 1) AS sz
  FROM gs LEFT JOIN gt ON gs.cluster_id = gt.cluster1To1Id LEFT JOIN csize z ON gs.cluster_id = z.cluster1To1Id)
"""


@register("summary_on_history", _with(_SUMMARY, f"""
SELECT item_id, description, cluster_id, {r('a1')} AS item_w1_campaign, {r('a2')} AS item_w2_campaign, {r('a3')} AS item_w3_campaign, {r('b1')} AS item_w1_baseline,
       {r('tot')} AS item_campaign_total, {r('base')} AS item_baseline_total, {r('eff')} AS item_effect, {r('CASE WHEN base > 0 THEN eff / base * 100 ELSE 0 END')} AS item_effect_pct,
       {r('con')} AS cluster_campaign_total, {r('coff')} AS cluster_baseline_total, {r('ceff')} AS cluster_effect_kg, {r('CASE WHEN coff > 0 THEN ceff / coff * 100 ELSE 0 END')} AS cluster_effect_pct,
       CAST(sz AS BIGINT) AS cluster_size,
       CASE WHEN sz <= 1 THEN CASE WHEN eff > 0 THEN 'Positive (sole)' WHEN eff < 0 THEN 'Negative (sole)' ELSE 'Neutral (sole)' END
            WHEN eff > 0 AND ceff > 0 THEN CASE WHEN eff > ceff * 0.8 THEN 'Halo' ELSE 'Positive' END
            WHEN eff > 0 AND ceff < 0 THEN 'Cannibalization' WHEN eff < 0 THEN 'Negative' ELSE 'Neutral' END AS verdict
FROM gsum
"""))
def summary_on_history(spark, sf):
    """R1 + R2 on history means as predictions."""
    s = _history_summary(spark, sf)
    return finalize(s.drop("item_w2_baseline", "item_w3_baseline"))


@register("totals_on_history", _with(_SUMMARY, f"""
SELECT {r('sum(tot)')} AS total_campaign, {r('sum(base)')} AS total_baseline, {r('sum(tot) - sum(base)')} AS total_effect,
       {r('CASE WHEN sum(base) > 0 THEN (sum(tot) - sum(base)) / sum(base) * 100 ELSE 0 END')} AS total_effect_pct FROM gsum
"""))
def totals_on_history(spark, sf):
    """A17 over the rows of ``summary_on_history``."""
    return finalize(R.forecast_totals(_history_summary(spark, sf)))


@register("order_units_on_history", _with(_GIVEN.strip().rstrip(","), f"""
SELECT g.baseItemId, m.itemDesc, CAST(w AS BIGINT) AS campaign_week, {r('on_kgl')} AS prediction_kgl, {r('on_kgl / itemUnitConversion')} AS units,
       {r('round(on_kgl / itemUnitConversion * 1.00000000001)')} AS units_rounded, CAST(ceil(on_kgl / itemUnitConversion * 0.99999999999) AS BIGINT) AS units_ceil
FROM gi g JOIN master m ON g.baseItemId = m.baseItemId
"""))
def order_units_on_history(spark, sf):
    """R5 + U3: the three conversions back to sales units, on history means."""
    iw, _ = _weekly(spark, sf)
    m = U.item_master(_inputs(spark, sf).items).select("baseItemId", "itemDesc", "itemUnitConversion")
    p = _history_predictions(iw, "baseItemId").where("campaign_on").join(m, "baseItemId")
    f, k = F.col("itemUnitConversion"), F.col("prediction_kgl")
    return finalize(p.select("baseItemId", "itemDesc", "campaign_week", "prediction_kgl", kgl_to_units(k, f).alias("units"),
                             kgl_to_units(k * 1.00000000001, f, "round").alias("units_rounded"), kgl_to_units(k * 0.99999999999, f, "ceil").alias("units_ceil")))


@register("scenario_comparison_on_history", _with(_GIVEN.strip().rstrip(","), f"""
SELECT baseItemId, CAST(w AS BIGINT) AS horizon, {r('off_kgl')} AS no_campaign, {r('on_kgl')} AS campaign, {r('on_kgl - off_kgl')} AS abs_lift,
       {r('(on_kgl - off_kgl) / CASE WHEN off_kgl = 0 THEN 1e-6 ELSE off_kgl END * 100')} AS pct_lift
FROM gi
"""))
def scenario_comparison_on_history(spark, sf):
    """The two scenarios side by side with absolute and percentage lift."""
    iw, _ = _weekly(spark, sf)
    p = _history_predictions(iw, "baseItemId").select("baseItemId", F.col("campaign_week").alias("horizon"), "campaign_on", F.col("prediction_kgl").alias("prediction"))
    return finalize(R.scenario_comparison(p.where(~F.col("campaign_on")).drop("campaign_on"), p.where("campaign_on").drop("campaign_on"), "baseItemId"))


# --- lag-date flow (J11, P5) -----------------------------------------------------------------

_LAGS = (P.HORIZON, P.HORIZON + 1, P.HORIZON + 2, 12, 52)


@register("lag_date_features", O.with_base(
    "SELECT a.cluster1To1Id, a.week_start, " + ", ".join(f"{r(f'l{k}.salesQuantityKgL_log')} AS salesQuantityKgL_log_lag_{k}w" for k in (4, 5, 6, 12, 52))
    + " FROM cnormed a " + " ".join(f"LEFT JOIN cnormed l{k} ON a.cluster1To1Id = l{k}.cluster1To1Id AND l{k}.week_start = a.week_start - {7 * k}" for k in (4, 5, 6, 12, 52))))
def lag_date_features(spark, sf):
    """The cluster's values at several exact lag dates, by one join."""
    from .q_features import _cluster_lagged
    c = _cluster_lagged(spark, sf).select("cluster1To1Id", "week_start", "salesQuantityKgL_log")
    d = FC.lag_values(c, "cluster1To1Id", list(_LAGS))
    return finalize(d.select("cluster1To1Id", "week_start", *[f"salesQuantityKgL_log_lag_{k}w" for k in _LAGS]))


@register("lag_date_scoring", _with(CLAGS_SQL.strip() + """,
ask AS (SELECT w, DATE '2001-07-10' + CAST(7 * (w - 1) AS INTEGER) AS target, DATE '2001-07-10' + CAST(7 * (w - 1) - 7 * (4 + w) AS INTEGER) AS lag FROM (VALUES (1), (2), (3)) t(w))
""", f"""
SELECT c.cluster1To1Id, CAST(a.w AS BIGINT) AS campaign_week, a.target AS week_start, a.lag AS feature_week, {r('c.sales_lag_week1')} AS cluster_sales_lag_week1,
       {r('c.sales_rolling_4w_week3')} AS cluster_sales_rolling_4w_week3, {r('c.sales_lag_52w')} AS sales_lag_52w, {r('cos(2 * pi() * weekofyear(a.target) / 52)')} AS week_of_year_cos,
       {r('0')} AS campaign_week_0, {r('CASE WHEN w = 1 THEN 1 ELSE 0 END')} AS campaign_week_1, {r('CASE WHEN w = 2 THEN 1 ELSE 0 END')} AS campaign_week_2, {r('CASE WHEN w = 3 THEN 1 ELSE 0 END')} AS campaign_week_3
FROM ask a JOIN clag c ON c.week_start = a.lag WHERE a.lag <= DATE '2001-06-05'
"""))
def lag_date_scoring(spark, sf):
    """P5: scoring rows whose features come from the lag date, apart from the forecast week."""
    rows = FC.lag_date_scoring(_pre(spark, sf).cluster_weekly, "cluster1To1Id", P.FORECAST_DATE, P.CAMPAIGN_START, P.HORIZON + 1)
    return finalize(rows.select("cluster1To1Id", "campaign_week", "week_start", "feature_week", "cluster_sales_lag_week1", "cluster_sales_rolling_4w_week3", "sales_lag_52w",
                                "week_of_year_cos", *[f"campaign_week_{k}" for k in range(4)]))


@register("lag_date_forecast")
def lag_date_forecast(spark, sf):
    """P5: random split, one model a campaign week with q10, q50 and q90, lag-date features."""
    pre = _pre(spark, sf)
    return finalize(run_lag_date(pre.cluster_weekly, pre.cluster_normalizers, P.CAMPAIGN_START, P.FORECAST_DATE, P.HORIZON + 1))


# --- rejects (J4, J5) and the growing processed table (S5b) ---------------------------------

@register("rejected_lines", O.with_base(f"""
SELECT t.baseItemId, count(DISTINCT t.week_start) AS n_weeks, count(*) AS n_lines, {r('sum(greatest(t.salesQuantity, 0))')} AS quantity
FROM tagged_f t JOIN latest l ON t.baseItemId = l.baseItemId
WHERE NOT coalesce(l.wprep > 0, false) AND NOT coalesce(l.wnet > 0, false) AND NOT coalesce(l.wgross > 0, false) GROUP BY 1
"""))
def rejected_lines(spark, sf):
    """Order lines of items without a usable weight, where no factor stands in."""
    from ..session import cut_lineage
    inp = _inputs(spark, sf)
    weekly, _ = weekly_lines(inp.orders, inp.items, inp.campaigns, P.CAMPAIGN_START, unit=None)
    return finalize(WK.split_mapped(weekly, cut_lineage, most_rejected=1.0)[1])


@register("cached_weekly_sales", _with(f"""
early AS (SELECT DISTINCT m.cluster1To1Id FROM valid v JOIN master m ON regexp_replace(v.itemId, '^[MSK]', '') = m.baseItemId WHERE v.salesCampignId = 69)
""", f"""
SELECT i.baseItemId, i.week_start, i.cluster1To1Id, {r('i.salesQuantityKgL')} AS salesQuantityKgL, CAST(e.cluster1To1Id IS NULL AS BIGINT) AS part
FROM iw0 i LEFT JOIN early e ON i.cluster1To1Id = e.cluster1To1Id
"""))
def cached_weekly_sales(spark, sf):
    """A table built for one campaign's clusters, then asked for every item: only the
    clusters that lack are built; ``part`` tells which request built a row."""
    inp = _inputs(spark, sf)
    members = U.item_master(inp.items).select("baseItemId", "cluster1To1Id")
    store = IO.scratch_path(spark, "processed")

    def build(keys):
        own = inp.orders.join(keys, U.base_item_id(F.col("itemId")) == keys["baseItemId"], "left_semi")
        rows, _ = weekly_lines(own, inp.items, inp.campaigns, P.CAMPAIGN_START)
        return WK.require_mapped(rows, IO.snapshot).select("baseItemId", "week_start", "cluster1To1Id", "salesQuantityKgL")

    PR.load_or_build(spark, store, campaign_items(inp.orders, FORECAST_CAMPAIGN), members, build)
    return finalize(PR.load_or_build(spark, store, members, members, build))


# --- T3, A4b ---------------------------------------------------------------------------------

@register("month_cycles", O.with_base(f"""
SELECT DISTINCT week_start, CAST(weekofyear(week_start) AS BIGINT) AS week, CAST(month(week_start) AS BIGINT) AS month, CAST(year(week_start) AS BIGINT) AS year,
       {r('sin(2 * pi() * month(week_start) / 12)')} AS month_sin, {r('cos(2 * pi() * month(week_start) / 12)')} AS month_cos FROM ifilt
"""))
def month_cycles(spark, sf):
    """T3."""
    w = _filtered_items(spark, sf).select("week_start").distinct()
    return finalize(w.select("week_start", *month_features(F.col("week_start"))))


@register("plan_cluster_sizes", _with("""
tg AS (SELECT DISTINCT regexp_replace(itemId, '^[MSK]', '') AS baseItemId FROM valid WHERE salesCampignId = 69)
""", """
SELECT m.cluster1To1Id, count(DISTINCT t.baseItemId) AS n_on_campaign, count(DISTINCT m.baseItemId) AS cluster_size
FROM master m LEFT JOIN tg t ON m.baseItemId = t.baseItemId GROUP BY 1 HAVING count(DISTINCT t.baseItemId) > 0
"""))
def plan_cluster_sizes(spark, sf):
    """Items of the plan and items in all, of the plan's clusters."""
    inp = _inputs(spark, sf)
    plan, sizes = plan_tables(U.item_master(inp.items), campaign_items(inp.orders, FORECAST_CAMPAIGN))
    return finalize(plan.join(sizes, "cluster1To1Id"))


# --- training frames with their features (F11), random and date splits by row (P11, W13) -----

_SHOWN = ["n_campaign_items_in_cluster", "cat_n_obs_l4", "weeks_since_last_campaign_l4", "n_campaigns_historical_l4"]
_MEASURED = ["salesQuantityKgL_log", "campaign_coverage", "item_share_in_cluster", "coverage_x_share", "best_cat_lift", "week_of_year_sin",
             "sales_lag_week1", "sales_rolling_4w_week2", "sales_lag_week3", "sales_lag_52w", "cluster_sales_lag_week1", "cluster_sales_rolling_4w_week3"]
_FILL = {"n_campaign_items_in_cluster": "coalesce(f.n_campaign_items_in_cluster, 0)", "campaign_coverage": "coalesce(f.campaign_coverage, 0)", "coverage_x_share": "coalesce(f.coverage_x_share, 0)",
         "item_share_in_cluster": "coalesce(f.item_share_in_cluster, g.share, 1.0)"}


@register("training_features", _with(ITEM_FEATURES_SQL.strip() + ", " + ", ".join(_sample(k) for k in (1, 2, 3)) + """,
gshare AS (SELECT baseItemId, max(item_share_in_cluster) AS share FROM ifeat GROUP BY 1)
""", " UNION ALL ".join(f"""
SELECT CAST({k} AS BIGINT) AS model_week, f.baseItemId, f.week_start, {', '.join(f"CAST({_FILL.get(c, 'f.' + c)} AS BIGINT) AS {c}" for c in _SHOWN)},
       {', '.join(f"{r(_FILL.get(c, 'f.' + c))} AS {c}" for c in _MEASURED)}
FROM s{k} s JOIN ifeat f ON s.baseItemId = f.baseItemId AND s.week_start = f.week_start LEFT JOIN gshare g ON f.baseItemId = g.baseItemId
""" for k in (1, 2, 3))))
def training_features(spark, sf):
    """the feature columns that the three week models learn from."""
    from ..session import cut_lineage
    d = cut_lineage(TR.fill_feature_nulls(_pre(spark, sf).item_weekly, "item"))
    parts = [TR.week_training_frame(d, "item", k).select(F.lit(k).alias("model_week"), "baseItemId", "week_start", *_SHOWN, *_MEASURED) for k in (1, 2, 3)]
    return finalize(parts[0].unionByName(parts[1]).unionByName(parts[2]))


@register("hash_split_rows", O.with_base("""
SELECT baseItemId, week_start, CASE WHEN b < 60 THEN 'train' WHEN b < 80 THEN 'val' ELSE 'test' END AS split
FROM (SELECT baseItemId, week_start, CAST('0x' || substr(md5('42|' || baseItemId || '|' || CAST(week_start AS VARCHAR)), 1, 7) AS BIGINT) % 100 AS b FROM iw0)
"""))
def hash_split_rows(spark, sf):
    """P11, every row's side."""
    iw, _ = _weekly(spark, sf)
    return finalize(TR.hash_split(iw, ["baseItemId", "week_start"]).select("baseItemId", "week_start", "split"))


@register("cutoff_split_rows", O.with_base("""
SELECT baseItemId, week_start, CASE WHEN week_start < DATE '2001-06-12' THEN 'train' ELSE 'test' END AS split FROM iw0
"""))
def cutoff_split_rows(spark, sf):
    """W13, every row's side."""
    iw, _ = _weekly(spark, sf)
    return finalize(TR.cutoff_split(iw, P.FORECAST_DATE).select("baseItemId", "week_start", "split"))


# --- universe with requested ids and its orders (F4, F5), history (F10, A12, A15, A16), S10 ----

@register("requested_universe_orders", _with("""
req AS (SELECT DISTINCT regexp_replace(itemId, '^[MSK]', '') AS b FROM valid WHERE deliveryDate = (SELECT max(deliveryDate) FROM valid)),
foc AS (SELECT b FROM req UNION SELECT regexp_replace(itemId, '^[MSK]', '') FROM valid WHERE salesCampignId = 69),
uni AS (
  SELECT d.itemId, d.baseItemId FROM dimb d JOIN clus c ON d.baseItemId = c.baseItemId
  WHERE c.cluster1To1Id IN (SELECT c2.cluster1To1Id FROM clus c2 JOIN foc ON c2.baseItemId = foc.b) OR d.baseItemId IN (SELECT b FROM foc)),
ids AS (SELECT itemId FROM uni UNION SELECT p || itemId FROM uni, (VALUES ('M'), ('S'), ('K')) v(p) WHERE NOT regexp_matches(itemId, '^[MSK]'))
""", f"""
SELECT itemId, count(*) AS n_lines, {r('sum(salesQuantity)')} AS quantity, max(orderDate) AS last_order FROM valid WHERE itemId IN (SELECT itemId FROM ids) GROUP BY itemId
"""))
def requested_universe_orders(spark, sf):
    """F4 + F5: the universe of one campaign's items and of the items of the last delivery day,
    and the orders of all its ids and variants."""
    inp = _inputs(spark, sf)
    v = U.valid_orders(inp.orders)
    last = v.agg(F.max("deliveryDate").alias("d"))
    asked = v.join(last, v["deliveryDate"] == last["d"], "left_semi").select("itemId").distinct()
    universe = U.item_universe(v, inp.items, inp.campaigns.where(F.col("campaignId") == FORECAST_CAMPAIGN), asked)
    o = U.universe_orders(v, universe)
    return finalize(o.groupBy("itemId").agg(F.count("*").alias("n_lines"), F.sum("salesQuantity").alias("quantity"), F.max("orderDate").alias("last_order")))


@register("eligible_campaign_items", O.with_base("""
SELECT baseItemId, count(*) AS n_weeks FROM iw0 WHERE campaign_week_1 = 1 OR campaign_week_2 = 1 OR campaign_week_3 = 1 GROUP BY 1 HAVING count(*) >= 3
"""))
def eligible_campaign_items(spark, sf):
    """F10 on campaign weeks: items with at least three."""
    iw, _ = _weekly(spark, sf)
    return finalize(U.eligible_ids(iw.where(U.on_campaign()), "baseItemId", 3))


@register("target_profile", O.with_base(f"""
SELECT baseItemId, count(*) AS n_rows, CAST(count_if(campaign_week_1 = 1 OR campaign_week_2 = 1 OR campaign_week_3 = 1) AS BIGINT) AS campaign_rows,
       CAST(count_if(salesQuantityKgL_log = 0) AS BIGINT) AS zero_weeks, min(week_start) AS first_week, max(week_start) AS last_week,
       {r('min(salesQuantityKgL_log)')} AS min_value, {r('max(salesQuantityKgL_log)')} AS max_value FROM ifilt GROUP BY 1
"""))
def target_profile(spark, sf):
    """A12, one row a target."""
    return finalize(S.target_profile(_filtered_items(spark, sf), "baseItemId"))


@register("recent_cluster_average", _with("""
lastw AS (SELECT cluster1To1Id, max(week_start) AS w FROM cw0 GROUP BY 1)
""", f"""
SELECT c.cluster1To1Id, {r('avg(c.salesQuantityKgL)')} AS recent_average, count(*) AS recent_weeks
FROM cw0 c JOIN lastw l ON c.cluster1To1Id = l.cluster1To1Id WHERE c.week_start >= l.w - 84 GROUP BY 1
"""))
def recent_cluster_average(spark, sf):
    """A15, cluster half."""
    _, cw = _weekly(spark, sf)
    return finalize(S.recent_cluster_average(cw))


@register("campaign_intensity", O.with_base(" UNION ALL ".join(f"""
SELECT CAST({k} AS BIGINT) AS model_week, count(*) AS n_rows, CAST(count_if(campaign_week_{k} > 0) AS BIGINT) AS n_campaign,
       {r(f'avg(CASE WHEN campaign_week_{k} > 0 THEN campaign_week_{k} END)')} AS mean_intensity FROM cw0 """ for k in (1, 2, 3))))
def campaign_intensity(spark, sf):
    """A16, cluster half: rows with a campaign and their mean intensity."""
    _, cw = _weekly(spark, sf)
    rows = [F.struct(F.lit(k).alias("model_week"), F.col(f"campaign_week_{k}").alias("intensity")) for k in (1, 2, 3)]
    return finalize(S.campaign_intensity(cw.select(F.inline(F.array(*rows)))))


@register("harmonized_rows", O.with_base(f"""
SELECT itemDesc, {r('itemSkey')} AS itemSkey, cluster1To1Id, {r('wnet')} AS netWeight, {r('wgross')} AS grossWeight, l4 AS category FROM dim
"""))
def harmonized_rows(spark, sf):
    """The item master from text, converted, every row."""
    d = FX.dim_item(spark, sf)
    text = d.select("itemDesc", F.col("itemSkey").cast("string").alias("itemSkey"), "cluster1To1Id", F.col("netWeightKgComparisonUnit").cast("string").alias("netWeight"),
                    F.col("grossWeightKgComparisonUnit").cast("string").alias("grossWeight"), F.col("categoryLevel4Id").alias("category"))
    return finalize(IO.harmonize_types(text))


# --- options: seasonal window over the year's end (Q19), lifts as of each week (Q17) ------------

@register("cluster_seasonal_baseline_wrapped", _with("""
sb AS (
  SELECT c.cluster1To1Id, (exp(c.salesQuantityKgL_log) - 1) * coalesce(n.normalizer, 1000.0) AS kgl,
         least((weekofyear(c.week_start) - 52 + 104) % 52, 52 - (weekofyear(c.week_start) - 52 + 104) % 52) <= 2 AS near
  FROM cnormed c LEFT JOIN cnorm n ON c.cluster1To1Id = n.cluster1To1Id WHERE c.week_start <= DATE '1999-11-23'),
sba AS (
  SELECT cluster1To1Id, median(CASE WHEN near THEN kgl END) AS mn, avg(CASE WHEN near THEN kgl END) AS an, median(kgl) AS ma, avg(kgl) AS aa, bool_or(near) AS hn FROM sb GROUP BY 1),
sbb AS (SELECT cluster1To1Id, CASE WHEN hn THEN mn ELSE ma END AS med, CASE WHEN hn THEN an ELSE aa END AS av FROM sba)
""", f"""
SELECT cluster1To1Id, CAST(w AS BIGINT) AS campaign_week, {r("CASE WHEN med > 0 AND med < 1000000 THEN med WHEN av > 0 AND av < 1000000 THEN av ELSE 1000.0 END")} AS baseline_kgl
FROM sbb, (VALUES (1), (2), (3)) t(w)
"""))
def cluster_seasonal_baseline_wrapped(spark, sf):
    """P4, cluster level, for the campaign that starts on 1999-12-28 (ISO week 52), with weeks 1
    and 2 near."""
    pre = _pre(spark, sf)
    return finalize(FC.seasonal_baseline(pre.cluster_weekly, "cluster", "1999-11-30", "1999-12-28", pre.cluster_normalizers, wrap=True))


@register("category_lift_asof", _with(CAT_SQL.strip() + ", " + ", ".join(f"""
e{k} AS (
  SELECT k.c, k.w, sum(o.lift) AS s, count(o.lift) AS n
  FROM (SELECT DISTINCT categoryLevel{k}Id AS c, week_start AS w FROM icat) k LEFT JOIN obs o ON o.categoryLevel{k}Id = k.c AND o.week_start < k.w GROUP BY 1, 2)""" for k in (1, 2, 3, 4)) + """,
ea AS (
  SELECT i.baseItemId, i.week_start, CASE WHEN e1.n > 0 THEN e1.s / e1.n ELSE 0.0 END AS l1, CASE WHEN e2.n > 0 THEN e2.s / e2.n ELSE 0.0 END AS l2,
         CASE WHEN e3.n > 0 THEN e3.s / e3.n ELSE 0.0 END AS l3, CASE WHEN e4.n > 0 THEN e4.s / e4.n ELSE 0.0 END AS l4, e2.n::DOUBLE AS n2, e3.n::DOUBLE AS n3, e4.n AS n4
  FROM icat i JOIN e1 ON i.categoryLevel1Id = e1.c AND i.week_start = e1.w JOIN e2 ON i.categoryLevel2Id = e2.c AND i.week_start = e2.w
  JOIN e3 ON i.categoryLevel3Id = e3.c AND i.week_start = e3.w JOIN e4 ON i.categoryLevel4Id = e4.c AND i.week_start = e4.w),
eb AS (SELECT *, (1 - n2 / (n2 + 10)) * l1 + n2 / (n2 + 10) * l2 AS b2 FROM ea),
ec AS (SELECT *, (1 - n3 / (n3 + 10)) * b2 + n3 / (n3 + 10) * l3 AS b3 FROM eb)
""", f"""
SELECT baseItemId, week_start, {r('l1')} AS cat_lift_l1, {r('l2')} AS cat_lift_l2, {r('l3')} AS cat_lift_l3, {r('l4')} AS cat_lift_l4,
       {r('(1 - n4::DOUBLE / (n4 + 10)) * b3 + n4::DOUBLE / (n4 + 10) * l4')} AS best_cat_lift, CAST(n4 AS BIGINT) AS cat_n_obs_l4 FROM ec
"""))
def category_lift_asof(spark, sf):
    """C3 with lifts of strictly earlier weeks."""
    d = FE.add_category_lift_features(_filtered_items(spark, sf), U.item_master(_inputs(spark, sf).items), asof=True)
    return finalize(d.select("baseItemId", "week_start", *[f"cat_lift_l{n}" for n in range(1, 5)], "best_cat_lift", "cat_n_obs_l4"))


# --- scoring on the campaign weeks' own features (Q11) -------------------------------------------

_AHEAD = """
{p}last AS (SELECT {id}, max(week_start) AS l FROM {src} WHERE week_start <= DATE '2001-06-12' GROUP BY 1),
{p}ext AS (
  SELECT {id}, week_start, salesQuantityKgL_log FROM {src} WHERE week_start <= DATE '2001-06-12'
  UNION ALL SELECT {id}, CAST(l + CAST(7 * k AS INTEGER) AS DATE), NULL FROM {p}last, range(1, 400) t(k) WHERE l + CAST(7 * k AS INTEGER) <= DATE '2001-07-24'),
{p}lag AS (SELECT {id}, week_start, {lags} FROM {p}ext),
{p}at AS (SELECT *, date_diff('day', DATE '2001-07-10', week_start) // 7 + 1 AS w FROM {p}lag WHERE week_start IN (DATE '2001-07-10', DATE '2001-07-17', DATE '2001-07-24'))
"""


@register("target_week_scoring", _with(_AHEAD.format(p="x", id="cluster1To1Id", src="cnormed", lags=O.lag_cols("cluster1To1Id", 4)).strip() + ", "
                                       + _AHEAD.format(p="y", id="baseItemId", src="ifilt", lags=O.lag_cols("baseItemId", 4)).strip() + """,
ylastrow AS (SELECT baseItemId, cluster1To1Id FROM ifilt WHERE week_start <= DATE '2001-06-12' QUALIFY row_number() OVER (PARTITION BY baseItemId ORDER BY week_start DESC) = 1)
""", f"""
SELECT 'cluster' AS level, x.cluster1To1Id AS id, CAST(w AS BIGINT) AS campaign_week, week_start, {r('cos(2 * pi() * weekofyear(week_start) / 52)')} AS week_of_year_cos,
       {r('sales_lag_52w')} AS sales_lag_52w, {r('sales_lag_week3')} AS cluster_sales_lag_week3, {r('sales_rolling_4w_week1')} AS cluster_sales_rolling_4w_week1 FROM xat x
UNION ALL
SELECT 'item', y.baseItemId, CAST(y.w AS BIGINT), y.week_start, {r('cos(2 * pi() * weekofyear(y.week_start) / 52)')},
       {r('y.sales_lag_52w')}, {r('coalesce(x.sales_lag_week3, 0)')}, {r('coalesce(x.sales_rolling_4w_week1, 0)')}
FROM yat y JOIN ylastrow l ON y.baseItemId = l.baseItemId LEFT JOIN xat x ON x.cluster1To1Id = l.cluster1To1Id AND x.week_start = y.week_start
"""))
def target_week_scoring(spark, sf):
    """Q11's option: both levels' states on the campaign weeks' own time features and lags."""
    pre = _pre(spark, sf)
    c = FC.target_week_state(pre.cluster_weekly, "cluster", P.FORECAST_DATE, P.CAMPAIGN_START, P.HORIZON)
    i = FC.target_week_state(pre.item_weekly, "item", P.FORECAST_DATE, P.CAMPAIGN_START, P.HORIZON, clusters=pre.cluster_weekly)
    shown = ["campaign_week", "week_start", "week_of_year_cos", "sales_lag_52w", "cluster_sales_lag_week3", "cluster_sales_rolling_4w_week1"]
    rows = c.select(F.lit("cluster").alias("level"), F.col("cluster1To1Id").alias("id"), *shown)
    return finalize(rows.unionByName(i.select(F.lit("item").alias("level"), F.col("baseItemId").alias("id"), *shown)))
