"""Registered queries: training frames (P1, P2, F11) and scoring frames."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import forecast as FC
from ..operators import training as TR
from . import oracle as O
from . import params as P
from .forecast_job import campaign_items, plan_tables
from .q_models import FORECAST_CAMPAIGN
from .registry import _filtered_items, _inputs, _pre, finalize, register

r = O.r


def _sample(week: int) -> str:
    """Balanced sample of a model week: its campaign rows and the 5x most recent baseline
    rows of the same ids."""
    on = f"campaign_week_{week}"
    return f"""
s{week} AS (
  SELECT * FROM ifilt WHERE {on} = 1
  UNION ALL
  SELECT * FROM (
    SELECT * FROM ifilt WHERE baseItemId IN (SELECT baseItemId FROM ifilt WHERE {on} = 1) AND {on} = 0 AND campaign_week_0 = 1
    QUALIFY row_number() OVER (ORDER BY week_start DESC, baseItemId) <= 5 * (SELECT count(*) FROM ifilt WHERE {on} = 1)))"""


def _with(extra: str, final: str) -> str:
    return O.with_base(", " + extra.strip() + "\n" + final)


@register("week_training_frame", _with(", ".join(_sample(k) for k in (1, 2, 3)), " UNION ALL ".join(f"""
SELECT CAST({k} AS BIGINT) AS model_week, baseItemId, week_start, CAST(campaign_week_{k} AS BIGINT) AS on_campaign,
       CASE WHEN campaign_week_{k} = 1 THEN 3.0::DOUBLE ELSE 1.0::DOUBLE END AS weight,
       CASE WHEN rn < CAST(floor(n * 0.6::DOUBLE) AS BIGINT) THEN 'train' WHEN rn < CAST(floor(n * 0.8::DOUBLE) AS BIGINT) THEN 'val' ELSE 'test' END AS split
FROM (SELECT *, row_number() OVER (ORDER BY week_start, baseItemId) - 1 AS rn, count(*) OVER () AS n FROM s{k})
""" for k in (1, 2, 3))))
def week_training_frame(spark, sf):
    """P1 + P10 + W12: the three week models' samples with weights and splits."""
    d, parts = _filtered_items(spark, sf), []
    for k in (1, 2, 3):
        f = TR.week_training_frame(d, "item", k)
        parts.append(f.select(F.lit(k).alias("model_week"), "baseItemId", "week_start",
                              F.col(f"campaign_week_{k}").alias("on_campaign"), "weight", "split"))
    return finalize(parts[0].unionByName(parts[1]).unionByName(parts[2]))


@register("single_model_frame", _with(", ".join(_sample(k) for k in (1, 2, 3)) + """,
stacked AS (""" + " UNION ALL ".join(f"""
  SELECT {k} AS model_week, baseItemId, week_start, CASE WHEN campaign_week_{k} = 1 THEN {k} ELSE 0 END AS cwn,
         campaign_week_1 + campaign_week_2 + campaign_week_3 AS any_on FROM s{k}""" for k in (1, 2, 3)) + """),
placed AS (SELECT *, row_number() OVER (ORDER BY week_start, baseItemId, cwn, model_week) - 1 AS rn, count(*) OVER () AS n FROM stacked)
""", """
SELECT CAST(model_week AS BIGINT) AS model_week, baseItemId, week_start, CAST(cwn AS BIGINT) AS campaign_week_number,
       CASE WHEN any_on > 0 THEN 3.0::DOUBLE ELSE 1.0::DOUBLE END AS weight,
       CASE WHEN rn < CAST(floor(n * 0.6::DOUBLE) AS BIGINT) THEN 'train' WHEN rn < CAST(floor(n * 0.8::DOUBLE) AS BIGINT) THEN 'val' ELSE 'test' END AS split
FROM placed
"""))
def single_model_frame(spark, sf):
    """P2 + W12 + W15: the pooled training frame of the item level."""
    f = TR.pooled_training_frame(_pre(spark, sf).item_weekly, "item")
    return finalize(f.select("model_week", "baseItemId", "week_start", "campaign_week_number", "weight", "split"))


_PLAN = """
targets AS (SELECT DISTINCT regexp_replace(itemId, '^[MSK]', '') AS baseItemId FROM valid WHERE salesCampignId = 69),
plan AS (SELECT m.cluster1To1Id, count(DISTINCT m.baseItemId) AS n_on FROM master m JOIN targets t ON m.baseItemId = t.baseItemId GROUP BY 1),
sizes AS (SELECT cluster1To1Id, count(DISTINCT baseItemId) AS sz FROM master GROUP BY 1),
grid AS (SELECT w, o FROM (VALUES (1), (2), (3)) a(w), (VALUES (true), (false)) b(o))
"""


@register("scoring_frame", _with(_PLAN + f""",
il AS (SELECT baseItemId, week_start, cluster1To1Id, item_share_in_cluster AS share, {O.lag_cols('baseItemId', 4)} FROM ifilt),
state AS (SELECT * FROM il WHERE week_start <= DATE '2001-06-12' QUALIFY row_number() OVER (PARTITION BY baseItemId ORDER BY week_start DESC) = 1),
rows AS (
  SELECT s.*, g.w, g.o, coalesce(p.n_on, 1) AS n, CASE WHEN p.n_on IS NULL THEN 0.0 ELSE p.n_on / greatest(coalesce(z.sz, 1), 1)::DOUBLE END AS cov,
         CASE g.w WHEN 1 THEN sales_lag_week1 WHEN 2 THEN sales_lag_week2 ELSE sales_lag_week3 END AS lag
  FROM state s CROSS JOIN grid g LEFT JOIN plan p ON s.cluster1To1Id = p.cluster1To1Id LEFT JOIN sizes z ON s.cluster1To1Id = z.cluster1To1Id)
""", f"""
SELECT baseItemId, CAST(w AS BIGINT) AS campaign_week, CAST(o AS BIGINT) AS campaign_on,
       CAST(NOT o AS BIGINT) AS campaign_week_0, CAST(o AND w = 1 AS BIGINT) AS campaign_week_1,
       CAST(o AND w = 2 AS BIGINT) AS campaign_week_2, CAST(o AND w = 3 AS BIGINT) AS campaign_week_3,
       CAST(CASE WHEN o THEN n ELSE 0 END AS BIGINT) AS n_campaign_items_in_cluster,
       {r('CASE WHEN o THEN cov ELSE 0.0 END')} AS campaign_coverage,
       CAST(CASE WHEN o THEN w ELSE 0 END AS BIGINT) AS campaign_week_number,
       {r('lag')} AS sales_lag_week1, {r('CASE WHEN o THEN w ELSE 0 END * lag')} AS cwn_x_lag
FROM rows
"""))
def scoring_frame(spark, sf):
    """P3, item level: the latest state times week times campaign on and off, with the plan
    of campaign 69."""
    inp = _inputs(spark, sf)
    pre = _pre(spark, sf)
    plan, sizes = plan_tables(pre.items, campaign_items(inp.orders, FORECAST_CAMPAIGN))
    s = FC.scoring_frame(FC.latest_state(pre.item_weekly, "baseItemId", P.FORECAST_DATE), "item", plan, sizes)
    return finalize(s.select("baseItemId", "campaign_week", "campaign_on", *[f"campaign_week_{k}" for k in range(4)],
                             "n_campaign_items_in_cluster", "campaign_coverage", "campaign_week_number", "sales_lag_week1", "cwn_x_lag"))


@register("cluster_scoring_frame", _with(_PLAN + f""",
nitems AS (SELECT cluster1To1Id, count(DISTINCT baseItemId) AS n FROM ifilt WHERE cluster1To1Id IS NOT NULL GROUP BY 1),
cl AS (SELECT cluster1To1Id, week_start, {O.lag_cols('cluster1To1Id', 4)} FROM cnormed),
state AS (SELECT * FROM cl WHERE week_start <= DATE '2001-06-12' QUALIFY row_number() OVER (PARTITION BY cluster1To1Id ORDER BY week_start DESC) = 1),
rows AS (
  SELECT s.cluster1To1Id, g.w, g.o, least(coalesce(p.n_on, 1)::DOUBLE / greatest(coalesce(i.n, 1), 1)::DOUBLE, 1.0) AS inten,
         CASE g.w WHEN 1 THEN sales_rolling_4w_week1 WHEN 2 THEN sales_rolling_4w_week2 ELSE sales_rolling_4w_week3 END AS roll
  FROM state s CROSS JOIN grid g LEFT JOIN plan p ON s.cluster1To1Id = p.cluster1To1Id LEFT JOIN nitems i ON s.cluster1To1Id = i.cluster1To1Id)
""", f"""
SELECT cluster1To1Id, CAST(w AS BIGINT) AS campaign_week, CAST(o AS BIGINT) AS campaign_on,
       {r('CASE WHEN o THEN 1.0 - inten ELSE 1.0 END')} AS campaign_week_0, {r('CASE WHEN o AND w = 1 THEN inten ELSE 0.0 END')} AS campaign_week_1,
       {r('CASE WHEN o AND w = 2 THEN inten ELSE 0.0 END')} AS campaign_week_2, {r('CASE WHEN o AND w = 3 THEN inten ELSE 0.0 END')} AS campaign_week_3,
       {r('roll')} AS cluster_sales_rolling_4w_week1, {r('CASE WHEN o THEN w ELSE 0 END * roll')} AS cwn_x_rolling
FROM rows
"""))
def cluster_scoring_frame(spark, sf):
    """P3, cluster level: intensities from the plan of campaign 69."""
    inp = _inputs(spark, sf)
    pre = _pre(spark, sf)
    plan, _ = plan_tables(pre.items, campaign_items(inp.orders, FORECAST_CAMPAIGN))
    s = FC.scoring_frame(FC.latest_state(pre.cluster_weekly, "cluster1To1Id", P.FORECAST_DATE), "cluster", plan)
    return finalize(s.select("cluster1To1Id", "campaign_week", "campaign_on", *[f"campaign_week_{k}" for k in range(4)],
                             "cluster_sales_rolling_4w_week1", "cwn_x_rolling"))
