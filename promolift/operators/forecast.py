"""Scoring and non-model forecasts (P3, P4, P5 baseline, W10, A14, P16).

Scoring works on the latest history row of every target, expanded to the three
campaign weeks and the two scenarios (campaign on / off) as columns -- one
DataFrame, one ``transform`` -- instead of a loop over targets and weeks.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import as_date, last_complete_week, lit_date, time_features
from ..functions.mathx import clip, LOG_CLIP_HIGH, LOG_CLIP_LOW
from .features import CLUSTER_CONTEXT, TARGET, add_cluster_aliases, add_cluster_context, add_lag_features
from .training import id_col, week_lag_features

FALLBACK_NORMALIZER = 1000.0   # fixed: kg/L per week when an id has no normalizer
SANE_MAX = 1_000_000.0         # fixed: upper bound of a believable weekly baseline
SEASON_HALF_WIDTH = 2          # fixed: ISO weeks either side of the campaign week


def latest_state(df: DataFrame, idc: str, forecast_date, targets: DataFrame | None = None) -> DataFrame:
    """The last row per id with week_start <= forecast date (ids bounded by weeks)."""
    d = df.where(F.col("week_start") <= lit_date(forecast_date))
    if targets is not None:
        d = d.join(targets.select(F.col(targets.columns[0]).cast("string").alias(idc)), idc, "left_semi")
    w = Window.partitionBy(idc).orderBy(F.col("week_start").desc())
    return d.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def _lags_ahead(hist: DataFrame, idc: str, weeks: list, horizon: int) -> DataFrame:
    """W2/W3 at ``weeks`` ahead of each id's history: weeks without rows in between have no
    value."""
    slim = hist.select(idc, "week_start", TARGET)
    last = slim.groupBy(idc).agg(F.max("week_start").alias("_l")).where(F.col("_l") < F.lit(weeks[-1]))
    ahead = last.select(idc, F.explode(F.sequence(F.date_add("_l", 7), F.lit(weeks[-1]), F.expr("INTERVAL 7 DAYS"))).alias("week_start"), F.lit(None).cast("double").alias(TARGET))
    return add_lag_features(slim.unionByName(ahead), idc, horizon).where(F.col("week_start").isin(weeks)).drop(TARGET)


def target_week_state(df: DataFrame, level: str, forecast_date, campaign_start, horizon: int, targets: DataFrame | None = None,
                      clusters: DataFrame | None = None) -> DataFrame:
    """Q11's option: the latest state of each id once per campaign week, with the time features
    and lags of that week instead of the last row's.  Items take their cluster's lags from
    ``clusters``, the cluster frame."""
    idc, start = id_col(level), as_date(campaign_start)
    weeks = [start + _dt.timedelta(weeks=n) for n in range(3)]
    state = latest_state(df, idc, forecast_date, targets)
    known = df.where(F.col("week_start") <= lit_date(forecast_date)).join(state.select(idc), idc, "left_semi")
    lags = _lags_ahead(known, idc, weeks, horizon)
    renewed = set(lags.columns) - {idc} | {"week_of_year", "year", "week_of_year_sin", "week_of_year_cos"} | set(CLUSTER_CONTEXT)
    out = state.select(*[c for c in state.columns if c not in renewed]).join(lags, idc)
    out = out.select("*", *time_features(F.col("week_start")), (F.floor(F.datediff("week_start", F.lit(start)) / 7) + 1).cast("int").alias("campaign_week"))
    if level == "cluster":
        return add_cluster_aliases(out)
    around = _lags_ahead(clusters.where(F.col("week_start") <= lit_date(forecast_date)), "cluster1To1Id", weeks, horizon)
    return add_cluster_context(out, add_cluster_aliases(around))


def scoring_frame(latest: DataFrame, level: str, plan: DataFrame | None = None,
                  sizes: DataFrame | None = None) -> DataFrame:
    """Latest row x weeks {1,2,3} x scenario {on, off} with the flags and
    competition features the scenario implies.

    ``plan``: (cluster1To1Id, n_on_campaign) items of the plan per cluster;
    ``sizes``: (cluster1To1Id, cluster_size) total items per cluster.  Without a plan
    an item is assumed alone in its cluster with coverage 0 (as the backtest does).
    ``latest`` may hold a row per campaign week already (``target_week_state``)."""
    idc = id_col(level)
    weeks = [F.col("campaign_week")] if "campaign_week" in latest.columns else [F.lit(w) for w in (1, 2, 3)]
    grid = F.explode(F.array(*[F.struct(w.alias("campaign_week"), F.lit(on).alias("campaign_on")) for w in weeks for on in (True, False)]))
    df = latest.select(*[c for c in latest.columns if c != "campaign_week"], grid.alias("_g")).select("*", "_g.campaign_week", "_g.campaign_on").drop("_g")
    on, wk = F.col("campaign_on"), F.col("campaign_week")
    if plan is not None:
        df = df.join(plan.select("cluster1To1Id", "n_on_campaign"), "cluster1To1Id", "left")
    else:
        df = df.withColumn("n_on_campaign", F.lit(None).cast("long"))
    if level == "cluster":
        n = F.coalesce(F.col("n_on_campaign"), F.lit(1)).cast("double")
        inten = F.least(n / F.greatest(F.col("num_items_in_cluster").cast("double"), F.lit(1.0)), F.lit(1.0))
        df = df.withColumn("campaign_week_0", F.when(on, F.lit(1.0) - inten).otherwise(F.lit(1.0)))
        for k in (1, 2, 3):
            df = df.withColumn(f"campaign_week_{k}", F.when(on & (wk == k), inten).otherwise(F.lit(0.0)))
    else:
        if sizes is not None:
            df = df.join(sizes.select("cluster1To1Id", "cluster_size"), "cluster1To1Id", "left")
        else:
            df = df.withColumn("cluster_size", F.lit(None).cast("long"))
        has_plan = F.col("n_on_campaign").isNotNull()
        n = F.when(has_plan, F.col("n_on_campaign")).otherwise(F.lit(1))
        cov = F.when(has_plan, n / F.greatest(F.coalesce(F.col("cluster_size"), F.lit(1)), F.lit(1)))\
            .otherwise(F.lit(0.0))
        share = F.coalesce(F.col("item_share_in_cluster"), F.lit(1.0))
        df = (df.withColumn("campaign_week_0", F.when(on, F.lit(0)).otherwise(F.lit(1)))
              .withColumn("n_campaign_items_in_cluster", F.when(on, n).otherwise(F.lit(0)).cast("long"))
              .withColumn("campaign_coverage", F.when(on, cov).otherwise(F.lit(0.0)).cast("double"))
              .withColumn("coverage_x_share", F.when(on, cov * share).otherwise(F.lit(0.0)).cast("double")))
        for k in (1, 2, 3):
            df = df.withColumn(f"campaign_week_{k}", F.when(on & (wk == k), F.lit(1)).otherwise(F.lit(0)))
        df = df.drop("cluster_size")
    # single-model features: the week's lags under the week-1 names, week number, interactions
    for k in (2, 3):
        for src, dst in zip(week_lag_features(level, k), week_lag_features(level, 1)):
            df = df.withColumn(dst, F.when(wk == k, F.col(src)).otherwise(F.col(dst)))
    lag, roll = week_lag_features(level, 1)[:2]
    df = df.withColumn("campaign_week_number", F.when(on, wk).otherwise(F.lit(0)))
    df = (df.withColumn("cwn_x_lag", F.col("campaign_week_number") * F.col(lag))
          .withColumn("cwn_x_rolling", F.col("campaign_week_number") * F.col(roll)))
    return df.withColumn("score_key", F.concat_ws("|", F.col(idc), wk.cast("string"), on.cast("string")))


def denormalize_log(c, normalizer):
    """M1: clip to [-10, 20], expm1, times the normalizer (fallback 1000)."""
    return F.expm1(clip(c, LOG_CLIP_LOW, LOG_CLIP_HIGH)) * F.coalesce(normalizer, F.lit(FALLBACK_NORMALIZER))


def seasonal_baseline(df: DataFrame, level: str, forecast_date, campaign_start, normalizers: DataFrame,
                      targets: DataFrame | None = None, wrap: bool = False) -> DataFrame:
    """Median kg/L of the target's weeks within +-2 ISO weeks of the campaign's
    ISO week (all its history when none), up to the last complete week; kept when in
    (0, 1e6), else the mean, else 1000.  Same value for the three campaign weeks.  ``wrap``
    (Q19): weeks on both sides of a year's end are near each other."""
    idc = id_col(level)
    cutoff = last_complete_week(forecast_date, campaign_start)
    cw = as_date(campaign_start).isocalendar()[1]
    d = df.where(F.col("week_start") <= F.lit(cutoff))
    if targets is not None:
        d = d.join(targets.select(F.col(targets.columns[0]).cast("string").alias(idc)), idc, "left_semi")
    d = d.join(normalizers.select(idc, F.col("normalizer").alias("_n")), idc, "left")
    kgl = F.expm1(F.col("salesQuantityKgL_log")) * F.coalesce(F.col("_n"), F.lit(FALLBACK_NORMALIZER))
    near = F.weekofyear("week_start").between(cw - SEASON_HALF_WIDTH, cw + SEASON_HALF_WIDTH)
    if wrap:
        away = F.pmod(F.weekofyear("week_start") - cw, F.lit(52))
        near = F.least(away, 52 - away) <= SEASON_HALF_WIDTH
    d = d.select(idc, kgl.alias("kgl"), near.alias("near"))
    agg = d.groupBy(idc).agg(
        F.median(F.when(F.col("near"), F.col("kgl"))).alias("_mn"),
        F.avg(F.when(F.col("near"), F.col("kgl"))).alias("_an"),
        F.median("kgl").alias("_ma"), F.avg("kgl").alias("_aa"),
        F.max(F.col("near").cast("int")).alias("_has_near"))
    med = F.when(F.col("_has_near") == 1, F.col("_mn")).otherwise(F.col("_ma"))
    avg = F.when(F.col("_has_near") == 1, F.col("_an")).otherwise(F.col("_aa"))
    sane = lambda c: (c > 0) & (c < SANE_MAX)
    base = F.when(sane(med), med).when(sane(avg), avg).otherwise(F.lit(FALLBACK_NORMALIZER))
    out = agg.select(idc, base.alias("baseline_kgl"))
    return out.select(idc, F.explode(F.array(F.lit(1), F.lit(2), F.lit(3))).alias("campaign_week"), "baseline_kgl")


def lag_date_features(df: DataFrame, idc: str, lag_weeks: int, value: str = "salesQuantityKgL_log") -> DataFrame:
    """Value at exactly ``week_start - 7*lag_weeks`` days (equi-join on the date)."""
    prev = df.select(idc, F.date_add("week_start", 7 * lag_weeks).alias("week_start"),
                     F.col(value).alias(f"{value}_lag_{lag_weeks}w"))
    return df.join(prev, [idc, "week_start"], "left")


def lag_values(df: DataFrame, idc: str, lags: list[int], value: str = "salesQuantityKgL_log") -> DataFrame:
    """The values at exactly ``week_start - 7 * lag`` days for all ``lags`` at once: every
    row is sent to the weeks that look back on it, summed up to one row a week, and joined
    by date.  Columns ``{value}_lag_{k}w``, null where that week has no row."""
    sent = df.select(idc, F.col(value).alias("_v"), "week_start", F.explode(F.array(*[F.lit(k) for k in lags])).alias("_lag"))
    sent = sent.groupBy(idc, F.date_add("week_start", F.col("_lag") * 7).alias("week_start")).agg(
        *[F.max(F.when(F.col("_lag") == k, F.col("_v"))).alias(f"{value}_lag_{k}w") for k in lags])
    return df.join(sent, [idc, "week_start"], "left")


def lag_date_scoring(df: DataFrame, idc: str, forecast_date, campaign_start, horizon: int, targets: DataFrame | None = None) -> DataFrame:
    """P5 scoring rows: for each id with rows up to the last complete week and each campaign
    week N, the features of the row at the lag date (``horizon + N - 1`` weeks before the
    forecast week), with the forecast week's own time features and campaign flags.
    ``feature_week`` is the lag date, ``week_start`` the forecast week."""
    cutoff, start = last_complete_week(forecast_date, campaign_start), as_date(campaign_start)
    d = df.where(F.col("week_start") <= F.lit(cutoff))
    if targets is not None:
        d = d.join(targets.select(F.col(targets.columns[0]).cast("string").alias(idc)).distinct(), idc, "left_semi")
    week = [start + _dt.timedelta(weeks=n) for n in range(3)]
    # only three dates are looked up: rows of other weeks are filtered before anything else
    asked = F.explode(F.filter(F.array(*[F.struct(F.lit(n + 1).alias("n"), F.lit(week[n]).alias("w"), F.lit(week[n] - _dt.timedelta(weeks=horizon + n)).alias("lag")) for n in range(3)]),
                               lambda x: x["lag"] == F.col("week_start")))
    own = ["week_of_year", "year", "week_of_year_sin", "week_of_year_cos", *[f"campaign_week_{k}" for k in range(4)]]
    rows = d.select(*[c for c in df.columns if c not in own], asked.alias("_a"))
    rows = rows.withColumn("feature_week", F.col("week_start")).withColumn("week_start", F.col("_a.w")).withColumn("campaign_week", F.col("_a.n")).drop("_a")
    rows = rows.select("*", *time_features(F.col("week_start")), F.lit(0.0).alias("campaign_week_0"),
                       *[(F.col("campaign_week") == k).cast("double").alias(f"campaign_week_{k}") for k in (1, 2, 3)])
    return rows


def last_year_sales(weekly: DataFrame, idc: str, campaign_start, value: str = "salesQuantityKgL") -> DataFrame:
    """Sales in the same three weeks one calendar year back (Monday aligned), as
    week 1..3, for every id: 0 for a missing week of an id with rows in that window,
    nulls for an id without."""
    start = as_date(campaign_start)
    try:
        ly = start.replace(year=start.year - 1)
    except ValueError:   # 29 February
        ly = start.replace(year=start.year - 1, day=28)
    ly = ly - _dt.timedelta(days=ly.weekday())
    rows = weekly.where((F.col("week_start") >= F.lit(ly)) &
                        (F.col("week_start") < F.lit(ly + _dt.timedelta(days=21))))
    wn = (F.floor(F.datediff("week_start", F.lit(ly)) / 7) + 1).cast("int")
    p = rows.groupBy(idc).agg(*[F.sum(F.when(wn == k, F.col(value)).otherwise(0.0)).alias(f"last_year_w{k}")
                                for k in (1, 2, 3)])
    return weekly.select(idc).distinct().join(p, idc, "left")
