"""Feature operators.

All windows are partitioned by an id whose rows are one per calendar week, so a
partition holds at most the number of weeks of history.  The category recency
(J10/W5) runs on the distinct (category, week) set, also bounded by weeks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import time_features
from ..functions.mathx import shrink
from ..functions.stats import exact_median
from ..schemas import CATEGORY_FEATURES, CATEGORY_IDS
from .universe import on_campaign

TARGET = "salesQuantityKgL_log"
NO_HISTORY_WEEKS = 104       # fixed: recency when a category never had a campaign
NEW_CAMPAIGN_GAP_DAYS = 21   # fixed: a gap over 21 days starts a new campaign
LOOKBACK_DAYS = 84           # fixed: 12-week look-back for the campaign item share


# --- A6 ----------------------------------------------------------------------------

def _plain_weeks(df: DataFrame):
    plain = F.col("campaign_week_0") == 1
    return plain & (F.col("is_post_campaign") == 0) if "is_post_campaign" in df.columns else plain


def with_normalizers(df: DataFrame, id_col: str) -> DataFrame:
    """``df`` with ``_norm``, its id's normalizer as ``compute_normalizers`` finds it: over the id's
    rows (one a week) in the partition that the windows before it made, without a join."""
    w = Window.partitionBy(id_col)
    sales = F.when(_plain_weeks(df), F.col("salesQuantityKgL"))
    d = df.withColumns({"_med": F.median(sales).over(w), "_avg": F.avg(sales).over(w)})
    norm = F.when(F.col("_med") > 0, F.col("_med")).otherwise(F.col("_avg"))
    return d.withColumn("_norm", F.when(F.col(id_col).isNotNull(), norm)).drop("_med", "_avg")


def compute_normalizers(df: DataFrame, id_col: str) -> DataFrame:
    """A6 (training mode): per id, the median kg/L of baseline weeks that are not
    post-campaign; the mean when that median is <= 0."""
    agg = df.where(_plain_weeks(df)).groupBy(id_col).agg(F.median("salesQuantityKgL").alias("_med"),
                                   F.avg("salesQuantityKgL").alias("_avg"))
    return agg.select(id_col, F.when(F.col("_med") > 0, F.col("_med")).otherwise(F.col("_avg"))
                      .alias("normalizer"))


def normalize(df: DataFrame, id_col: str, normalizers: DataFrame | None = None, materialize_fn=None):
    """``salesQuantityKgL_log = log1p(kgL / normalizer)``.

    Ids without a positive normalizer use the exact global median of kg/L over all
    rows (computed without a single-task buffer).  With ``materialize_fn`` the frame
    with its normalizer attached is materialised first, so the medians are computed
    once and the fallback check is a scan.  Returns (frame, normalizers)."""
    if normalizers is None and materialize_fn is not None:
        norms, j = None, with_normalizers(df, id_col)
    else:
        norms = normalizers if normalizers is not None else compute_normalizers(df, id_col)
        j = df.join(norms.select(id_col, F.col("normalizer").alias("_norm")), id_col, "left")
    if materialize_fn is not None:
        j = materialize_fn(j)
        if norms is None:
            norms = (j.where(F.col("_norm").isNotNull()).groupBy(id_col)
                     .agg(F.first("_norm").alias("normalizer")))
    good = F.col("_norm").isNotNull() & (F.col("_norm") > 0)
    needs = j.where(~good).limit(1).count() > 0
    if needs:
        fallback = exact_median(j, "salesQuantityKgL")
        norm = F.when(good, F.col("_norm")).otherwise(F.lit(fallback).cast("double"))
    else:
        norm = F.col("_norm")
    out = j.withColumn(TARGET, F.log1p(F.try_divide(F.col("salesQuantityKgL"), norm))).drop("_norm")
    return out, norms


# --- T2 ------------------------------------------------------------------------------

def add_time_features(df: DataFrame) -> DataFrame:
    return df.select("*", *time_features(F.col("week_start")))


# --- W2 / W3 ---------------------------------------------------------------------------

def add_lag_features(df: DataFrame, id_col: str, horizon: int, target: str = TARGET) -> DataFrame:
    """Per campaign week N (1..3) the value ``horizon+N`` weeks back and the
    mean of the 4 values ending there; plus 12- and 52-week lags; nulls -> 0."""
    w = Window.partitionBy(id_col).orderBy("week_start")
    cols = []
    for n in (1, 2, 3):
        lag = horizon + n
        cols.append(F.coalesce(F.lag(target, lag).over(w), F.lit(0.0)).alias(f"sales_lag_week{n}"))
        cols.append(F.coalesce(F.avg(target).over(w.rowsBetween(-(lag + 3), -lag)), F.lit(0.0))
                    .alias(f"sales_rolling_4w_week{n}"))
    cols.append(F.coalesce(F.lag(target, 12).over(w), F.lit(0.0)).alias("sales_lag_12w"))
    cols.append(F.coalesce(F.lag(target, 52).over(w), F.lit(0.0)).alias("sales_lag_52w"))
    return df.select("*", *cols)


def add_cluster_aliases(cluster_df: DataFrame) -> DataFrame:
    for n in (1, 2, 3):
        cluster_df = (cluster_df
                      .withColumn(f"cluster_sales_lag_week{n}", F.col(f"sales_lag_week{n}"))
                      .withColumn(f"cluster_sales_rolling_4w_week{n}", F.col(f"sales_rolling_4w_week{n}")))
    return cluster_df


CLUSTER_CONTEXT = [f"cluster_sales_lag_week{n}" for n in (1, 2, 3)] + \
                  [f"cluster_sales_rolling_4w_week{n}" for n in (1, 2, 3)]


def add_cluster_context(item_df: DataFrame, cluster_df: DataFrame) -> DataFrame:
    """The cluster's lag / rolling columns onto its items (missing -> 0)."""
    c = cluster_df.select("cluster1To1Id", "week_start", *CLUSTER_CONTEXT)
    out = item_df.join(c, ["cluster1To1Id", "week_start"], "left")
    return out.fillna(0.0, subset=CLUSTER_CONTEXT)


# --- C2 / J9 ---------------------------------------------------------------------------

def add_cluster_metadata(cluster_df: DataFrame, item_df: DataFrame) -> DataFrame:
    """Number of distinct items per cluster (from the item frame), default 1."""
    sizes = (item_df.where(F.col("cluster1To1Id").isNotNull()).groupBy("cluster1To1Id")
             .agg(F.countDistinct("baseItemId").alias("num_items_in_cluster")))
    return (cluster_df.join(sizes, "cluster1To1Id", "left")
            .withColumn("num_items_in_cluster",
                        F.coalesce(F.col("num_items_in_cluster"), F.lit(1)).cast("long")))


def campaign_item_share(item_df: DataFrame, lookback_days: int = LOOKBACK_DAYS) -> DataFrame:
    """J9 as range windows: for each campaign item-week, the item's and its cluster's
    summed baseline log-sales over ``[week - 84 days, week)`` and their ratio (0 when
    the cluster sum is not positive).  One row per (cluster, week, campaign item)."""
    day = F.unix_date(F.col("week_start")).cast("long")
    base_val = F.when(F.col("campaign_week_0") == 1, F.col(TARGET)).otherwise(F.lit(0.0))
    wi = Window.partitionBy("baseItemId").orderBy(day).rangeBetween(-lookback_days, -1)
    items = (item_df.select("baseItemId", "cluster1To1Id", "week_start", "campaign_week_1",
                            "campaign_week_2", "campaign_week_3",
                            F.sum(base_val).over(wi).alias("item_recent")))
    camp = items.where(on_campaign())
    cl = (item_df.where(F.col("campaign_week_0") == 1)
          .groupBy("cluster1To1Id", "week_start").agg(F.sum(TARGET).alias("_b")))
    # every week that carries a campaign row must be present to look back from it
    keys = camp.select("cluster1To1Id", "week_start").distinct()
    cl = keys.join(cl, ["cluster1To1Id", "week_start"], "full").fillna(0.0, subset=["_b"])
    wc = Window.partitionBy("cluster1To1Id").orderBy(F.unix_date(F.col("week_start")).cast("long")) \
        .rangeBetween(-lookback_days, -1)
    cl = cl.select("cluster1To1Id", "week_start", F.sum("_b").over(wc).alias("cluster_recent"))
    j = camp.join(cl, ["cluster1To1Id", "week_start"], "inner")
    it = F.coalesce(F.col("item_recent"), F.lit(0.0))
    ct = F.coalesce(F.col("cluster_recent"), F.lit(0.0))
    return j.select("cluster1To1Id", "week_start", "baseItemId",
                    it.alias("item_recent"), ct.alias("cluster_recent"),
                    F.when(ct > 0, it / ct).otherwise(F.lit(0.0)).alias("campaign_item_share"))


# --- C3: category lift, recency, frequency -----------------------------------------------

def campaign_deviations(weekly: DataFrame, master: DataFrame) -> DataFrame:
    """A7 observations: every campaign week of an item with its categories and ``deviation``, the
    log sales less the item's median over plain weeks."""
    plain = weekly.where(F.col("campaign_week_0") == 1).groupBy("baseItemId").agg(F.median(TARGET).alias("_usual"))
    told = weekly.where(on_campaign()).select("baseItemId", "week_start", TARGET).join(plain, "baseItemId", "left")
    ids = [c for c in CATEGORY_IDS if c in master.columns]
    return told.join(master.select("baseItemId", *ids), "baseItemId", "left").select("week_start", *ids, (F.col(TARGET) - F.col("_usual")).alias("deviation"))


def _by_level(rows: DataFrame, *kept: str) -> DataFrame:
    """Each row once per category level that it has: ``level``, ``category``, ``kept``."""
    pairs = [F.struct(F.lit(n).alias("level"), F.col(c).alias("category")) for n, c in enumerate(CATEGORY_IDS, 1) if c in rows.columns]
    return rows.select(*kept, F.inline(F.array(*pairs))).where(F.col("category").isNotNull())


def category_lifts(observed: DataFrame) -> DataFrame:
    """Mean deviation and its count for every category of every level, in one aggregate."""
    return _by_level(observed, "deviation").groupBy("level", "category").agg(F.avg("deviation").alias("mean_lift"), F.count("deviation").alias("n_obs"))


def earlier_category_lifts(observed: DataFrame, asked: DataFrame) -> DataFrame:
    """Q17 as of each week: mean deviation and count of a category's observations of strictly
    earlier weeks, for the (level, category, week_start) rows of ``asked``.  Running sums see
    one row a category and week."""
    own = _by_level(observed, "week_start", "deviation").groupBy("level", "category", "week_start").agg(F.sum("deviation").alias("s"), F.count("deviation").alias("n"))
    none = asked.select("level", "category", "week_start", F.lit(0.0).alias("s"), F.lit(0).cast("long").alias("n"))
    weeks = own.unionByName(none).groupBy("level", "category", "week_start").agg(F.coalesce(F.sum("s"), F.lit(0.0)).alias("s"), F.sum("n").alias("n"))
    before = Window.partitionBy("level", "category").orderBy("week_start").rowsBetween(Window.unboundedPreceding, -1)
    s, n = F.sum("s").over(before), F.coalesce(F.sum("n").over(before), F.lit(0))
    return weeks.select("level", "category", "week_start", F.try_divide(s, n).alias("mean_lift"), n.alias("n_obs"))


def item_week_lifts(item_df: DataFrame, observed: DataFrame, master: DataFrame) -> DataFrame:
    """``item_lifts`` of strictly earlier weeks, per item and week."""
    rows = _by_level(item_df.select("baseItemId", "week_start").join(master.select("baseItemId", *[c for c in CATEGORY_IDS if c in master.columns]), "baseItemId"), "baseItemId", "week_start")
    found = rows.join(earlier_category_lifts(observed, rows.select("level", "category", "week_start").distinct()), ["level", "category", "week_start"])
    return _blended(found, ["baseItemId", "week_start"])


def item_lifts(observed: DataFrame, master: DataFrame) -> DataFrame:
    """M3 per item of the master: the four levels' lifts (0 where unseen), the count of the most
    specific one and the blend; the lifts meet the items, not their weeks."""
    return _blended(_by_level(master, "baseItemId").join(category_lifts(observed), ["level", "category"]), ["baseItemId"])


def _blended(found: DataFrame, keys: list[str]) -> DataFrame:
    """The levels' lifts side by side per key, with their blend (M3)."""
    at = lambda c, n: F.max(F.when(F.col("level") == n, F.col(c)))
    found = found.groupBy(*keys).agg(*[F.coalesce(at("mean_lift", n), F.lit(0.0)).alias(f"cat_lift_l{n}") for n in range(1, 5)],
                                            *[F.coalesce(at("n_obs", n), F.lit(0)).cast("long").alias(f"_n{n}") for n in range(1, 5)])
    blend = shrink([(F.col(f"cat_lift_l{n}"), F.col(f"_n{n}").cast("double")) for n in range(1, 5)])
    return found.select(*keys, *[f"cat_lift_l{n}" for n in range(1, 5)], blend.alias("best_cat_lift"), F.col("_n4").alias("cat_n_obs_l4"))


def category_recency(df: DataFrame, obs: DataFrame, cat_col: str = CATEGORY_IDS[-1]) -> DataFrame:
    """J10 + W5 on the distinct (category, week) set: weeks since the category's last
    campaign week strictly before this week (104 when none) and the number of
    campaigns before this week (a gap over 21 days starts a new one)."""
    cw = obs.where(F.col(cat_col).isNotNull()).select(cat_col, "week_start").distinct()
    wcat = Window.partitionBy(cat_col).orderBy("week_start")
    cw = cw.select(cat_col, "week_start", F.lit(1).alias("_is_cw"),
                   F.when(F.lag("week_start").over(wcat).isNull()
                          | (F.datediff("week_start", F.lag("week_start").over(wcat)) > NEW_CAMPAIGN_GAP_DAYS),
                          F.lit(1)).otherwise(F.lit(0)).alias("_new"))
    keys = df.where(F.col(cat_col).isNotNull()).select(cat_col, "week_start").distinct()
    grid = keys.join(cw, [cat_col, "week_start"], "full")
    before = wcat.rowsBetween(Window.unboundedPreceding, -1)
    g = grid.select(
        cat_col, "week_start",
        F.max(F.when(F.col("_is_cw") == 1, F.col("week_start"))).over(before).alias("_last"),
        F.sum(F.coalesce(F.col("_new"), F.lit(0))).over(before).alias("_n"))
    return g.select(
        cat_col, "week_start",
        F.when(F.col("_last").isNull(), F.lit(NO_HISTORY_WEEKS))
         .otherwise((F.datediff("week_start", "_last") / 7).cast("int")).cast("long")
         .alias("weeks_since_last_campaign_l4"),
        F.coalesce(F.col("_n"), F.lit(0)).cast("long").alias("n_campaigns_historical_l4"))


def add_category_lift_features(item_df: DataFrame, master: DataFrame, asof: bool = False) -> DataFrame:
    """cat_lift_l1..l4, best_cat_lift (M3 shrinkage), cat_n_obs_l4, recency and
    frequency at L4, by one join on the item and one on (category, week).  Without category
    columns all eight features are 0.  ``asof`` (Q17): lifts of strictly earlier weeks."""
    counts = {"cat_n_obs_l4": 0, "weeks_since_last_campaign_l4": NO_HISTORY_WEEKS, "n_campaigns_historical_l4": 0}
    if not any(c in master.columns for c in CATEGORY_IDS):
        return item_df.withColumns({c: F.lit(0).cast("long") if c in counts else F.lit(0.0) for c in CATEGORY_FEATURES})
    observed = campaign_deviations(item_df, master)
    finest = [c for c in CATEGORY_IDS[-1:] if c in master.columns]
    if asof:
        df = item_df.join(master.select("baseItemId", *finest), "baseItemId", "left").join(item_week_lifts(item_df, observed, master), ["baseItemId", "week_start"], "left")
    else:
        items = master.select("baseItemId", *finest).join(item_lifts(observed, master), "baseItemId", "left")
        df = item_df.join(items, "baseItemId", "left")
    for c in finest:
        df = df.join(category_recency(df, observed, c), [c, "week_start"], "left").drop(c)
    missing = {c: F.lit(None) for c in CATEGORY_FEATURES if c not in df.columns}
    df = df.withColumns(missing) if missing else df
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(counts[c])).cast("long") if c in counts else F.coalesce(F.col(c), F.lit(0.0)) for c in CATEGORY_FEATURES})
