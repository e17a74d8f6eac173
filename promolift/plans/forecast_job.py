"""Forecast job (the current generation's main flow) and its pieces.

preprocess (as of the forecast date, targets kept) -> per level one model for each campaign
week (P1: boosted point model + quantile forest), or one pooled model per level as an option (P2) ->
score the latest state of every target with the campaign on and off -> summary with verdicts.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import forecast as FC
from ..operators import models as M
from ..operators import report as R
from ..operators import training as TR
from ..operators import universe as U
from ..operators.boosting import transform_many
from ..session import union_all
from .preprocess import Preprocessed, materialize, preprocess


@dataclass
class WeekModels:
    """A model for each campaign week of a level."""
    level: str
    weeks: dict[int, M.ModelBundle]


@dataclass
class ForecastResult:
    pre: Preprocessed
    item_model: M.ModelBundle | WeekModels
    cluster_model: M.ModelBundle | WeekModels
    item_predictions: DataFrame
    cluster_predictions: DataFrame

    @cached_property
    def summary(self) -> DataFrame:
        """R1 + R2, planned when it is asked for."""
        csizes = self.pre.cluster_weekly.select("cluster1To1Id", "num_items_in_cluster").distinct()
        return R.campaign_summary(self.item_predictions, self.cluster_predictions, self.pre.items, csizes)


def campaign_items(orders: DataFrame, campaign_id: int) -> DataFrame:
    """Base ids of the items sold on a campaign (the backtest's targets)."""
    return (U.valid_orders(orders).where(F.col("salesCampignId") == campaign_id)
            .select(U.base_item_id(F.col("itemId")).alias("baseItemId")).distinct())


class NoTrainingRows(ValueError):
    """A model has no row to learn from."""


@dataclass
class Training:
    """What a model is to learn: its level, campaign week (0: pooled), frame (written) and features."""
    level: str
    week: int
    frame: DataFrame
    features: list[str]


def pooled_training(df: DataFrame, level: str, targets: DataFrame | None = None, materialize_as: str = "checkpoint") -> list[Training]:
    """The pooled training frame with its temporal split."""
    frame = materialize(TR.pooled_training_frame(df, level, targets if level == "item" else None), materialize_as)
    return [Training(level, 0, frame, TR.feature_list(level))]


def week_training(df: DataFrame, level: str, targets: DataFrame | None = None, materialize_as: str = "checkpoint") -> list[Training]:
    """For each campaign week its balanced frame and split, from one written copy of the
    features."""
    frames = TR.week_training_frames(df, level, targets if level == "item" else None, lambda d: materialize(d, materialize_as))
    return [Training(level, n, frame, TR.feature_list(level, single=False, week=n)) for n, frame in frames.items()]


def fit_models(tasks: list[Training], materialize_as: str = "checkpoint", intervals: bool = True) -> dict[str, M.ModelBundle | WeekModels]:
    """The models of all tasks by level."""
    out = fit_jobs({"": tasks}, materialize_as, intervals)[""]
    if isinstance(out, NoTrainingRows):
        raise out
    return out


def fit_jobs(jobs: dict, materialize_as: str = "checkpoint", intervals: bool = True) -> dict:
    """For each job's tasks its models by level, or ``NoTrainingRows`` where a model has none:
    point models of all jobs in one pass, beside them the forests, which are independent Spark ML
    fits (none without ``intervals``)."""
    names = {(j, i): f"{j}/{t.level}-{t.week}" for j, tasks in jobs.items() for i, t in enumerate(tasks)}
    frames = {names[j, i]: (t.frame, t.features, M.POINT_PARAMS[t.level]) for j, tasks in jobs.items() for i, t in enumerate(tasks)}
    with ThreadPoolExecutor(max_workers=4) as pool:
        forests = {name: pool.submit(M.fit_quantile_forest, *frames[name][:2]) for name in frames if intervals}
        # a table of rows a job: one plan over the frames of all jobs would be large
        rows = union_all([M.written_rows({names[j, i]: (t.frame, t.features) for i, t in enumerate(tasks)}) for j, tasks in jobs.items()])
        points = M.fit_rows(rows, frames)
        metrics = M.evaluate_rows(rows, points)
        lacking = {j: sorted(f"{t.level}-{t.week}" for i, t in enumerate(tasks) if names[j, i] not in points) for j, tasks in jobs.items()}
        whole = {j: tasks for j, tasks in jobs.items() if not lacking[j]}

        def bundle(name, t):
            forest, leaves = forests[name].result() if intervals else (None, None)
            return M.ModelBundle(t.level, t.features, points[name], forest, materialize(leaves, materialize_as) if intervals else None, metrics[name])

        out: dict = {j: NoTrainingRows(f"no training rows for {', '.join(x)}") for j, x in lacking.items() if x}
        for j, tasks in whole.items():
            own = out[j] = {}
            for i, t in enumerate(tasks):
                if t.week == 0:
                    own[t.level] = bundle(names[j, i], t)
                else:
                    own.setdefault(t.level, WeekModels(t.level, {})).weeks[t.week] = bundle(names[j, i], t)
    return out


def score(bundle: M.ModelBundle | WeekModels, scoring: DataFrame, normalizers: DataFrame) -> DataFrame:
    """P3 scoring + M1 denormalisation: (id, campaign_week, campaign_on, prediction_kgl,
    q10_kgl, q50_kgl, q90_kgl); with P1 each week's rows by that week's model."""
    idc, key = TR.id_col(bundle.level), ["score_key", "campaign_week", "campaign_on"]
    weeks = bundle.weeks if isinstance(bundle, WeekModels) else {None: bundle}
    if any(b.forest is not None for b in weeks.values()) and None not in weeks:
        parts = [score(b, scoring.where(F.col("campaign_week") == n), normalizers) for n, b in weeks.items()]
        return parts[0].unionByName(parts[1]).unionByName(parts[2])
    used = sorted({f for b in weeks.values() for f in b.features} - {*key, idc})
    pred = transform_many(scoring.select(*key, idc, *used), {n: b.point for n, b in weeks.items()}, None if None in weeks else "campaign_week") \
        .select(*key, idc, "prediction")
    if None in weeks and bundle.forest is not None:
        j = pred.join(M.forest_quantiles(bundle.forest, bundle.forest_leaves, scoring, "score_key"), "score_key", "left")
    else:
        j = pred.select("*", *[F.lit(None).cast("double").alias(c) for c in ("q10", "q50", "q90")])
    j = j.join(normalizers.select(idc, F.col("normalizer").alias("_n")), idc, "left")
    return j.select(idc, "campaign_week", "campaign_on",
                    FC.denormalize_log(F.col("prediction"), F.col("_n")).alias("prediction_kgl"),
                    FC.denormalize_log(F.col("q10"), F.col("_n")).alias("q10_kgl"),
                    FC.denormalize_log(F.col("q50"), F.col("_n")).alias("q50_kgl"),
                    FC.denormalize_log(F.col("q90"), F.col("_n")).alias("q90_kgl"))


def plan_tables(master: DataFrame, targets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Items of the plan per cluster, and total items per cluster (from the item master)."""
    t = targets.select(F.col(targets.columns[0]).cast("string").alias("baseItemId")).distinct()
    plan = (master.join(t, "baseItemId", "left_semi").groupBy("cluster1To1Id")
            .agg(F.countDistinct("baseItemId").alias("n_on_campaign")))
    sizes = master.groupBy("cluster1To1Id").agg(F.countDistinct("baseItemId").alias("cluster_size"))
    return plan, sizes


@dataclass
class Prepared:
    """A forecast job up to its training: ``tasks`` are to be fitted, ``finish`` scores with their
    models."""
    pre: Preprocessed
    targets: DataFrame
    tasks: list[Training]
    campaign_start: object
    forecast_date: object
    horizon: int
    use_plan: bool
    state: str

    def finish(self, models: dict) -> ForecastResult:
        pre, iw, cw, targets = self.pre, self.pre.item_weekly, self.pre.cluster_weekly, self.targets
        item_model, cluster_model = models["item"], models["cluster"]
        plan, sizes = plan_tables(pre.items, targets)
        t_clusters = pre.items.join(targets.select(F.col(targets.columns[0]).alias("baseItemId")),
                                    "baseItemId", "left_semi").select("cluster1To1Id").distinct()
        if self.state == "target_week":
            li = FC.target_week_state(iw, "item", self.forecast_date, self.campaign_start, self.horizon, targets, cw)
            lc = FC.target_week_state(cw, "cluster", self.forecast_date, self.campaign_start, self.horizon, t_clusters)
        else:
            li, lc = FC.latest_state(iw, "baseItemId", self.forecast_date, targets), FC.latest_state(cw, "cluster1To1Id", self.forecast_date, t_clusters)
        li = TR.fill_feature_nulls(li, "item")
        si = FC.scoring_frame(li, "item", plan if self.use_plan else None, sizes if self.use_plan else None)
        sc = FC.scoring_frame(lc, "cluster", plan if self.use_plan else None)
        ip = score(item_model, si, pre.item_normalizers)
        cp = score(cluster_model, sc, pre.cluster_normalizers)
        return ForecastResult(pre, item_model, cluster_model, ip, cp)


def run_forecast(orders: DataFrame, items: DataFrame, campaigns: DataFrame, targets: DataFrame,
                 campaign_start, forecast_date, horizon: int, use_plan: bool = True,
                 materialize_as: str = "checkpoint", single_model: bool = False, intervals: bool = True,
                 store: str | None = None, state: str = "latest", fit: bool = True) -> ForecastResult | Prepared:
    """The whole job.  ``state``: 'latest' scores each target's last row, as the modelled code
    does (Q11); 'target_week' its campaign weeks' own time features and lags.  ``intervals=False`` leaves q10, q50 and q90 null and fits no forests.
    ``store``: a folder of models; those already trained on equal frames with equal
    parameters are read from there, others trained and saved (S11).  ``fit=False``: the job up to
    its training, for a caller that fits several jobs in one pass."""
    prepare = pooled_training if single_model else week_training
    targets = materialize(targets, materialize_as)   # many steps ask for them; they may come from the order lines
    pre = preprocess(orders, items, campaigns, horizon=horizon, campaign_start=campaign_start,
                     forecast_date=forecast_date, targets=targets, materialize_as=materialize_as)
    iw = materialize(pre.item_weekly, materialize_as)
    cw = materialize(pre.cluster_weekly, materialize_as)
    pre = replace(pre, item_weekly=iw, cluster_weekly=cw)   # what follows reads the written frames
    with ThreadPoolExecutor(max_workers=2) as pool:   # the two levels' frames side by side
        fi = pool.submit(prepare, iw, "item", targets, materialize_as)
        fc = pool.submit(prepare, cw, "cluster", None, materialize_as)
        tasks = fi.result() + fc.result()
    job = Prepared(pre, targets, tasks, campaign_start, forecast_date, horizon, use_plan, state)
    if not fit:
        return job
    if store is None:
        return job.finish(fit_models(tasks, materialize_as, intervals))
    from .model_store import fit_missing
    return job.finish(fit_missing(iw.sparkSession, store, tasks, materialize_as, intervals))


LAG_DATE_MIN_ROWS = 50   # fixed: fewer rows of a campaign week: no model


def run_lag_date(cluster_weekly: DataFrame, normalizers: DataFrame, campaign_start, forecast_date, horizon: int,
                 materialize_as: str = "checkpoint") -> DataFrame:
    """P5, the older cluster-only flow: for each campaign week a model of the rows that have it,
    split at random (P11), scored on the features of the lag date.  Returns cluster1To1Id,
    campaign_week, week_start, feature_week, prediction_kgl, q10, q50 and q90 (kg/L); campaign
    weeks with under 50 rows have none."""
    base, tasks = materialize(cluster_weekly, materialize_as), []
    for n in (1, 2, 3):
        rows = base.where(TR._flag_on("cluster", f"campaign_week_{n}")).withColumn("weight", F.lit(1.0))
        frame = materialize(TR.hash_split(rows, ["cluster1To1Id", "week_start"]), materialize_as)
        if frame.count() >= LAG_DATE_MIN_ROWS:
            tasks.append(Training("cluster", n, frame, TR.COMMON_FEATURES + TR.week_lag_features("cluster", n) + TR.CAMPAIGN_FEATURES))
    if not tasks:
        raise NoTrainingRows(f"no campaign week has {LAG_DATE_MIN_ROWS} rows")
    models = fit_models(tasks, materialize_as)["cluster"]
    asked = FC.lag_date_scoring(base, "cluster1To1Id", forecast_date, campaign_start, horizon).withColumn("campaign_on", F.lit(True)) \
        .withColumn("score_key", F.concat_ws("|", "cluster1To1Id", "campaign_week"))
    asked = materialize(asked, materialize_as)
    out = None
    for n, bundle in models.weeks.items():
        own = score(bundle, asked.where(F.col("campaign_week") == n), normalizers)
        out = own if out is None else out.unionByName(own)
    weeks = asked.select("cluster1To1Id", "campaign_week", "week_start", "feature_week")
    return out.drop("campaign_on").join(weeks, ["cluster1To1Id", "campaign_week"])
