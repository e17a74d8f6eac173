"""Walk-forward validation and parameter search.

The balanced frames of all (model week, fold) pairs are written once as rows of the pair's
data set, in one table.  A validation then grows all its models in one pass
(``boosting.fit_many``); a search runs its trials side by side, fold after fold: all trials
still in the race grow on the fold together, and after it those behind the median are
stopped.  Collected are one row per calendar week and one score per trial and fold.
"""

from __future__ import annotations

import math
import random
from statistics import median

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.metrics import smape
from ..operators import models as M
from ..operators import training as TR
from ..operators.boosting import Boosting, Fit, fit_many, predict_many
from ..session import cut_lineage

MIN_TRAIN, MIN_VAL, MIN_VAL_CAMPAIGN = 50, 10, 3   # fixed: fold skip thresholds
NO_SCORE = 100.0                                  # fixed: score when no fold is usable
START_TRIALS = 5                                  # fixed: trials that are never stopped
PATIENCE = 50                                     # fixed: rounds without gain

# Fixed search ranges.
SEARCH_SPACE = {
    "leaves": (8, 64),
    "step": (0.005, 0.1),              # log-uniform
    "columns": (0.5, 1.0),
    "rows": (0.5, 1.0),
    "rows_every": (1, 10),
    "depth": (3, 10),
    "least_rows": (10, 100),
    "l1": (1e-4, 1.0),                 # log-uniform
    "l2": (1e-4, 1.0),                 # log-uniform
    "rounds": (100, 800),
}
LOGARITHMIC = ("step", "l1", "l2")


def fold_frames(df: DataFrame, level: str, n_folds: int = 3) -> tuple[DataFrame, dict[str, dict]]:
    """The rows of every (model week N, fold k), written: data ``wN-fK``, row, split (train: the
    balanced sample (W15) of the weeks up to cut k; val: the weeks up to cut k + 1), label,
    weight, features and ``scored`` (a campaign row of val).  And per data set its week,
    fold, whole row counts and whether there is enough to train."""
    idc = TR.id_col(level)
    had = df.groupBy(idc).agg(*[F.max(TR._flag_on(level, f"campaign_week_{n}").cast("int")).alias(f"_had{n}") for n in (1, 2, 3)])
    # one written copy with the features filled, which every sample below reads
    d = cut_lineage(TR.fill_feature_nulls(df, level).join(had, idc), f"{level}-folds")
    own = {n: F.col(f"_had{n}") == 1 for n in (1, 2, 3)}
    camp = {n: own[n] & TR._flag_on(level, f"campaign_week_{n}") for n in own}
    base = {n: own[n] & (F.col(f"campaign_week_{n}") == 0) & TR._flag_on(level, "campaign_week_0") for n in own}
    stats = d.groupBy("week_start").agg(*[F.count_if(c[n]).alias(f"{x}{n}") for x, c in (("all", own), ("camp", camp), ("base", base)) for n in own])
    stats = sorted(stats.collect(), key=lambda r: r["week_start"])   # a row a calendar week
    out, info = None, {}
    for n in own:
        feats = TR.feature_list(level, single=False, week=n)
        weeks = [r for r in stats if r[f"all{n}"]]
        for k, tc, vc in TR.fold_cutoffs([r["week_start"] for r in weeks], n_folds):
            early = [r for r in weeks if r["week_start"] <= tc]
            late = [r for r in weeks if tc < r["week_start"] <= vc]
            n_train, n_val = sum(r[f"all{n}"] for r in early), sum(r[f"all{n}"] for r in late)
            usable = n_train >= MIN_TRAIN and n_val >= MIN_VAL and sum(r[f"camp{n}"] for r in late) >= MIN_VAL_CAMPAIGN
            name = f"w{n}-f{k}"
            info[name] = dict(week=n, fold=k, n_train=n_train, n_val=n_val, usable=usable, features=feats)
            if not usable:
                continue
            wanted = TR.BASELINE_MULTIPLE * sum(r[f"camp{n}"] for r in early)
            edge, rest = None, wanted
            for r in reversed(early):
                if r[f"base{n}"] >= rest:
                    edge = r["week_start"]
                    break
                rest -= r[f"base{n}"]
            week = F.col("week_start")
            kept = base[n] & (week <= F.lit(tc)) & ((week > F.lit(edge)) if edge is not None else F.lit(True))
            train = d.where((camp[n] & (week <= F.lit(tc))) | kept).withColumn("split", F.lit("train"))
            if edge is not None and rest:
                last = d.where(base[n] & (week == F.lit(edge)))
                last = last.withColumn("_rn", F.row_number().over(Window.partitionBy("week_start").orderBy(idc))).where(F.col("_rn") <= rest).drop("_rn")
                train = train.unionByName(last.withColumn("split", F.lit("train")))
            val = d.where(own[n] & (week > F.lit(tc)) & (week <= F.lit(vc))).withColumn("split", F.lit("val"))
            # validation rows weigh 1, as in the modelled code
            w = F.when(F.col("split") == "train", TR.sample_weight(level, single=False, week=n)).otherwise(1.0)
            both = train.unionByName(val).withColumn("weight", w)
            scored = (F.col("split") == "val") & TR._flag_on(level, f"campaign_week_{n}")
            rows = M.training_rows(both, feats, name, TR.TARGET, scored=scored)
            out = rows if out is None else out.unionByName(rows)
    if out is None:
        out = df.sparkSession.createDataFrame([], "data string, row long, split string, label double, weight double, features array<double>, scored boolean")
    return cut_lineage(out, f"{level}-fold-rows"), info


def fold_scores(rows: DataFrame, info: dict[str, dict], fits: list[Fit]) -> dict[str, float]:
    """Grow ``fits`` and score each on its data set's scored rows: SMAPE on the expm1 scale."""
    names = sorted({f.data for f in fits})
    if not names:
        return {}
    rows = rows.where(F.col("data").isin(names))
    models = fit_many(rows, fits, {d: info[d]["features"] for d in names})
    told = predict_many(rows.where("scored"), {f.model: (f.data, models[f.model]) for f in fits if f.model in models})
    found = told.groupBy("model").agg(smape(F.expm1("label"), F.expm1("prediction")).alias("s"))
    return {r["model"]: float(r["s"]) for r in found.collect() if r["s"] is not None}


def walk_forward_cv(df: DataFrame, level: str, params: Boosting | None = None, n_folds: int = 3) -> list[tuple]:
    """Per model week N and fold k, train on weeks up to cut k (balanced, W15),
    validate on (cut k, cut k+1]; SMAPE (expm1 scale) on the validation campaign rows.
    Returns (model_week, fold, n_train, n_val, smape) rows; smape None when skipped."""
    rows, info = fold_frames(df, level, n_folds)
    scores = fold_scores(rows, info, [Fit(d, d, params or M.POINT_PARAMS[level]) for d, i in info.items() if i["usable"]])
    return [(i["week"], i["fold"], i["n_train"], i["n_val"], scores.get(d)) for d, i in info.items()]


def mean_score(vals: list[float]) -> float:
    return float(sum(vals) / len(vals)) if vals else NO_SCORE


def sample_params(rng: random.Random) -> Boosting:
    def one(name):
        lo, hi = SEARCH_SPACE[name]
        if name in LOGARITHMIC:
            return math.exp(rng.uniform(math.log(lo), math.log(hi)))
        return rng.randint(lo, hi) if isinstance(lo, int) else rng.uniform(lo, hi)

    return Boosting(**{name: one(name) for name in SEARCH_SPACE}, patience=PATIENCE)


def stopped(scores: dict[int, list[float]], racing: list[int]) -> list[int]:
    """Trials to stop after a fold: their mean so far is above the median of the racing
    trials' means.  The first ``START_TRIALS`` trials go on in any case."""
    means = {t: mean_score(scores[t]) for t in racing}
    line = median(means.values()) if means else 0.0
    return [t for t in racing if t >= START_TRIALS and means[t] > line]


def random_search(spark: SparkSession, df: DataFrame, level: str, n_trials: int, seed: int = 42,
                  n_folds: int = 3) -> DataFrame:
    """Seeded random search over the ranges, minimising mean walk-forward SMAPE.
    Returns one row per trial with its parameters, its mean score over ``n_folds_run`` folds,
    whether it was ``stopped`` before the last, and an is_best flag."""
    rng = random.Random(seed)
    trials = [sample_params(rng) for _ in range(n_trials)]
    rows, info = fold_frames(df, level, n_folds)
    folds = [d for d, i in info.items() if i["usable"]]
    racing, scores, ended = list(range(n_trials)), {t: [] for t in range(n_trials)}, set()
    for step, d in enumerate(folds):
        found = fold_scores(rows, info, [Fit(f"{t}", d, trials[t]) for t in racing])
        for t in racing:
            if f"{t}" in found:
                scores[t].append(found[f"{t}"])
        if step + 1 < len(folds):
            out = stopped(scores, racing)
            ended.update(out)
            racing = [t for t in racing if t not in out]
    best = min(racing, key=lambda t: (mean_score(scores[t]), t), default=None)
    data = [(t, level, mean_score(scores[t]), len(scores[t]), t in ended, *[float(getattr(p, n)) for n in SEARCH_SPACE], t == best) for t, p in enumerate(trials)]
    return spark.createDataFrame(data, "trial long, level string, mean_smape double, n_folds_run long, stopped boolean, "
                                       + ", ".join(f"{n} double" for n in SEARCH_SPACE) + ", is_best boolean")


def save_best(trials: DataFrame, path: str) -> None:
    """The best trial as a one-row JSON record."""
    trials.where("is_best").drop("is_best").coalesce(1).write.mode("overwrite").json(path)
