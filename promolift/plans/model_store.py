"""Models saved, loaded, and trained only if missing.

A model's folder holds, per campaign week, the point model's trees (Parquet), the forest
(Spark ML's own format), the leaf histograms (Parquet) and one JSON row of level, week,
features and metrics, written last: a folder without it counts as missing.  Paths may be on
any file system that Spark writes.

A job names a model's folder by a key: level, week, parameters, features and a fingerprint
of the training frame (its rows, and the xor of their hashes, from one aggregate), so equal
frames find their model again and changed data trains anew.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..operators import models as M
from ..operators.boosting import Boosted
from .forecast_job import Training, WeekModels, fit_models


META = "level string, week int, features string, metrics string, intervals boolean"


def save(spark: SparkSession, model: M.ModelBundle | WeekModels, path: str) -> None:
    weeks = model.weeks if isinstance(model, WeekModels) else {0: model}
    for n, b in weeks.items():
        b.point.save(spark, f"{path}/week-{n}/point")
        if b.forest is not None:
            b.forest.write().overwrite().save(f"{path}/week-{n}/forest")
            b.forest_leaves.write.mode("overwrite").parquet(f"{path}/week-{n}/leaves")
    rows = [(b.level, n, json.dumps(b.features), json.dumps(b.metrics), b.forest is not None) for n, b in weeks.items()]
    spark.createDataFrame(rows, META).coalesce(1) \
        .write.mode("overwrite").json(f"{path}/meta")


def load(spark: SparkSession, path: str) -> M.ModelBundle | WeekModels | None:
    """The saved model, or None where there is none."""
    try:
        meta = spark.read.schema(META).json(f"{path}/meta").collect()
    except AnalysisException:
        return None
    def bundle(r):
        at = f"{path}/week-{r['week']}"
        forest, leaves = (PipelineModel.load(f"{at}/forest"), spark.read.parquet(f"{at}/leaves")) if r["intervals"] else (None, None)
        return M.ModelBundle(r["level"], json.loads(r["features"]), Boosted.load(spark, f"{at}/point"), forest, leaves, json.loads(r["metrics"]))

    weeks = {r["week"]: bundle(r) for r in meta}
    if not weeks:
        return None
    return weeks[0] if set(weeks) == {0} else WeekModels(meta[0]["level"], dict(sorted(weeks.items())))


def load_or_train(spark: SparkSession, path: str, train: Callable[[], M.ModelBundle | WeekModels]):
    """The saved model; trained and saved first where it is missing."""
    model = load(spark, path)
    if model is None:
        save(spark, train(), path)
        model = load(spark, path)
    return model


def model_key(task: Training, intervals: bool = True) -> str:
    """The name of a task's model: equal frames, features and parameters have equal names."""
    rows = task.frame.select("split", "weight", "salesQuantityKgL_log", *task.features)
    h = F.xxhash64(*rows.columns)
    # copies cancel out in one xor: their number joins the second
    seen = rows.groupBy(h.alias("h")).agg(F.count("*").alias("n")).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.bit_xor(F.xxhash64("h", "n")).alias("a"), F.bit_xor(F.xxhash64(F.lit(1), "h", "n")).alias("b")).first()
    told = json.dumps([task.level, task.week, task.features, repr(M.POINT_PARAMS[task.level]), sorted(M.FOREST_PARAMS.items()), intervals, list(seen)])
    return f"{task.level}-{task.week}-{hashlib.sha256(told.encode()).hexdigest()[:32]}"


def fit_missing(spark: SparkSession, store: str, tasks: list[Training], materialize_as: str = "checkpoint", intervals: bool = True):
    """The models of ``tasks`` by level, as ``fit_models`` gives them: read from ``store`` where
    they are, the others fitted in one pass and saved."""
    at = {(t.level, t.week): f"{store.rstrip('/')}/{model_key(t, intervals)}" for t in tasks}
    held = {k: load(spark, path) for k, path in at.items()}
    missing = [t for t in tasks if held[(t.level, t.week)] is None]
    if missing:
        fitted = fit_models(missing, materialize_as, intervals)
        for t in missing:
            b = fitted[t.level] if t.week == 0 else fitted[t.level].weeks[t.week]
            one = b if t.week == 0 else WeekModels(t.level, {t.week: b})
            save(spark, one, at[(t.level, t.week)])
            held[(t.level, t.week)] = one
    out: dict = {}
    for (level, week), m in held.items():
        if week == 0:
            out[level] = m
        else:
            out.setdefault(level, WeekModels(level, {})).weeks[week] = m.weeks[week]
    return out
