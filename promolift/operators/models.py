"""Forecast models.

Point model: boosted trees with sample weights, validation rows and 50 rounds of patience
(``boosting``), all models of a job grown in one pass.  Intervals: a quantile
regression forest (Meinshausen 2006) -- a ``RandomForestRegressor`` whose leaf
indices (``leafCol``) of training rows are summed up to one weighted histogram of
targets per (tree, leaf).  A scoring row meets one such row per tree, so the join grows
with the scoring rows alone; quantiles read off the summed histograms never cross.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.metrics import mae, mape, rmse, smape
from ..session import cut_lineage, union_all
from .boosting import Boosted, Boosting, Fit, fit_many, predict_many

QUANTILES = (0.1, 0.5, 0.9)   # fixed: interval quantiles
QUANTILE_BINS = 256           # bins of the targets' range, for interval quantiles

# Settings of the boosted trees.
POINT_PARAMS = {
    "item": Boosting(rounds=500, patience=50, step=0.05, leaves=31, least_rows=20, columns=0.8, rows=0.8, rows_every=5),
    "cluster": Boosting(rounds=400, patience=50, step=0.02, leaves=15, depth=5, least_rows=40, columns=0.7, rows=0.7, rows_every=5,
                        l1=0.2, l2=0.2),
}
FOREST_PARAMS = dict(numTrees=20, maxDepth=6, minInstancesPerNode=10, subsamplingRate=0.8,
                     featureSubsetStrategy="onethird")


@dataclass
class ModelBundle:
    level: str
    features: list[str]
    point: Boosted
    forest: PipelineModel | None      # None: no intervals
    forest_leaves: DataFrame | None   # (tree, leaf, shares, lo, width): a histogram per leaf
    metrics: dict = field(default_factory=dict)


def _assembler(features):
    return VectorAssembler(inputCols=features, outputCol="features", handleInvalid="error")


def training_rows(frame: DataFrame, features: list[str], data: str, label: str = "salesQuantityKgL_log", **more: Column) -> DataFrame:
    """A frame as rows of the data set ``data`` for ``boosting.fit_many``, with ``more`` columns;
    rows are told apart by a hash of their values."""
    return frame.select(F.lit(data).alias("data"), F.xxhash64(label, *features).alias("row"), "split", F.col(label).cast("double").alias("label"),
                        F.col("weight").cast("double").alias("weight"), F.array(*[F.col(f).cast("double") for f in features]).alias("features"),
                        *[c.alias(n) for n, c in more.items()])


def fit_point_models(frames: dict[str, tuple[DataFrame, list[str], Boosting]], label: str = "salesQuantityKgL_log") -> dict[str, Boosted]:
    """A weighted boosted model for each (frame, features, parameters), all in one pass;
    validation rows tell where to stop."""
    return fit_rows(written_rows({name: own[:2] for name, own in frames.items()}, label), frames)


def written_rows(frames: dict[str, tuple[DataFrame, list[str]]], label: str = "salesQuantityKgL_log") -> DataFrame:
    """The ``training_rows`` of each (frame, features), written."""
    return cut_lineage(union_all([training_rows(frame, feats, name, label) for name, (frame, feats) in frames.items()]), "training-rows")


def fit_rows(rows: DataFrame, frames: dict[str, tuple[DataFrame, list[str], Boosting]]) -> dict[str, Boosted]:
    """The models of ``frames`` from their ``written_rows``."""
    return fit_many(rows, [Fit(name, name, p) for name, (_, _, p) in frames.items()], {name: feats for name, (_, feats, _) in frames.items()})


def fit_point_model(frame: DataFrame, features: list[str], level: str, params: Boosting | None = None, label: str = "salesQuantityKgL_log") -> Boosted:
    """One point model, with the level's parameters unless others are given."""
    return fit_point_models({level: (frame, features, params or POINT_PARAMS[level])}, label)[level]


def fit_quantile_forest(frame: DataFrame, features: list[str], label: str = "salesQuantityKgL_log",
                        seed: int = 42) -> tuple[PipelineModel, DataFrame]:
    """Weighted random forest + one histogram of training targets per (tree, leaf).

    Targets fall in ``QUANTILE_BINS`` equal bins between their smallest and largest value;
    ``shares`` are the leaf's weight shares per bin and ``lo`` / ``width`` place the bins.
    The table has at most trees x leaves rows, however many rows were trained on."""
    data = frame.where(F.col("split").isin("train", "val"))
    rf = RandomForestRegressor(featuresCol="features", labelCol=label, leafCol="leaves", seed=seed,
                               weightCol="weight", bootstrap=False, **FOREST_PARAMS)
    model = Pipeline(stages=[_assembler(features), rf]).fit(data)
    ends = data.agg(F.min(label).alias("lo"), F.max(label).alias("hi")).first()
    lo = float(ends["lo"] or 0.0)
    width = max((float(ends["hi"] or 0.0) - lo) / QUANTILE_BINS, 1e-12)
    return model, leaf_histograms(model, data, label, lo, width)


def leaf_histograms(model: PipelineModel, data: DataFrame, label: str, lo: float, width: float) -> DataFrame:
    bin_of = F.least(F.floor((F.col(label) - lo) / width), F.lit(QUANTILE_BINS - 1)).cast("int")
    rows = model.transform(data).select(bin_of.alias("bin"), F.col("weight").cast("double").alias("w"),
                                        F.posexplode(vector_to_array("leaves")).alias("tree", "leaf"))
    bins = rows.groupBy("tree", "leaf", "bin").agg(F.sum("w").alias("w"))
    leaves = bins.groupBy("tree", "leaf").agg(F.map_from_entries(F.collect_list(F.struct("bin", "w"))).alias("_m"),
                                              F.sum("w").alias("_t"))
    share = F.transform(F.sequence(F.lit(0), F.lit(QUANTILE_BINS - 1)),
                        lambda k: F.coalesce(F.try_element_at("_m", k), F.lit(0.0)) / F.col("_t"))
    return leaves.select("tree", "leaf", share.alias("shares"), F.lit(lo).alias("lo"), F.lit(width).alias("width"))


def forest_quantiles(forest: PipelineModel, leaves: DataFrame, scoring: DataFrame, key: str,
                     quantiles=QUANTILES) -> DataFrame:
    """Weighted quantiles of the training targets that share leaves with each scoring row:
    the trees' histograms are added (one row per tree and scoring row), and a quantile is
    read off the running sum, at its bin's middle (an error of half a bin at most).
    ``key`` identifies scoring rows; returns key + q10/q50/q90 (log scale)."""
    s = (forest.transform(scoring.select(key, *forest.stages[0].getInputCols()))
         .select(key, F.posexplode(vector_to_array("leaves")).alias("tree", "leaf")))
    j = s.join(leaves, ["tree", "leaf"])
    # F.sum per bin keeps the aggregate partial: no list of histograms is gathered
    total = j.groupBy(key).agg(F.first("lo").alias("lo"), F.first("width").alias("width"),
                               F.array(*[F.sum(F.get("shares", F.lit(k))) for k in range(QUANTILE_BINS)]).alias("h"))
    mass = F.aggregate("h", F.lit(0.0), lambda a, x: a + x)
    zero = F.struct(F.lit(0.0).alias("sum"), F.array().cast("array<double>").alias("cum"))
    running = F.aggregate("h", zero, lambda a, x: F.struct((a["sum"] + x).alias("sum"),
                                                           F.concat(a["cum"], F.array(a["sum"] + x)).alias("cum")))
    total = total.withColumn("_mass", mass).withColumn("_cum", running["cum"])

    def quantile(q):
        under = F.size(F.filter("_cum", lambda c: c < F.col("_mass") * (q - 1e-12)))
        return (F.col("lo") + F.col("width") * (under + 0.5)).alias(f"q{int(round(q * 100))}")

    cols = [quantile(q) for q in quantiles]
    return total.select(key, *cols)


def feature_importance(model: Boosted, features: list[str], top: int = 10):
    """K6: top features by importance, as (feature, importance) rows (a top-k report)."""
    rows = sorted(zip(features, model.importances()), key=lambda t: (-t[1], t[0]))[:top]
    return rows


def evaluate(model: Boosted, frame: DataFrame, label: str = "salesQuantityKgL_log") -> dict:
    """SMAPE and MAPE on the expm1 scale, MAE and RMSE on the log scale, test rows."""
    pred = model.transform(frame.where(F.col("split") == "test").select(label, *model.features))
    a, p = F.col(label), F.col("prediction")
    r = pred.agg(smape(F.expm1(a), F.expm1(p)).alias("smape"), mape(F.expm1(a), F.expm1(p)).alias("mape"),
                 mae(a, p).alias("mae"),
                 rmse(a, p).alias("rmse"), F.count("*").alias("n")).first()
    return r.asDict() if r is not None else {}


def evaluate_rows(rows: DataFrame, models: dict[str, Boosted]) -> dict[str, dict]:
    """``evaluate`` of each data set's model on its ``training_rows``, all in one job."""
    a, p = F.col("label"), F.col("prediction")
    test = rows.where(F.col("split") == "test")
    found = predict_many(test, {name: (name, m) for name, m in models.items()}).groupBy("model").agg(
        smape(F.expm1(a), F.expm1(p)).alias("smape"), mape(F.expm1(a), F.expm1(p)).alias("mape"), mae(a, p).alias("mae"),
        rmse(a, p).alias("rmse"), F.count("*").alias("n")).collect()   # a row a model
    none = {"smape": None, "mape": None, "mae": None, "rmse": None, "n": 0}
    by = {r["model"]: {k: r[k] for k in none} for r in found}
    return {name: by.get(name, dict(none)) for name in models}
