"""Quantile forest: right quantiles, sample weights, and a join that grows linearly."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from promolift.operators import models as M


def frame(spark, n, seed=0, weight=lambda y: 1.0):
    rng = np.random.default_rng(seed)
    x = rng.random(n)
    y = np.where(x > 0.5, 3.0, 0.0) + rng.normal(size=n)
    rows = [(i, float(a), float(b), weight(b), "train") for i, (a, b) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "k long, x double, salesQuantityKgL_log double, weight double, split string")


@pytest.fixture(scope="module")
def fitted(spark):
    return M.fit_quantile_forest(frame(spark, 4000), ["x"])


def test_quantiles(spark, fitted):
    rows = M.forest_quantiles(*fitted, frame(spark, 300, 1), "k").join(frame(spark, 300, 1), "k").collect()
    assert len(rows) == 300 and all(r["q10"] <= r["q50"] <= r["q90"] for r in rows)
    for r in rows:
        if abs(r["x"] - 0.5) > 0.1:
            centre = 3.0 if r["x"] > 0.5 else 0.0
            assert abs(r["q50"] - centre) < 0.5 and abs(r["q10"] - centre + 1.28) < 0.6 and abs(r["q90"] - centre - 1.28) < 0.6


def test_weights_count(spark):
    heavy = M.fit_quantile_forest(frame(spark, 4000, 2, lambda y: 9.0 if y > 0 else 1.0), ["x"])
    even = M.fit_quantile_forest(frame(spark, 4000, 2), ["x"])
    at = frame(spark, 50, 3)
    mean = lambda f: M.forest_quantiles(*f, at, "k").agg(F.avg("q50")).first()[0]
    assert mean(heavy) > mean(even) + 0.1


def test_leaf_table_does_not_grow_with_the_rows(spark, fitted):
    trees = M.FOREST_PARAMS["numTrees"]
    for n in (1000, 4000):
        model, leaves = fitted if n == 4000 else M.fit_quantile_forest(frame(spark, n), ["x"])
        assert leaves.count() <= trees * 2 ** M.FOREST_PARAMS["maxDepth"]
        assert leaves.groupBy("tree", "leaf").count().where("count > 1").count() == 0
