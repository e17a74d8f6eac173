"""Rounds, steps and sizes of the boosted models, and that they are made."""

import numpy as np
from pyspark.sql import functions as F

from promolift.operators import boosting as B
from promolift.operators import models as M
from promolift.plans import recursive_job, scenario_job
from promolift.session import cut_lineage


def test_specified_parameters():
    item, cluster = M.POINT_PARAMS["item"], M.POINT_PARAMS["cluster"]
    assert (item.rounds, item.patience, item.step, item.leaves, item.least_rows, item.columns, item.rows, item.rows_every) == (500, 50, 0.05, 31, 20, 0.8, 0.8, 5)
    assert (cluster.rounds, cluster.patience, cluster.step, cluster.leaves, cluster.depth, cluster.least_rows) == (400, 50, 0.02, 15, 5, 40)
    assert (cluster.columns, cluster.rows, cluster.rows_every, cluster.l1, cluster.l2) == (0.7, 0.7, 5, 0.2, 0.2)
    g1, g2 = scenario_job.G1_PARAMS, recursive_job.SIMPLE_PARAMS
    assert (g1.rounds, g1.patience, g1.step, g1.leaves, g1.least_rows) == (2000, None, 0.05, 63, 200)
    assert (g2.rounds, g2.patience, g2.step, g2.depth, g2.least_rows, g2.l1, g2.l2, g2.columns) == (100, None, 0.05, 4, 10, 0.5, 0.5, 0.8)


def test_all_rounds_are_made(spark):
    """A step of 0.05 takes its hundreds of rounds to fit a plain step function exactly."""
    x = np.arange(400) % 20
    rows = [("d", int(i), "train", 0.0 if x[i] < 10 else 100.0, 1.0, [float(x[i])]) for i in range(400)]
    df = cut_lineage(spark.createDataFrame(rows, "data string, row long, split string, label double, weight double, features array<double>"))
    p = B.Boosting(rounds=300, patience=None, step=0.05, leaves=63, least_rows=20)
    m = B.fit_many(df, [B.Fit("m", "d", p)], {"d": ["x"]})["m"]
    assert m.n_trees == 300
    got = m.transform(df.select("label", F.get("features", F.lit(0)).alias("x")))
    assert got.agg(F.max(F.abs(F.col("prediction") - F.col("label")))).first()[0] < 100 * 0.95 ** 295
