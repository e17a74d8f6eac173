"""Boosted trees: right splits, equal trees for any number of blocks, patience, parameters."""
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from promolift import session
from promolift.operators import boosting as B
from promolift.session import cut_lineage

KIND = "data string, row long, split string, label double, weight double, features array<double>"


def frame(spark, data, x, y, weight=None, split=None):
    n = len(y)
    rows = [(data, int(i * 7919 + 13), (split[i] if split is not None else "train"), float(y[i]), float(weight[i] if weight is not None else 1.0),
             [None if math.isnan(v) else float(v) for v in x[i]]) for i in range(n)]
    return cut_lineage(spark.createDataFrame(rows, KIND))


def toy(n, width, seed):
    r = np.random.default_rng(seed)
    x = r.normal(size=(n, width))
    y = 2 * x[:, 0] + np.sin(3 * x[:, 1]) + (x[:, 2] > 0) * x[:, 0] + r.normal(size=n) * 0.3
    x[r.random((n, width)) < 0.03] = np.nan
    return x, y, np.where(r.random(n) < 0.3, 3.0, 1.0), np.where(r.random(n) < 0.75, "train", "val")


def names(k):
    return [f"x{i}" for i in range(k)]


def test_one_tree_by_hand(spark):
    """The best split of weighted rows, leaf values with l1 and l2."""
    x = np.array([[0.0], [0.0], [1.0], [1.0], [2.0], [2.0]])
    y, w = np.array([1.0, 1.0, 1.0, 1.0, 5.0, 7.0]), np.array([1.0, 1.0, 1.0, 1.0, 3.0, 1.0])
    p = B.Boosting(rounds=1, patience=None, step=0.5, leaves=2, least_rows=1, l1=0.5, l2=1.0)
    m = B.fit_many(frame(spark, "d", x, y, w), [B.Fit("m", "d", p)], {"d": ["x"]})["m"]
    base = (y * w).sum() / w.sum()
    assert m.base == pytest.approx(base) and m.threshold[0] == 1.0 and m.n_trees == 1
    value = lambda at: math.copysign(max(abs((w * (y - base))[at].sum()) - 0.5, 0), (w * (y - base))[at].sum()) / (w[at].sum() + 1.0)
    assert m.predict(np.array([[0.5]]))[0] == pytest.approx(base + 0.5 * value(slice(0, 4)), rel=1e-6)
    assert m.predict(np.array([[3.0]]))[0] == pytest.approx(base + 0.5 * value(slice(4, 6)), rel=1e-6)
    assert m.predict(np.array([[np.nan]]))[0] == m.predict(np.array([[0.0]]))[0]   # missing goes left


def test_equal_trees_for_any_blocks(spark):
    """One block or many, in any order of rows, two models at a time."""
    x, y, w, s = toy(900, 5, 1)
    df = frame(spark, "d", x, y, w, s)
    fits = [B.Fit("a", "d", B.Boosting(rounds=3, step=0.1, leaves=7, rows=0.8, rows_every=2, columns=0.8, l1=0.1, l2=0.2)),
            B.Fit("b", "d", B.Boosting(rounds=3, depth=2, seed=3))]
    one = B.fit_many(df, fits, {"d": names(5)})
    many = B.fit_many(df.orderBy(F.rand(5)), fits, {"d": names(5)}, block_cells=1500)
    for k in one:
        assert one[k].nodes == many[k].nodes and one[k].losses == many[k].losses and len(one[k].nodes) > 10


def test_models_of_one_block_are_dealt_over_the_cores(spark):
    """Eight models of one data set grow in as many tasks as there are cores for, with the trees
    that each has alone."""
    x, y, w, s = toy(300, 4, 6)
    df, seen = frame(spark, "d", x, y, w, s), []
    fits = [B.Fit(f"{k}", "d", B.Boosting(rounds=4 + k, patience=3, leaves=4 + k, rows=0.8, columns=0.7, seed=k)) for k in range(8)]
    look = lambda d: seen.append(d.rdd.getNumPartitions())
    session.LISTENERS.append(look)
    try:
        found = B.fit_many(df, fits, {"d": names(4)})
    finally:
        session.LISTENERS.remove(look)
    assert seen == [math.ceil(8 / math.ceil(8 / spark.sparkContext.defaultParallelism))]
    for f in fits:
        alone = B.fit_many(df, [f], {"d": names(4)})[f.model]
        assert found[f.model].nodes == alone.nodes and found[f.model].losses == alone.losses


def test_losses_are_those_of_the_kept_prefix(spark):
    x, y, w, s = toy(1500, 5, 2)
    m = B.fit_many(frame(spark, "d", x, y, w, s), [B.Fit("m", "d", B.Boosting(rounds=200, patience=10, step=0.2))], {"d": names(5)})["m"]
    val = s == "val"
    assert ((w * (y - m.predict(x)) ** 2)[val].sum() / val.sum()) == pytest.approx(m.losses[m.n_trees - 1], rel=1e-6)
    assert m.losses[m.n_trees - 1] == min(m.losses) < m.losses[0] / 5
    assert len(m.losses) == m.n_trees + 10 < 200    # ten rounds without gain, then the end


def test_patience_passes_a_flat_stretch(spark):
    """A pattern that single splits can't see at first: the error rises or stays for rounds, then falls."""
    r = np.random.default_rng(4)
    x = r.integers(0, 2, size=(4000, 6)).astype(float)
    y = np.where((x[:, 0] + x[:, 1]) % 2 == 1, 1.0, -1.0) + r.normal(size=4000) * 0.1
    split = np.where(r.random(4000) < 0.7, "train", "val")
    p = dict(rounds=150, step=0.3, leaves=4, depth=2, least_rows=5, columns=0.34)
    df = frame(spark, "d", x, y, None, split)
    fits = [B.Fit("short", "d", B.Boosting(patience=1, **p)), B.Fit("long", "d", B.Boosting(patience=50, **p))]
    m = B.fit_many(df, fits, {"d": names(6)})
    curve = m["long"].losses
    assert any(b >= a for a, b in zip(curve[:m["long"].n_trees], curve[1:]))      # there is such a stretch
    assert m["long"].n_trees > m["short"].n_trees and min(curve) < 0.5 * min(m["short"].losses)


def test_bounds_of_a_tree(spark):
    x, y, w, s = toy(2000, 5, 3)
    df = frame(spark, "d", x, y, w, s)
    for p in (B.Boosting(rounds=5, leaves=9), B.Boosting(rounds=5, leaves=0, depth=3), B.Boosting(rounds=5, least_rows=200)):
        m = B.fit_many(df, [B.Fit("m", "d", p)], {"d": names(5)})["m"]
        train = x[s == "train"]
        for k, root in enumerate(m.roots):
            own = [n for n in m.nodes if n[0] == k]
            leaves = sum(n[2] < 0 for n in own)
            assert not p.leaves or leaves <= p.leaves
            assert not p.depth or leaves <= 2 ** p.depth
            at = np.full(len(train), root)
            for _ in range(40):
                f = m.feature[at]
                inner = np.flatnonzero(f >= 0)
                at[inner] = m.below[at[inner]] + (train[inner, f[inner]] > m.threshold[at[inner]])
            assert np.bincount(at)[np.unique(at)].min() >= p.least_rows


def test_without_rows_or_splits(spark):
    e = spark.createDataFrame([], KIND)
    assert B.fit_many(e, [B.Fit("m", "d")], {"d": ["x"]}) == {}
    flat = B.fit_many(frame(spark, "d", np.zeros((50, 2)), np.full(50, 3.0)), [B.Fit("m", "d")], {"d": names(2)})["m"]
    assert flat.predict(np.zeros((1, 2)))[0] == pytest.approx(3.0) and len(flat.losses) == 1


def test_scoring_and_saving(spark, tmp_path):
    x, y, w, s = toy(600, 3, 6)
    m = B.fit_many(frame(spark, "d", x, y, w, s), [B.Fit("m", "d", B.Boosting(rounds=20))], {"d": names(3)})["m"]
    at = spark.createDataFrame([(i, *[None if math.isnan(v) else float(v) for v in x[i]]) for i in range(100)], "k long, x0 double, x1 double, x2 double")
    got = {r["k"]: r["prediction"] for r in m.transform(at).collect()}
    assert [got[i] for i in range(100)] == m.predict(x[:100]).tolist()
    m.save(spark, f"file://{tmp_path}/m")
    again = B.Boosted.load(spark, f"file://{tmp_path}/m")
    assert again.predict(x).tolist() == m.predict(x).tolist() and again.losses == m.losses and again.features == m.features
    assert sum(m.importances()) == pytest.approx(1.0)


def test_a_model_takes_tens_of_bytes_a_node(spark, monkeypatch):
    """The driver and the broadcasts hold arrays, given on in parts of whole rounds, not tuples."""
    import pickle
    import tracemalloc
    x, y, w, s = toy(2000, 5, 6)
    fits = [B.Fit("m", "d", B.Boosting(rounds=300, patience=None, step=0.1, leaves=31, least_rows=5))]
    df = frame(spark, "d", x, y, w, s)
    whole = B.fit_many(df, fits, {"d": names(5)})["m"]
    if hasattr(B, "PACKED_NODES"):
        monkeypatch.setattr(B, "PACKED_NODES", 500)
    tracemalloc.start()
    m = B.fit_many(df, fits, {"d": names(5)})["m"]
    held = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    n = len(m.feature)
    assert n > 15_000 and m.nodes == whole.nodes and m.losses == whole.losses and len(m.losses) == 300
    assert held < 250 * n and len(pickle.dumps(m.scorer())) < 30 * n
