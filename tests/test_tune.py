"""The search: all trials at both levels, stopped ones, parameters as sampled; fold frames by hand."""

import random

import pandas as pd

from promolift.operators import training as TR
from promolift.plans import q_models as Q
from promolift.plans import tune as T

from .conftest import SF_SMALL


def test_the_search_is_whole(spark, monkeypatch):
    """50 trials a level start; those behind the median go, but for the first five."""
    tried = []

    def frames(df, level, n_folds=3):
        return level, {d: dict(week=1, fold=i, n_train=60, n_val=20, usable=i < 3, features=["x"]) for i, d in enumerate(("a", "b", "c", "d"))}

    def scored(rows, info, fits):
        tried.append((rows, fits[0].data if fits else "", [f.model for f in fits]))
        return {f.model: float(f.params.rounds) for f in fits}

    monkeypatch.setattr(Q, "_level_frames", lambda spark, sf: [("item", spark.range(1)), ("cluster", spark.range(1))])
    monkeypatch.setattr(T, "fold_frames", frames)
    monkeypatch.setattr(T, "fold_scores", scored)
    rows = {r["level"]: r for r in Q.tuning_result(spark, SF_SMALL).collect()}
    for level in ("item", "cluster"):
        steps = [m for x, d, m in tried if x == level]
        assert [len(steps[0]), len(steps)] == [50, 3]
        assert len(steps[0]) > len(steps[1]) > len(steps[2]) and all({str(t) for t in range(5)} <= set(s) for s in steps)
        own = [T.sample_params(rng).rounds for rng in [random.Random(42)] for _ in range(50)]
        assert rows[level]["rounds"] == min(own) and rows[level]["n_folds_run"] == 3


def test_stopped_by_the_median():
    scores = {t: [float(t)] for t in range(10)}
    assert T.stopped(scores, list(range(10))) == [5, 6, 7, 8, 9]
    assert T.stopped({t: [1.0] for t in range(10)}, list(range(10))) == []


def test_parameters_are_in_their_ranges():
    for seed in range(50):
        p = T.sample_params(random.Random(seed))
        for name, (lo, hi) in T.SEARCH_SPACE.items():
            assert lo <= getattr(p, name) <= hi
        assert p.patience == 50


def test_fold_frames_by_hand(spark):
    """Train, balanced sample, validation and scored rows of each fold against pandas."""
    rows = []
    rng = random.Random(1)
    for i in range(12):
        for w in range(40):
            on = int(rng.random() < 0.1)
            rows.append((f"i{i:02d}", pd.Timestamp("2020-01-06") + pd.Timedelta(weeks=w), on, 0, int(i == 3), 1 - on, rng.random()))
    df = pd.DataFrame(rows, columns=["baseItemId", "week_start", "campaign_week_1", "campaign_week_2", "campaign_week_3", "campaign_week_0", TR.TARGET])
    df["week_start"] = df["week_start"].dt.date
    feats = sorted({f for n in (1, 2, 3) for f in TR.feature_list("item", single=False, week=n)})
    for f in feats:
        if f not in df:
            df[f] = [rng.random() for _ in range(len(df))]
    got, info = T.fold_frames(spark.createDataFrame(df), "item")
    got = got.toPandas()
    weeks = sorted(df["week_start"].unique())
    for k, tc, vc in TR.fold_cutoffs(weeks, 3):
        d = df[df["baseItemId"].isin(df[df["campaign_week_1"] == 1]["baseItemId"])]
        early, late = d[d["week_start"] <= tc], d[(d["week_start"] > tc) & (d["week_start"] <= vc)]
        camp, base = early[early["campaign_week_1"] == 1], early[(early["campaign_week_1"] == 0) & (early["campaign_week_0"] == 1)]
        base = base.sort_values(["week_start", "baseItemId"], ascending=[False, True]).head(5 * len(camp))
        name = f"w1-f{k}"
        assert (info[name]["n_train"], info[name]["n_val"], info[name]["usable"]) == (len(early), len(late), True)
        own = got[got["data"] == name]
        label = lambda x: sorted(round(v, 12) for v in x)
        assert label(own[own["split"] == "train"]["label"]) == label([*camp[TR.TARGET], *base[TR.TARGET]])
        assert label(own[own["split"] == "val"]["label"]) == label(late[TR.TARGET])
        assert label(own[own["scored"]]["label"]) == label(late[late["campaign_week_1"] == 1][TR.TARGET])
        assert set(own[own["split"] == "train"]["weight"]) == {1.0, 3.0} and set(own[own["split"] == "val"]["weight"]) == {1.0}
    assert not any(i["usable"] for d, i in info.items() if d.startswith("w2"))     # nobody has a second week


def test_registered_scores(spark):
    rows = Q.walk_forward_scores(spark, SF_SMALL).collect()
    assert len(rows) == 18 and {r["level"] for r in rows} == {"item", "cluster"}
    assert any(r["smape"] is not None and 0 < r["smape"] < 200 for r in rows)
