"""Saved models score as they did, and are trained only once."""
from dataclasses import replace

from promolift.operators import models as M
from promolift.plans import model_store
from promolift.plans.forecast_job import WeekModels

from .test_forest import frame


def bundle(spark, seed):
    f = frame(spark, 600, seed)
    point = M.fit_point_model(f, ["x"], "item", replace(M.POINT_PARAMS["item"], rounds=3))
    forest, leaves = M.fit_quantile_forest(f, ["x"])
    return M.ModelBundle("item", ["x"], point, forest, leaves, {"smape": 1.5})


def test_round_trip(spark, tmp_path):
    trained = []

    def train():
        trained.append(1)
        return WeekModels("item", {n: bundle(spark, n) for n in (1, 2)})

    path = f"file://{tmp_path}/store"
    assert model_store.load(spark, path) is None
    first = model_store.load_or_train(spark, path, train)
    second = model_store.load_or_train(spark, path, train)
    assert len(trained) == 1 and list(second.weeks) == [1, 2]
    at = frame(spark, 40, 9)
    for n in (1, 2):
        a, b = first.weeks[n], second.weeks[n]
        assert (b.level, b.features, b.metrics) == ("item", ["x"], {"smape": 1.5})
        both = [sorted(map(tuple, m.point.transform(at).select("k", "prediction").collect())) for m in (a, b)]
        assert both[0] == both[1]
        both = [sorted(map(tuple, M.forest_quantiles(m.forest, m.forest_leaves, at, "k").collect())) for m in (a, b)]
        assert both[0] == both[1]


def test_single_model(spark, tmp_path):
    path = f"file://{tmp_path}/one"
    model_store.save(spark, bundle(spark, 1), path)
    assert isinstance(model_store.load(spark, path), M.ModelBundle)


def test_jobs_train_only_what_is_missing(spark, tmp_path, monkeypatch):
    """Equal frames find their models; a changed frame trains its own alone."""
    from promolift.plans.forecast_job import Training
    fitted = []
    real = model_store.fit_models

    def counted(tasks, *a):
        fitted.append(sorted((t.level, t.week) for t in tasks))
        return real(tasks, *a)

    monkeypatch.setattr(model_store, "fit_models", counted)
    tasks = lambda seed: [Training("item", n, frame(spark, 300, seed if n == 2 else n), ["x"]) for n in (1, 2)]
    store = f"file://{tmp_path}/jobs"
    first = model_store.fit_missing(spark, store, tasks(7), intervals=False)
    second = model_store.fit_missing(spark, store, tasks(7), intervals=False)
    assert fitted == [[("item", 1), ("item", 2)]] and sorted(second["item"].weeks) == [1, 2]
    at = frame(spark, 40, 9)
    for n in (1, 2):
        both = [sorted(map(tuple, m["item"].weeks[n].point.transform(at).select("k", "prediction").collect())) for m in (first, second)]
        assert both[0] == both[1]
    model_store.fit_missing(spark, store, tasks(8), intervals=False)
    assert fitted[1:] == [[("item", 2)]]
    assert model_store.model_key(tasks(7)[0]) != model_store.model_key(tasks(7)[0], intervals=False)
