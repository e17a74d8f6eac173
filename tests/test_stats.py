"""Exact median with tiny sketches, so that every window is narrowed several times."""
import numpy as np
import pytest

from promolift.functions.stats import exact_median


@pytest.mark.parametrize("kind", ["uniform", "skewed", "tied", "two", "one", "negative"])
@pytest.mark.parametrize("n", [1, 2, 501, 1000])
def test_exact_median_narrows(spark, kind, n):
    rng = np.random.default_rng(n)
    v = {"uniform": rng.random(n), "skewed": np.exp(6 * rng.normal(size=n)), "tied": rng.integers(0, 4, n).astype(float),
         "two": (np.arange(n) % 2).astype(float), "one": np.full(n, 3.5), "negative": -np.exp(rng.normal(size=n))}[kind]
    df = spark.createDataFrame([(float(x),) for x in v] + [(None,)], "v double")
    assert exact_median(df, "v", boundaries=4, accuracy=10) == float(np.median(v))


def test_no_rows(spark):
    assert exact_median(spark.createDataFrame([(None,)], "v double"), "v") is None
