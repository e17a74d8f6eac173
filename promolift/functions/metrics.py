"""Forecast error metrics as aggregate expressions.

All are algebraic (sum/count based), so Spark computes them with partial
aggregation and no single-task buffer.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def smape(a: Column, p: Column) -> Column:
    """Mean of |a-p| / ((|a|+|p|)/2) x 100; a term is 0 when both are 0."""
    den = (F.abs(a) + F.abs(p)) / 2
    term = F.when(den == 0, F.lit(0.0)).otherwise(F.abs(a - p) / den)
    return F.avg(term) * 100


def mae(a: Column, p: Column) -> Column:
    """E2."""
    return F.avg(F.abs(a - p))


def mape(a: Column, p: Column) -> Column:
    """Zero actuals are masked."""
    return F.avg(F.when(a != 0, F.abs((a - p) / a))) * 100


def rmse(a: Column, p: Column) -> Column:
    """E4."""
    return F.sqrt(F.avg(F.pow(a - p, 2)))


def smape_legacy(a: Column, p: Column) -> Column:
    """E5: 2|a-p|/(|a|+|p|) x 100 with a zero denominator replaced by 1e-6."""
    den = F.abs(a) + F.abs(p)
    den = F.when(den == 0, F.lit(1e-6)).otherwise(den)
    return F.avg(F.lit(2.0) * F.abs(a - p) / den) * 100


def weighted_smape(a: Column, p: Column) -> Column:
    """Volume-weighted SMAPE, weight = max(actual, 0)."""
    den = F.abs(a) + F.abs(p)
    den = F.when(den == 0, F.lit(1e-6)).otherwise(den)
    term = F.lit(2.0) * F.abs(a - p) / den * 100
    w = F.greatest(a, F.lit(0.0))
    wsum = F.sum(w)
    return F.sum(term * w) / F.when(wsum == 0, F.lit(1e-6)).otherwise(wsum)


def rmsle(a: Column, p: Column) -> Column:
    """Root mean square of the log1p difference (predictions floored at 0)."""
    d = F.log1p(F.greatest(p, F.lit(0.0))) - F.log1p(a)
    return F.sqrt(F.avg(d * d))


def all_metrics(a: Column, p: Column) -> list[Column]:
    return [smape(a, p).alias("smape"), mae(a, p).alias("mae"), mape(a, p).alias("mape"),
            rmse(a, p).alias("rmse"), smape_legacy(a, p).alias("smape_legacy"),
            weighted_smape(a, p).alias("weighted_smape"), rmsle(a, p).alias("rmsle")]
