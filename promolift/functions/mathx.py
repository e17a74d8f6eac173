"""Target transforms and shrinkage (M1-M4)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values from the modelled pipeline.
LOG_CLIP_LOW = -10.0
LOG_CLIP_HIGH = 20.0
SHARE_EPS = 1e-4
SHRINKAGE_STRENGTH = 10


def clip(c: Column, lo: float, hi: float) -> Column:
    return F.least(F.greatest(c, F.lit(lo)), F.lit(hi))


def denormalize(log_value: Column, normalizer: Column) -> Column:
    """M1: clip to [-10, 20], expm1, times the normalizer."""
    return F.expm1(clip(log_value, LOG_CLIP_LOW, LOG_CLIP_HIGH)) * normalizer


def logit(p: Column, eps: float = SHARE_EPS) -> Column:
    """M2: logit of a share clipped to [eps, 1-eps]."""
    q = clip(p, eps, 1 - eps)
    return F.ln(q / (F.lit(1.0) - q))


def sigmoid(z: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def shrink(levels: list[tuple[Column, Column]], strength: int = SHRINKAGE_STRENGTH) -> Column:
    """M3: hierarchical shrinkage from the broadest to the most specific level.

    ``levels`` = [(lift_l1, n_l1), (lift_l2, n_l2), ...]; the first level's count is
    unused.  best = (1-w)*best + w*lift_l with w = n/(n+strength).
    """
    best = levels[0][0]
    for lift, n in levels[1:]:
        w = n / (n + F.lit(float(strength)))
        best = (F.lit(1.0) - w) * best + w * lift
    return best
