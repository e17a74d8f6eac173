"""Exact order statistics without a single-task value buffer.

``F.median`` over a whole table merges every distinct value into one task.  For
per-key medians (an item has at most one row per week) that buffer is bounded and
``F.median`` is used directly.  For a *global* median, ``exact_median`` narrows a window
of values: boundaries from a distributed quantile sketch, some spread and some close around the
wanted rank, cut it in a few buckets, a distributed count finds the bucket that holds the wanted rank, and that bucket becomes the window,
until it holds one distinct value.  Only boundaries and one count, minimum and maximum
per bucket reach the driver, whatever the size of the table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Spread boundaries per pass (every row is compared with each), and the sketch's accuracy (larger:
#: tighter buckets around the rank).
BOUNDARIES, ACCURACY = 8, 10_000


def _kth(vals: DataFrame, n: int, k: int, boundaries: int, accuracy: int) -> tuple[float, int]:
    """The k-th smallest (0-based) of the ``n`` values of the non-null double column ``v``, and how many rows
    are at most that value."""
    lo, hi, below = None, None, 0   # the window lo < v <= hi (None: open), rows below it
    left = n                        # rows in the window
    while True:
        at = (k - below + 0.5) / left
        near = [min(max(at + d / accuracy, 0.0), 1.0) for d in (-2, 0, 2)]
        probs = sorted({*near, *(i / boundaries for i in range(1, boundaries))})
        inside = F.lit(True)
        if lo is not None:
            inside = inside & (F.col("v") > F.lit(lo))
        if hi is not None:
            inside = inside & (F.col("v") <= F.lit(hi))
        cur = vals.where(inside)
        bounds = cur.agg(F.percentile_approx("v", probs, accuracy).alias("b"), F.min("v").alias("lo")).first()
        # the smallest value is a boundary too, so that every pass cuts a window of two
        cuts = sorted({float(b) for b in (*bounds["b"], bounds["lo"])})
        bucket = sum((F.when(F.col("v") > F.lit(b), 1).otherwise(0) for b in cuts), F.lit(0))
        rows = cur.groupBy(bucket.alias("b")).agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
        for r in sorted(rows.collect(), key=lambda r: r["b"]):
            if below + r["n"] > k:
                break
            below += r["n"]
        if r["lo"] == r["hi"]:
            return float(r["lo"]), below + r["n"]
        left = r["n"]
        # the window is never wider than before
        lo = cuts[r["b"] - 1] if r["b"] > 0 else lo
        hi = cuts[r["b"]] if r["b"] < len(cuts) else hi


def exact_median(df: DataFrame, col: str, boundaries: int = BOUNDARIES, accuracy: int = ACCURACY) -> float | None:
    """Exact median of ``df[col]`` (nulls ignored; the mean of the two middle values of an
    even number); None for no rows.  ``df`` is read several times: pass a written table."""
    vals = df.select(F.col(col).cast("double").alias("v")).where(F.col("v").isNotNull())
    n = vals.count()
    if n == 0:
        return None
    low, up_to = _kth(vals, n, (n - 1) // 2, boundaries, accuracy)
    if n // 2 < up_to:
        return low
    high = vals.where(F.col("v") > F.lit(low)).agg(F.min("v")).first()[0]
    return (low + float(high)) / 2.0
