"""Connected components of a link table, by alternating stars.

Large star: every node passes the smallest of its neighbours and itself to its larger
neighbours.  Small star: it passes the smallest to its smaller neighbours and itself.
Each step is a grouped minimum and a join, written out once; no node's neighbours are
ever gathered in one row, and a node with a large share of all links meets its minimum by
broadcast, not in one task.  Rounds end when a round changes nothing; their number grows
with the logarithm of the longest chain.

Defined cases: no links give no rows; repeated links and links of a node with itself add
nothing; links with a null end are left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import keep, with_values


def _mark(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """id and comp (the smallest id that it is connected with), for every linked id."""
    ends = F.col(a) != F.col(b)
    links = edges.where(ends).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    links = keep(links.distinct(), "links")
    before = _mark(links)
    while before[0]:
        both = links.union(links.select("v", "u"))
        low = keep(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("low"), F.count(F.lit(1)).alias("k")), "lowest")
        large = with_values(both, low, ["u"], F.col("k"), 2 * before[0]).where("v > u and v > low").select(F.col("v").alias("u"), F.col("low").alias("v")).distinct()
        large = keep(large, "links")
        low = keep(large.groupBy("u").agg(F.min("v").alias("low"), F.count(F.lit(1)).alias("k")), "lowest")
        small = with_values(large, low, ["u"], F.col("k"), large.count())
        small = small.select("u", F.col("low").alias("v")).union(small.where("v > low").select(F.col("v").alias("u"), F.col("low").alias("v")))
        links = keep(small.distinct(), "links")
        after = _mark(links)
        if after == before:
            break
        before = after
    return links.select(F.col("u").alias("id"), F.col("v").alias("comp"))
