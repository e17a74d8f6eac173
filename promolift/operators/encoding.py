"""Ordered target statistics: an id as the mean of its earlier labels.

An id of high cardinality becomes a number for trees without a table of codes:
``(sum + PRIOR * prior) / (n + PRIOR)`` over the labels of the id that were known before
the row's week, where ``prior`` is the mean of all labels known by then.  No label of a
row's own week or later enters it, and unseen ids get the prior.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

PRIOR = 10.0   # fixed: smoothing of categories


def ordered_mean(rows: DataFrame, id_c: str, date: str, label: str, known: str, out: str) -> DataFrame:
    """``rows`` with ``out``, the statistic of ``id_c`` at ``date``; null before any label is known.
    ``known``: the date from which a row's label is known (labels that are null don't count).

    Labels are summed per (id, date) first, so that the running sums see one row an id and
    date, however many rows an id has; the prior runs over one row a date."""
    said = rows.where(F.col(label).isNotNull() & F.col(known).isNotNull()).select(F.col(id_c).alias("_i"), F.col(known).alias("_d"), F.col(label).cast("double").alias("_s"), F.lit(1).alias("_n"))
    asked = rows.select(F.col(id_c).alias("_i"), F.col(date).alias("_d"), F.lit(0.0).alias("_s"), F.lit(0).alias("_n"))
    days = said.unionByName(asked).groupBy("_i", "_d").agg(F.sum("_s").alias("_s"), F.sum("_n").alias("_n"))
    before = Window.partitionBy("_i").orderBy("_d").rowsBetween(Window.unboundedPreceding, -1)
    own = days.select("_i", "_d", F.sum("_s").over(before).alias("_os"), F.sum("_n").over(before).alias("_on"))
    earlier = Window.orderBy("_d").rowsBetween(Window.unboundedPreceding, -1)   # one row a date
    prior = days.groupBy("_d").agg(F.sum("_s").alias("_s"), F.sum("_n").alias("_n")) \
        .select("_d", F.try_divide(F.sum("_s").over(earlier), F.sum("_n").over(earlier)).alias("_p"))
    stat = (F.coalesce("_os", F.lit(0.0)) + PRIOR * F.col("_p")) / (F.coalesce("_on", F.lit(0)) + PRIOR)
    table = own.join(prior, "_d").select(F.col("_i"), F.col("_d"), stat.alias(out))
    return rows.join(table, rows[id_c].eqNullSafe(table["_i"]) & (rows[date] == table["_d"]), "left").drop("_i", "_d")
