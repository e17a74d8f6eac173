"""A total order over all rows: sorted, split into ranges, with every row's place.

No key is held by one task: rows are dealt in ranges of the sort key with a last key
that tells equal rows apart, so a key that a third of all rows share spans many ranges.
Places follow from prefix sums over the ranges: one small row a range.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: ``monotonically_increasing_id`` counts the rows of a partition in its lower 33 bits.
ROW_BITS = (1 << 33) - 1


def spread(df: DataFrame, keys: list[Column], parts: int | None = None) -> DataFrame:
    """Rows in ascending order of ``keys`` (nulls first unless a key says otherwise), range
    by range, with ``part`` (the range) and ``place`` (from 0, inside the range).  Rows
    equal in every key come in any order.  Evaluate once: write the result before use."""
    keys = [*keys, F.col("_row")]
    rows = df.withColumn("_row", F.monotonically_increasing_id())
    rows = rows.repartitionByRange(parts, *keys) if parts else rows.repartitionByRange(*keys)
    rows = rows.sortWithinPartitions(*keys).drop("_row")
    return rows.select("*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().bitwiseAND(F.lit(ROW_BITS)).alias("place"))


def bases(counts: dict[int, int]) -> dict[int, int]:
    """The sum before each range, from the sums of the ranges."""
    parts = sorted(counts)
    return dict(zip(parts, accumulate((counts[p] for p in parts), initial=0)))


def lookup(value: Column, table: dict[int, int], kind: str = "bigint") -> Column:
    """``table[value]`` as a Spark expression; null where absent.  For tables of one entry a
    range or bucket."""
    if not table:
        return F.lit(None).cast(kind)
    keys = sorted(table)
    pairs = F.map_from_arrays(F.lit(keys).cast("array<int>"), F.lit([table[k] for k in keys]).cast(f"array<{kind}>"))
    return F.try_element_at(pairs, value.cast("int"))


def numbered(kept: DataFrame) -> DataFrame:
    """``spread`` rows, written, with ``number``: the place among all rows, from 0."""
    counts = {r["part"]: r["n"] for r in kept.groupBy("part").agg(F.count("*").alias("n")).collect()}
    return kept.withColumn("number", lookup(F.col("part"), bases(counts)) + F.col("place")).drop("part", "place")
