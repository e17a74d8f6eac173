"""Cache-or-preprocess (S5b): a processed table that grows by the clusters that are asked for.

A store folder holds parts and heads.  A part (Parquet) has the processed rows of whole
clusters; a head (one small JSON row in a folder of its own, written last) names the parts
that make up the table.  Readers take the newest head.  A request finds its items that the
table lacks by an anti-join, has their clusters built, writes them as a new part and then a
new head: until that head is there, the table is the one before, also when a build fails.

Rows of a cluster that a later part has built anew are left out of the earlier parts, by an
anti-join on cluster ids.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

HEAD = "version long, parts array<string>"


def _head(spark: SparkSession, store: str) -> tuple[int, list[str]]:
    try:
        rows = spark.read.schema(HEAD).json(f"{store}/heads/*").orderBy(F.col("version").desc()).limit(1).collect()
    except AnalysisException:
        return 0, []
    return (rows[0]["version"], list(rows[0]["parts"])) if rows else (0, [])


def read(spark: SparkSession, store: str) -> DataFrame | None:
    """The table as the newest head has it, with ``part``, the number of the part that a row
    comes from; None where nothing is built yet."""
    _, parts = _head(spark, store.rstrip("/"))
    if not parts:
        return None
    out, later = None, None
    for k in range(len(parts) - 1, -1, -1):
        rows = spark.read.parquet(f"{store.rstrip('/')}/parts/{parts[k]}/rows")
        built = spark.read.parquet(f"{store.rstrip('/')}/parts/{parts[k]}/clusters")
        own = rows if later is None else rows.join(later, "cluster1To1Id", "left_anti")
        own = own.withColumn("part", F.lit(k))
        out = own if out is None else out.unionByName(own)
        later = built if later is None else later.unionByName(built)
    return out


def covered(spark: SparkSession, store: str) -> DataFrame | None:
    """Item keys that the table covers, also those without rows."""
    _, parts = _head(spark, store.rstrip("/"))
    out = None
    for p in parts:
        keys = spark.read.parquet(f"{store.rstrip('/')}/parts/{p}/keys")
        out = keys if out is None else out.unionByName(keys)
    return None if out is None else out.distinct()


def load_or_build(spark: SparkSession, store: str, requested: DataFrame, members: DataFrame, build: Callable[[DataFrame], DataFrame], refresh: bool = False) -> DataFrame:
    """The table, with every requested item in it.  ``requested``: baseItemId; ``members``:
    (baseItemId, cluster1To1Id) of all items; ``build(keys)``: the processed rows of the items
    ``keys`` (baseItemId, cluster1To1Id), with those two columns.  Built are all items of the
    clusters of missing items (with ``refresh``: of all requested ones)."""
    store = store.rstrip("/")
    version, parts = _head(spark, store)
    missing = requested.select("baseItemId").distinct()
    have = None if refresh else covered(spark, store)
    if have is not None:
        missing = missing.join(have, "baseItemId", "left_anti")
    clusters = members.join(missing, "baseItemId", "left_semi").select("cluster1To1Id").distinct()
    if not clusters.isEmpty():
        name = uuid.uuid4().hex
        at = f"{store}/parts/{name}"
        clusters.write.parquet(f"{at}/clusters")
        clusters = spark.read.parquet(f"{at}/clusters")
        members.join(clusters, "cluster1To1Id", "left_semi").select("baseItemId", "cluster1To1Id").distinct().write.parquet(f"{at}/members")
        keys = spark.read.parquet(f"{at}/members")
        keys.select("baseItemId").distinct().write.parquet(f"{at}/keys")
        build(keys).write.parquet(f"{at}/rows")
        head = spark.createDataFrame([(version + 1, [*parts, name])], HEAD).coalesce(1)
        head.write.json(f"{store}/heads/{version + 1:09d}-{name}")   # one file, moved into place when whole
    out = read(spark, store)
    if out is None:
        raise ValueError("no requested item has a cluster, and nothing is built yet")
    return out
