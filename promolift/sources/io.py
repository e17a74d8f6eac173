"""Readers and writers.

``read_table`` is the one entry point for Parquet / Delta / CSV with projection and
predicate (pushed to the scan by Catalyst).  ``snapshot`` replaces the local
query-hash file cache: it writes a Parquet copy into the shared checkpoint folder and
reads it back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage, ensure_checkpoint_dir


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", columns: list[str] | None = None,
               predicate: str | Column | None = None, schema: T.StructType | None = None) -> DataFrame:
    """Format dispatch ('parquet', 'delta', 'csv'); unknown formats raise.
    CSV reads are recursive with a header; an explicit schema avoids inference."""
    if fmt == "csv":
        r = spark.read.option("header", True).option("recursiveFileLookup", True)
        df = (r.schema(schema) if schema is not None else r.option("inferSchema", True)).csv(path)
    elif fmt in ("parquet", "delta"):
        df = spark.read.format(fmt).load(path)
    else:
        raise ValueError(f"unsupported storage format: {fmt}")
    if predicate is not None:
        df = df.where(predicate)
    if columns:
        df = df.select(*columns)
    return df


def write_table(df: DataFrame, path: str, fmt: str = "parquet", columns: list[str] | None = None,
                partition_by: list[str] | None = None) -> None:
    """Overwrite a Parquet / CSV (header) / JSON table."""
    out = df.select(*columns) if columns else df
    w = out.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", True).csv(path)
    elif fmt == "json":
        w.json(path)
    else:
        w.format(fmt).save(path)


def scratch_path(spark: SparkSession, name: str) -> str:
    import uuid
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/promolift/{name}-{uuid.uuid4().hex}"


def snapshot(df: DataFrame, name: str = "snapshot") -> DataFrame:
    """Materialise a result as Parquet in the shared folder and read it back."""
    return cut_lineage(df, name)


def harmonize_types(df: DataFrame) -> DataFrame:
    """A string column becomes double when every non-null value parses as a
    number; one aggregate pass decides for all columns."""
    strs = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    if not strs:
        return df
    aggs = []
    for c in strs:
        aggs += [F.count(F.col(c)).alias(f"{c}__n"), F.count(F.expr(f"try_cast(`{c}` AS DOUBLE)")).alias(f"{c}__ok")]
    r = df.agg(*aggs).first()
    numeric = {c for c in strs if r[f"{c}__n"] > 0 and r[f"{c}__n"] == r[f"{c}__ok"]}
    return df.select(*[F.expr(f"try_cast(`{f.name}` AS DOUBLE)").alias(f.name) if f.name in numeric
                       else F.col(f.name) for f in df.schema.fields])
