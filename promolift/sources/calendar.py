"""Campaign calendar in the workbook layout (one sheet per year, one column per
campaign, rows 'id' / 'start' / 'end') and back to the long form."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def to_wide(campaigns: DataFrame) -> DataFrame:
    """Long calendar -> (year, label, c1..cN) string table, campaigns numbered per year."""
    w = Window.partitionBy(F.year("campaignStart")).orderBy("campaignStart", "campaignId")
    c = campaigns.select(F.year("campaignStart").alias("year"), F.row_number().over(w).alias("col"),
                         "campaignId", "campaignStart", "campaignEnd")
    stacked = c.select("year", "col", F.explode(F.array(
        F.struct(F.lit("id").alias("label"), F.col("campaignId").cast("string").alias("v")),
        F.struct(F.lit("start").alias("label"), F.col("campaignStart").cast("string").alias("v")),
        F.struct(F.lit("end").alias("label"), F.col("campaignEnd").cast("string").alias("v")))).alias("s"))
    flat = stacked.select("year", F.concat(F.lit("c"), F.col("col").cast("string")).alias("col"), "s.label", "s.v")
    return flat.groupBy("year", "label").pivot("col").agg(F.first("v"))


def to_long(wide: DataFrame) -> DataFrame:
    """Unpivot the campaign columns, pivot the row labels, cast, drop empty cells."""
    cols = [c for c in wide.columns if c not in ("year", "label")]
    u = wide.unpivot(["year", "label"], cols, "col", "v").where(F.col("v").isNotNull())
    p = u.groupBy("year", "col").pivot("label", ["id", "start", "end"]).agg(F.first("v"))
    return p.select(F.col("id").cast("long").alias("campaignId"),
                    F.to_date("start").alias("campaignStart"), F.to_date("end").alias("campaignEnd"))
