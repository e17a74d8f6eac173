"""Pipeline inputs derived from the driver's TPC-H-like tables.

Every frame here is a lazy function of ``part``, ``orders`` and ``lineitem`` so the
work grows with the data.  The mapping is fixed by the fixture contract:

Fixed values (must match the fixture contract exactly):
  * campaign anchor date 1995-01-03 (a Tuesday), one campaign every 35 days,
    each lasting 21 days (end = start + 20)
  * a part is a version of base item ``p_partkey % 200``; the version group
    ``(p_partkey div 200) % 4`` selects the id prefix: 0 none, 1 'M', 2 'S', 3 'K'
  * empty cluster when ``p_partkey % 11 = 0``
  * an order line is on campaign k when its order date lies inside campaign k
    and ``(base + k) % 8 = 0``
  * returns: ``l_returnflag = 'R' and l_linenumber = 5`` -> negative quantity
  * cancelled: ``o_orderstatus = 'P'``
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import CAMPAIGNS, DIM_ITEM, FACT_ORDER, conform

ANCHOR = "1995-01-03"
PERIOD_DAYS = 35
LENGTH_DAYS = 21
N_BASE = 200
PREFIXES = ["", "M", "S", "K"]


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def campaigns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Campaign calendar covering the order history (one row per campaign)."""
    orders = read(spark, sf_dir, "orders")
    bounds = orders.agg(F.max(F.to_date("o_orderdate")).alias("_mx"))
    cal = bounds.select(F.posexplode(F.sequence(
        F.lit(ANCHOR).cast("date"), F.col("_mx"),
        F.expr(f"INTERVAL {PERIOD_DAYS} DAYS"))).alias("_pos", "campaignStart"))
    cal = cal.select(
        (F.col("_pos") + 1).cast("long").alias("campaignId"),
        "campaignStart",
        F.date_add("campaignStart", LENGTH_DAYS - 1).alias("campaignEnd"))
    return conform(cal, CAMPAIGNS)


def _item_id(partkey):
    base = (partkey % N_BASE).cast("string")
    prefix = F.element_at(F.array(*[F.lit(p) for p in PREFIXES]),
                          (F.floor(partkey / N_BASE) % len(PREFIXES) + 1).cast("int"))
    return F.concat(prefix, base)


def dim_item(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read(spark, sf_dir, "part")
    k = F.col("p_partkey")
    l1 = F.col("p_type")
    l2 = F.concat_ws("-", l1, F.col("p_brand"))
    l3 = F.concat_ws("-", l2, F.floor(F.col("p_size") / 10).cast("string"))
    l4 = F.concat_ws("-", l3, F.col("p_name"))
    out = p.select(
        _item_id(k).alias("itemId"),
        F.col("p_name").alias("itemDesc"),
        k.cast("long").alias("itemSkey"),
        F.when(k % 11 == 0, F.lit("")).otherwise(F.col("p_brand")).alias("cluster1To1Id"),
        F.when(F.col("p_size") % 3 == 0, F.col("p_size") / 10.0).alias("weightKgPreparedItemComparisonUnit"),
        F.when(F.col("p_size") % 3 == 1, F.col("p_size") / 20.0).otherwise(F.lit(0.0)).alias("netWeightKgComparisonUnit"),
        F.when(F.col("p_size") % 4 != 0, F.col("p_retailprice") / 1000.0).alias("grossWeightKgComparisonUnit"),
        F.lit(ANCHOR).cast("date").alias("itemRegDate"),
        l1.alias("categoryLevel1Id"), l1.alias("categoryLevel1Desc"),
        l2.alias("categoryLevel2Id"), l2.alias("categoryLevel2Desc"),
        l3.alias("categoryLevel3Id"), l3.alias("categoryLevel3Desc"),
        l4.alias("categoryLevel4Id"), l4.alias("categoryLevel4Desc"),
    )
    return conform(out, DIM_ITEM)


def fact_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines (lineitem x orders).  The campaign id is arithmetic on the order
    date, so no join against the calendar is needed here."""
    li = read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_returnflag")
    o = read(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_orderstatus")
    j = li.join(o, li.l_orderkey == o.o_orderkey, "inner")
    od = F.to_date("o_orderdate")
    days = F.datediff(od, F.lit(ANCHOR).cast("date"))
    k = (F.floor(days / PERIOD_DAYS) + 1).cast("long")
    base = F.col("l_partkey") % N_BASE
    on_campaign = (days >= 0) & (days % PERIOD_DAYS < LENGTH_DAYS) & ((base + k) % 8 == 0)
    out = j.select(
        od.alias("orderDate"),
        F.date_add(od, F.col("l_linenumber")).alias("deliveryDate"),
        _item_id(F.col("l_partkey")).alias("itemId"),
        F.col("l_partkey").cast("long").alias("itemSkey"),
        F.when(on_campaign, k).alias("salesCampignId"),
        F.when((F.col("l_returnflag") == "R") & (F.col("l_linenumber") == 5), -F.col("l_quantity"))
         .otherwise(F.col("l_quantity")).alias("salesQuantity"),
        F.lit(1).alias("orderCategoryId"),
        F.lit(None).cast("timestamp").alias("orderCancelledDatetime"),
        F.when(F.col("o_orderstatus") == "P", F.lit("Y")).otherwise(F.lit("N")).alias("cancelFlag"),
    )
    return conform(out, FACT_ORDER)


def wide_key_space_dim_item(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark variant: every part is its own base item (wide key space)."""
    d = dim_item(spark, sf_dir)
    return d.withColumn("itemId", F.col("itemSkey").cast("string"))


def wide_key_space_fact_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = fact_order(spark, sf_dir)
    return f.withColumn("itemId", F.col("itemSkey").cast("string"))


@dataclass
class Inputs:
    """The three pipeline inputs."""
    orders: DataFrame
    items: DataFrame
    campaigns: DataFrame


def load_inputs(spark: SparkSession, sf_dir: str, wide: bool = False) -> Inputs:
    if wide:
        return Inputs(wide_key_space_fact_order(spark, sf_dir),
                      wide_key_space_dim_item(spark, sf_dir), campaigns(spark, sf_dir))
    return Inputs(fact_order(spark, sf_dir), dim_item(spark, sf_dir), campaigns(spark, sf_dir))
