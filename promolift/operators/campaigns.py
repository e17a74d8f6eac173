"""Campaign calendar operators (J1-J3, T4, T5, S9 reshaping lives in sources.calendar).

The calendar has one row per campaign, so it is bounded by the number of campaigns
ever run (tens per year), independent of the order volume: it is the one input
that is always broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import campaign_week_number
from ..schemas import FLAG_COLS


def clean_calendar(campaigns: DataFrame) -> DataFrame:
    """Q13: drop null ids and keep one row per campaign id (earliest start first)."""
    w = Window.partitionBy("campaignId").orderBy("campaignStart", "campaignEnd")
    return (campaigns.where(F.col("campaignId").isNotNull())
            .withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn"))


def tag_campaigns(orders: DataFrame, campaigns: DataFrame) -> DataFrame:
    """J1 + T5 + T4: attach campaign dates by id, move late deliveries of campaign
    orders to the order date, number the campaign week and one-hot it.

    Adds ``campaignId``, ``late_delivery`` and ``campaign_week_0..3``; the delivery
    date is replaced by the adjusted one."""
    cal = clean_calendar(campaigns).select(
        F.col("campaignId"), F.col("campaignStart").alias("_cs"), F.col("campaignEnd").alias("_ce"))
    j = orders.join(cal, orders["salesCampignId"] == cal["campaignId"], "left")
    late = ((F.col("orderDate") >= F.col("_cs")) & (F.col("orderDate") <= F.col("_ce"))
            & (F.col("deliveryDate") > F.col("_ce")))
    late = F.coalesce(late, F.lit(False))
    j = (j.withColumn("late_delivery", late)
         .withColumn("deliveryDate", F.when(late, F.col("orderDate")).otherwise(F.col("deliveryDate"))))
    wk = F.coalesce(campaign_week_number(F.col("deliveryDate"), F.col("_cs"), F.col("_ce")), F.lit(0))
    j = j.withColumn("_cwn", wk)
    for i, c in enumerate(FLAG_COLS):
        j = j.withColumn(c, (F.col("_cwn") == i).cast("int"))
    return j.drop("_cs", "_ce", "_cwn")


def campaign_flag_daily(orders: DataFrame, item_calendar: DataFrame) -> DataFrame:
    """J2 (first generation): flag = order date inside the (item, campaign) window."""
    cal = item_calendar.select(F.col("itemId").alias("_iid"), F.col("campaignId").alias("_cid"),
                               "campaignStartDate", "campaignEndDate")
    j = orders.join(cal, (orders["itemId"] == cal["_iid"]) & (orders["salesCampignId"] == cal["_cid"]), "left")
    flag = ((F.col("orderDate") >= F.col("campaignStartDate"))
            & (F.col("orderDate") <= F.col("campaignEndDate")))
    return (j.withColumn("is_campaign_week", F.coalesce(flag, F.lit(False)).cast("int"))
            .drop("_iid", "_cid", "campaignStartDate", "campaignEndDate"))


def item_campaign_calendar(orders: DataFrame, campaigns: DataFrame) -> DataFrame:
    """Distinct (item, campaign) pairs seen in orders, with the campaign dates;
    null/0 ids and ids missing from the calendar are dropped."""
    pairs = (orders.where(F.col("salesCampignId").isNotNull() & (F.col("salesCampignId") != 0))
             .select("itemId", F.col("salesCampignId").alias("campaignId")).distinct())
    cal = clean_calendar(campaigns)
    return pairs.join(cal, "campaignId", "inner").select(
        "itemId", "campaignId", F.col("campaignStart").alias("campaignStartDate"),
        F.col("campaignEnd").alias("campaignEndDate"))
