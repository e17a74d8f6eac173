"""Item universe, id mapping and order hygiene.

Key sets are always DataFrames joined with ``left_semi`` / ``left_anti``; nothing is
collected into a Python list.  A request list given by the caller (a handful of
item ids) is turned into a DataFrame first.
"""

from __future__ import annotations


from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.dates import lit_date
from ..functions.units import WEIGHT_COLS, unit_conversion

VARIANT_PREFIXES = ["M", "S", "K"]   # fixed: leading letters that mark item variants
ID_PATTERN = r"^[0-9A-Za-z-]+$"      # fixed: accepted request id format


def base_item_id(item_id: Column) -> Column:
    """Item id without a leading variant letter."""
    return F.regexp_replace(item_id, "^[MSK]", "")


def is_empty(c: Column) -> Column:
    return c.isNull() | (F.trim(c) == "")


def key_frame(spark: SparkSession, keys, name: str) -> DataFrame:
    """A one-column key DataFrame from a DataFrame (projected) or a small request list."""
    if isinstance(keys, DataFrame):
        return keys.select(F.col(keys.columns[0]).cast("string").alias(name)).distinct()
    return spark.createDataFrame([(str(k),) for k in keys], f"{name} string")


# --- F1 / F2 / F3 ---------------------------------------------------------------

def valid_orders(orders: DataFrame, delivery_floor=None) -> DataFrame:
    """category 1, not cancelled, delivered on/after the floor date."""
    cond = ((F.col("orderCategoryId") == 1) & F.col("orderCancelledDatetime").isNull()
            & (F.col("cancelFlag") == "N"))
    if delivery_floor is not None:
        cond = cond & (F.col("deliveryDate") >= lit_date(delivery_floor))
    return orders.where(cond)


def orders_for_keys(orders: DataFrame, keys: DataFrame, order_col: str, key_col: str | None = None) -> DataFrame:
    """key-set filter as a semi join (campaign ids, item keys, item ids)."""
    key_col = key_col or keys.columns[0]
    k = keys.select(F.col(key_col).alias("_k")).distinct()
    return orders.join(k, orders[order_col] == k["_k"], "left_semi")


def asof_orders(orders: DataFrame, forecast_date, strict: bool = True) -> DataFrame:
    """keep orders placed before the forecast date (``<=`` when not strict)."""
    d = lit_date(forecast_date)
    return orders.where(F.col("orderDate") < d if strict else F.col("orderDate") <= d)


# --- item master ------------------------------------------------------------------

def dedupe(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """K4: keep the first row per key under an explicit order (deterministic)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def harmonized_clusters(items: DataFrame) -> DataFrame:
    """one cluster per base item = the cluster of its lowest-key version with a
    non-empty cluster; the base id itself when no version has one."""
    it = items.withColumn("baseItemId", base_item_id(F.col("itemId")))
    first = it.groupBy("baseItemId").agg(
        F.min(F.when(~is_empty(F.col("cluster1To1Id")),
                     F.struct(F.col("itemSkey"), F.col("cluster1To1Id")))).alias("_c"))
    return first.select("baseItemId",
                        F.coalesce(F.col("_c.cluster1To1Id"), F.col("baseItemId")).alias("cluster1To1Id"))


def item_id_map(items: DataFrame) -> DataFrame:
    """J4 lookup: every item id (all versions and variants) -> base id."""
    return items.select("itemId", base_item_id(F.col("itemId")).alias("baseItemId")).distinct()


def latest_item_version(items: DataFrame) -> DataFrame:
    """K3: newest version (max itemSkey, then itemId) per base item, all columns kept.  Versions
    are compared by their key alone; columns that nothing reads are pruned from the rest."""
    it = items.withColumn("baseItemId", base_item_id(F.col("itemId")))
    others = [c for c in it.columns if c != "baseItemId"]
    agg = it.groupBy("baseItemId").agg(F.max_by(F.struct(*others), F.struct("itemSkey", "itemId")).alias("_v"))
    return agg.select("baseItemId", "_v.*")


def item_master(items: DataFrame, unit: float | None = 1.0) -> DataFrame:
    """Prepared item table: one row per base item with harmonised cluster, unit factor
    (U1; ``unit`` where the item has no usable weight) and the category hierarchy of the newest
    version."""
    clusters = harmonized_clusters(items)
    cats = [c for c in items.columns if c.startswith("categoryLevel")]
    latest = latest_item_version(items.select("itemId", "itemSkey", "itemDesc", *WEIGHT_COLS, *cats))
    return (latest.join(clusters, "baseItemId", "left")
            .select("baseItemId", "itemId", "itemDesc", "itemSkey", "cluster1To1Id",
                    unit_conversion(otherwise=unit).alias("itemUnitConversion"), *cats))


def unmapped_items(orders: DataFrame, items: DataFrame) -> DataFrame:
    """J4 integrity check: order item ids missing from the item master."""
    return (orders.select("itemId").distinct()
            .join(items.select("itemId").distinct(), "itemId", "left_anti"))


# --- F4 / F5: universe --------------------------------------------------------------

def item_universe(orders: DataFrame, items: DataFrame, campaigns: DataFrame,
                  requested: DataFrame | None = None) -> DataFrame:
    """campaign items U requested -> their clusters -> all items of those clusters
    -> plus focus items without a cluster -> plus all variants; returns the item rows
    (all versions) of the universe with their harmonised cluster and base id."""
    camp_ids = campaigns.select(F.col("campaignId").alias("salesCampignId"))
    focus = (orders.join(camp_ids, "salesCampignId", "left_semi")
             .select(base_item_id(F.col("itemId")).alias("baseItemId")))
    if requested is not None:
        focus = focus.unionByName(requested.select(base_item_id(F.col(requested.columns[0])).alias("baseItemId")))
    focus = focus.distinct()
    clusters = harmonized_clusters(items)
    focus_clusters = clusters.join(focus, "baseItemId", "left_semi").select("cluster1To1Id").distinct()
    bases = (clusters.join(focus_clusters, "cluster1To1Id", "left_semi").select("baseItemId")
             .unionByName(focus).distinct())
    it = items.withColumn("baseItemId", base_item_id(F.col("itemId")))
    return (it.drop("cluster1To1Id").join(bases, "baseItemId", "left_semi")
            .join(clusters, "baseItemId", "left"))


def universe_orders(orders: DataFrame, universe: DataFrame) -> DataFrame:
    """F4, last step: the orders of the universe's item ids and of their variants (F5), also of
    variants that the item table lacks."""
    ids = universe.select("itemId").unionByName(variant_ids(universe).select(F.col("variantId").alias("itemId"))).distinct()
    return orders.join(ids, "itemId", "left_semi")


def variant_ids(items: DataFrame) -> DataFrame:
    """the M/S/K variant ids of every unprefixed id (as the fetch step builds them)."""
    plain = items.where(~F.col("itemId").rlike("^[MSK]")).select("itemId").distinct()
    pre = F.explode(F.array(*[F.lit(p) for p in VARIANT_PREFIXES])).alias("_p")
    return plain.select("itemId", pre).select(
        F.col("itemId").alias("baseItemId"), F.concat("_p", "itemId").alias("variantId"))


# --- F7: leakage guard --------------------------------------------------------------

def leakage_guard(orders: DataFrame, items: DataFrame, campaigns: DataFrame, campaign_start, sold: DataFrame | None = None, materialize_fn=None):
    """drop items seen only on later campaigns, and their cluster mates, except
    items ever on a past/current campaign; drop later campaigns.  ``sold``: the (itemId,
    salesCampignId) pairs of ``orders``, if the caller has them written.  ``materialize_fn``:
    applied to the excluded item ids, which items and orders both ask for.
    Returns (items, orders, campaigns) filtered."""
    start = lit_date(campaign_start)
    cal = campaigns.select("campaignId", F.col("campaignStart") > start)
    cal = cal.withColumnRenamed(cal.columns[1], "_future")
    pairs = orders.select("itemId", "salesCampignId") if sold is None else sold
    tagged = pairs.join(cal, pairs.salesCampignId == cal.campaignId, "inner")
    future_items = tagged.where("_future").select("itemId").distinct()
    past_items = tagged.where("NOT _future").select("itemId").distinct()
    only_future = future_items.join(past_items, "itemId", "left_anti")
    bad_clusters = (items.join(only_future, "itemId", "left_semi")
                    .where(~is_empty(F.col("cluster1To1Id"))).select("cluster1To1Id").distinct())
    excluded = (items.join(bad_clusters, "cluster1To1Id", "left_semi").select("itemId").distinct()
                .join(past_items, "itemId", "left_anti"))
    if materialize_fn is not None:
        excluded = materialize_fn(excluded)
    return (items.join(excluded, "itemId", "left_anti"),
            orders.join(excluded, "itemId", "left_anti"),
            campaigns.where(F.col("campaignStart") <= start))


# --- F8 -----------------------------------------------------------------------------

def on_campaign(prefix: str = "campaign_week_") -> Column:
    return (F.col(f"{prefix}1") == 1) | (F.col(f"{prefix}2") == 1) | (F.col(f"{prefix}3") == 1)


def mark_last_campaign_week(weekly: DataFrame, id_col: str = "baseItemId") -> DataFrame:
    """``weekly`` with ``_last_cw``, the id's last campaign week, which ``campaign_items_only`` asks
    for: added beside other windows over the id, it needs no exchange of its own."""
    return weekly.withColumn("_last_cw", F.max(F.when(on_campaign(), F.col("week_start"))).over(Window.partitionBy(id_col)))


def campaign_items_only(weekly: DataFrame, keep: DataFrame | None = None,
                        id_col: str = "baseItemId") -> DataFrame:
    """F8: keep items ever on campaign plus ``keep`` targets; for non-targets drop the
    weeks after the item's last campaign week."""
    df = weekly if "_last_cw" in weekly.columns else mark_last_campaign_week(weekly, id_col)
    if keep is not None:
        k = keep.select(F.col(keep.columns[0]).cast("string").alias(id_col)).distinct() \
                .withColumn("_target", F.lit(True))
        df = df.join(k, id_col, "left")
        target = F.coalesce(F.col("_target"), F.lit(False))
    else:
        target = F.lit(False)
    return (df.where(target | (F.col("week_start") <= F.col("_last_cw")))
            .drop("_last_cw", "_target"))


# --- F10 ------------------------------------------------------------------------------

def eligible_ids(weekly: DataFrame, id_col: str, min_weeks: int = 10) -> DataFrame:
    """ids with at least ``min_weeks`` weekly rows (with sales)."""
    return (weekly.groupBy(id_col).agg(F.count("*").alias("n_weeks"))
            .where(F.col("n_weeks") >= min_weeks))


# --- F12: request checks as a table ---------------------------------------------------

def request_rejections(requests: DataFrame, items: DataFrame, today=None, max_horizon: int = 12,
                       min_horizon: int = 0) -> DataFrame:
    """one row per rejected request with the first failing reason.

    ``requests`` columns: request_id, item_ids (comma separated), forecast_date,
    campaign_start (ISO strings)."""
    ids = (requests.select("request_id", F.explode(F.split("item_ids", ",")).alias("raw"))
           .select("request_id", F.trim("raw").alias("item_id")))
    known = item_id_map(items).select(F.col("baseItemId").alias("item_id")).distinct()
    bad_ids = (ids.where((F.col("item_id") == "") | ~F.col("item_id").rlike(ID_PATTERN))
               .groupBy("request_id").agg(F.lit("bad item id").alias("reason")))
    unknown = (ids.where(F.col("item_id").rlike(ID_PATTERN))
               .join(known, "item_id", "left_anti")
               .groupBy("request_id").agg(F.lit("unknown item id").alias("reason")))
    fd = F.try_to_date("forecast_date")
    cs = F.try_to_date("campaign_start")
    horizon = F.floor(F.datediff(cs, fd) / 7)
    today_c = lit_date(today) if today is not None else F.current_date()
    reason = (F.when(F.col("item_ids").isNull() | (F.trim("item_ids") == ""), "no item ids")
              .when(fd.isNull(), "bad forecast date")
              .when(cs.isNull(), "bad campaign start")
              .when(fd > today_c, "forecast date in the future")
              .when(fd >= cs, "forecast date not before campaign start")
              .when(horizon > max_horizon, "horizon too long")
              .when(horizon < min_horizon, "horizon too short"))
    dates = requests.select("request_id", reason.alias("reason")).where(F.col("reason").isNotNull())
    allr = dates.unionByName(bad_ids).unionByName(unknown)
    return allr.groupBy("request_id").agg(F.min("reason").alias("reason"))
