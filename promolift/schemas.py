"""Explicit schemas for the three pipeline inputs (checked at the boundary)."""

from pyspark.sql import types as T

FACT_ORDER = T.StructType([
    T.StructField("orderDate", T.DateType()),
    T.StructField("deliveryDate", T.DateType()),
    T.StructField("itemId", T.StringType()),
    T.StructField("itemSkey", T.LongType()),
    T.StructField("salesCampignId", T.LongType()),   # real spelling of the source column
    T.StructField("salesQuantity", T.DoubleType()),
    T.StructField("orderCategoryId", T.IntegerType()),
    T.StructField("orderCancelledDatetime", T.TimestampType()),
    T.StructField("cancelFlag", T.StringType()),
])

DIM_ITEM = T.StructType([
    T.StructField("itemId", T.StringType()),
    T.StructField("itemDesc", T.StringType()),
    T.StructField("itemSkey", T.LongType()),
    T.StructField("cluster1To1Id", T.StringType()),
    T.StructField("weightKgPreparedItemComparisonUnit", T.DoubleType()),
    T.StructField("netWeightKgComparisonUnit", T.DoubleType()),
    T.StructField("grossWeightKgComparisonUnit", T.DoubleType()),
    T.StructField("itemRegDate", T.DateType()),
] + [T.StructField(f"categoryLevel{lvl}{sfx}", T.StringType())
     for lvl in range(1, 5) for sfx in ("Id", "Desc")])

CAMPAIGNS = T.StructType([
    T.StructField("campaignId", T.LongType()),
    T.StructField("campaignStart", T.DateType()),
    T.StructField("campaignEnd", T.DateType()),
])

FLAG_COLS = ["campaign_week_0", "campaign_week_1", "campaign_week_2", "campaign_week_3"]
CAMPAIGN_FLAGS = FLAG_COLS[1:]

# Category columns of the item master, broadest first, and the model features
# made from them.
CATEGORY_IDS = ["categoryLevel1Id", "categoryLevel2Id", "categoryLevel3Id", "categoryLevel4Id"]
CATEGORY_FEATURES = ["cat_lift_l1", "cat_lift_l2", "cat_lift_l3", "cat_lift_l4", "best_cat_lift",
                     "cat_n_obs_l4", "weeks_since_last_campaign_l4", "n_campaigns_historical_l4"]


def conform(df, schema: T.StructType):
    """Select and cast ``df`` to ``schema`` (missing columns become typed nulls)."""
    from pyspark.sql import functions as F
    cols = []
    for f in schema.fields:
        if f.name in df.columns:
            cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return df.select(*cols)
