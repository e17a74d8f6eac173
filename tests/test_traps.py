"""Hand-made frames with known answers for the semantic traps of SURVEY 7.3."""
import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from promolift.functions.stats import exact_median
from promolift.operators import campaigns as C
from promolift.operators import features as FE
from promolift.operators import training as TR
from promolift.operators import universe as U
from promolift.operators import weekly as WK

D = dt.date


def _items(spark, rows):
    return spark.createDataFrame(rows, "itemId string, itemSkey long, cluster1To1Id string")


def test_q29_first_non_empty_cluster(spark):
    items = _items(spark, [("5", 1, ""), ("M5", 2, "C9"), ("S5", 3, "C7"), ("6", 4, None), ("K6", 5, "")])
    got = {r["baseItemId"]: r["cluster1To1Id"] for r in U.harmonized_clusters(items).collect()}
    assert got == {"5": "C9", "6": "6"}


def test_q21_variant_prefix_strip(spark):
    df = spark.createDataFrame([("M528",), ("S12",), ("K1",), ("77",), ("MM3",)], "itemId string")
    got = [r[0] for r in df.select(U.base_item_id(F.col("itemId"))).collect()]
    assert got == ["528", "12", "1", "77", "M3"]


def _orders(spark, rows):
    return spark.createDataFrame(
        rows, "orderDate date, deliveryDate date, salesCampignId long, itemId string")


def test_q12_long_campaign_week4_sets_no_flag(spark):
    cal = spark.createDataFrame([(1, D(2024, 1, 1), D(2024, 1, 28))], "campaignId long, campaignStart date, campaignEnd date")
    o = _orders(spark, [(D(2024, 1, 20), D(2024, 1, 23), 1, "1")])   # day 22 -> campaign week 4
    r = C.tag_campaigns(o, cal).first()
    assert [r[f"campaign_week_{k}"] for k in range(4)] == [0, 0, 0, 0]


def test_t5_late_delivery_uses_order_date(spark):
    cal = spark.createDataFrame([(1, D(2024, 1, 2), D(2024, 1, 22))], "campaignId long, campaignStart date, campaignEnd date")
    o = _orders(spark, [(D(2024, 1, 20), D(2024, 1, 25), 1, "1")])
    r = C.tag_campaigns(o, cal).first()
    assert r["late_delivery"] and r["deliveryDate"] == D(2024, 1, 20) and r["campaign_week_3"] == 1


def test_q13_calendar_duplicates_and_nulls(spark):
    cal = spark.createDataFrame([(1, D(2024, 1, 2), D(2024, 1, 22)), (1, D(2024, 3, 2), D(2024, 3, 22)),
                                 (None, D(2024, 5, 1), D(2024, 5, 21))],
                                "campaignId long, campaignStart date, campaignEnd date")
    o = _orders(spark, [(D(2024, 1, 5), D(2024, 1, 6), 1, "1")])
    t = C.tag_campaigns(o, cal)
    assert t.count() == 1 and t.first()["campaign_week_1"] == 1


def test_q6_mixed_week_counts_as_both(spark):
    rows = [("1", D(2024, 1, 2), 10.0, 1, 0, "c", 7), ("1", D(2024, 1, 2), 5.0, 0, 1, "c", 7)]
    t = spark.createDataFrame(rows, "baseItemId string, week_start date, salesQuantityKgL double, "
                                    "campaign_week_0 int, campaign_week_1 int, cluster1To1Id string, campaignId long") \
        .withColumn("campaign_week_2", F.lit(0)).withColumn("campaign_week_3", F.lit(0))
    r = WK.weekly_item_sales(t).first()
    assert r["campaign_week_0"] == 1 and r["campaign_week_1"] == 1 and r["salesQuantityKgL"] == 15.0


def test_q1_fractional_and_truncated_intensity(spark):
    rows = [("a", "c", D(2024, 1, 2), 1.0, 0, 1), ("b", "c", D(2024, 1, 2), 1.0, 1, 0)]
    iw = spark.createDataFrame(rows, "baseItemId string, cluster1To1Id string, week_start date, "
                                     "salesQuantityKgL double, campaign_week_0 int, campaign_week_1 int") \
        .withColumn("campaign_week_2", F.lit(0)).withColumn("campaign_week_3", F.lit(0)) \
        .withColumn("campaignId", F.lit(None).cast("long")).withColumn("n_lines", F.lit(1))
    assert WK.weekly_cluster_sales(iw).first()["campaign_week_1"] == 0.5
    assert WK.weekly_cluster_sales(iw, "truncate").first()["campaign_week_1"] == 0.0


def test_q2_gap_weeks_are_neither_baseline_nor_campaign(spark):
    rows = [("a", D(2024, 1, 2), 4.0, 1), ("a", D(2024, 1, 16), 6.0, 1)]
    iw = spark.createDataFrame(rows, "baseItemId string, week_start date, salesQuantityKgL double, campaign_week_0 int") \
        .withColumn("campaign_week_1", F.lit(0)).withColumn("campaign_week_2", F.lit(0)) \
        .withColumn("campaign_week_3", F.lit(0)).withColumn("cluster1To1Id", F.lit("c")) \
        .withColumn("campaignId", F.lit(None).cast("long"))
    g = WK.fill_missing_weeks(iw, "baseItemId")
    assert g.count() == 3
    gap = g.where(F.col("week_start") == D(2024, 1, 9)).first()
    assert gap["campaign_week_0"] == 0 and gap["salesQuantityKgL"] == 0.0 and gap["cluster1To1Id"] == "c"
    n = FE.compute_normalizers(g, "baseItemId").first()["normalizer"]
    assert n == 5.0   # median of the two real weeks; the zero gap week is excluded


def test_q18_zero_global_median_gives_null_not_error(spark):
    rows = [("a", D(2024, 1, 2), 0.0, 0), ("b", D(2024, 1, 2), 0.0, 0)]
    df = spark.createDataFrame(rows, "baseItemId string, week_start date, salesQuantityKgL double, campaign_week_0 int")
    out, _ = FE.normalize(df, "baseItemId")
    assert all(r["salesQuantityKgL_log"] is None for r in out.collect())


def test_exact_median_matches_numpy(spark):
    rng = np.random.default_rng(7)
    vals = np.concatenate([rng.exponential(5, 3001), np.zeros(1500)])
    df = spark.createDataFrame([(float(v),) for v in vals], "x double")
    assert abs(exact_median(df, "x") - float(np.median(vals))) < 1e-12


def test_q28_recency_sample_and_split_are_deterministic(spark):
    rows = [(str(i), D(2024, 1, 2) + dt.timedelta(days=7 * (i % 3)), 1) for i in range(12)]
    df = spark.createDataFrame(rows, "baseItemId string, week_start date, campaign_week_0 int")
    top = TR.top_recent(df, 5, "baseItemId").collect()
    assert sorted(r["baseItemId"] for r in top) == sorted(["11", "2", "5", "8", "1"])
    s = {r["baseItemId"]: r["split"] for r in TR.temporal_split(df, "baseItemId").collect()}
    assert sum(v == "train" for v in s.values()) == int(12 * 0.6)


def test_orders_of_unmapped_items_fail_the_job(spark):
    from promolift.operators.weekly import require_mapped, weekly_item_lines
    day = dt.date(2001, 7, 10)
    lines = spark.createDataFrame([("M7", day, 2.0), ("7", day, -9.0), ("8", day, 1.0), (None, day, 1.0)], "itemId string, week_start date, salesQuantity double")
    for c in ("campaign_week_0", "campaign_week_1", "campaign_week_2", "campaign_week_3"):
        lines = lines.withColumn(c, F.lit(0))
    lines = lines.withColumn("campaignId", F.lit(None).cast("long"))
    master = spark.createDataFrame([("7", "c", 0.5), ("8", "c", 1.0)], "baseItemId string, cluster1To1Id string, itemUnitConversion double")
    got = require_mapped(weekly_item_lines(lines, master), lambda d: d).collect()
    assert {r["baseItemId"]: (r["salesQuantityKgL"], r["n_lines"]) for r in got} == {"7": (1.0, 2), "8": (1.0, 1)}
    with pytest.raises(ValueError, match="8"):
        require_mapped(weekly_item_lines(lines, master.where("baseItemId = '7'")), lambda d: d)


def test_cluster_smape_needs_a_prediction(spark):
    from promolift.operators.report import compare_with_actuals
    pred = spark.createDataFrame([("a", 0.0), ("b", 4.0)], "k string, prediction_kgl double")
    base = spark.createDataFrame([("a", 1.0), ("b", 1.0)], "k string, baseline_kgl double")
    act = spark.createDataFrame([("a", 3.0), ("b", 4.0), ("c", 1.0)], "k string, actual_kgl double")
    got = {r["k"]: r["smape"] for r in compare_with_actuals(pred, base, act, "k", needs_prediction=True).collect()}
    assert got == {"a": None, "b": 0.0, "c": None}
    assert {r["k"]: r["smape"] for r in compare_with_actuals(pred, base, act, "k").collect()} == {"a": 200.0, "b": 0.0, "c": 200.0}


def test_last_year_weeks_zero_or_null(spark):
    import datetime as dt
    from promolift.operators.forecast import last_year_sales
    rows = [("a", dt.date(2000, 7, 10), 2.0), ("a", dt.date(2000, 7, 24), 3.0), ("b", dt.date(1999, 1, 4), 1.0)]
    df = spark.createDataFrame(rows, "baseItemId string, week_start date, salesQuantityKgL double")
    got = {r[0]: tuple(r)[1:] for r in last_year_sales(df, "baseItemId", "2001-07-10").collect()}
    assert got == {"a": (2.0, 0.0, 3.0), "b": (None, None, None)}


def test_folds_include_their_cutoff_week():
    from promolift.operators.training import fold_cutoffs
    assert fold_cutoffs(list(range(8)), 3) == [(0, 2, 4), (1, 4, 6), (2, 6, 7)]
    assert fold_cutoffs([], 3) == []
