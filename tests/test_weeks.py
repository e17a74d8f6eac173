"""Gap filling, normalisers and samples on hand-made frames, without an exchange of the whole grid."""
import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from promolift.operators import features as FE
from promolift.operators import training as TR
from promolift.operators import weekly as WK

W = [dt.date(2024, 1, 2) + dt.timedelta(weeks=k) for k in range(8)]
KIND = "baseItemId string, week_start date, cluster1To1Id string, campaignId long, salesQuantityKgL double, campaign_week_0 int, campaign_week_1 int, extra string"


def measured(spark):
    rows = [("a", W[1], "x", None, 1.0, 1, 0, "p"), ("a", W[4], None, 7, 2.0, 0, 1, "q"), ("a", W[5], "y", None, None, None, 0, None),
            ("b", W[0], "x", 3, 5.0, 1, 0, "r"), ("b", W[7], "x", None, 6.0, 1, 0, "s"), ("c", W[3], None, None, 0.0, 1, 0, "t"),
            ("c", W[3], None, 9, 4.0, 1, 0, "u"), ("d", W[2] + dt.timedelta(days=1), "z", 8, 9.0, 1, 0, "v"), (None, W[2], "x", 1, 3.0, 1, 0, "w"),
            ("b", W[3] + dt.timedelta(days=2), "o", 5, 1.0, 1, 0, "off")]
    return spark.createDataFrame(rows, KIND)


def by_join(weekly, lo, hi):
    """The grid joined with the measured rows."""
    grid = weekly.select("baseItemId").distinct().select("baseItemId", F.explode(F.sequence(F.lit(lo), F.lit(hi), F.expr("INTERVAL 7 DAYS"))).alias("week_start"))
    d = grid.join(weekly, ["baseItemId", "week_start"], "left").fillna(0.0, ["salesQuantityKgL"]).fillna(0, ["campaign_week_0", "campaign_week_1"])
    w = Window.partitionBy("baseItemId").orderBy("week_start").rowsBetween(Window.unboundedPreceding, 0)
    return d.withColumns({c: F.last(c, ignorenulls=True).over(w) for c in ("cluster1To1Id", "campaignId")})


@pytest.mark.parametrize("bounds", [None, (W[0], W[7]), (W[2], W[5])])
@pytest.mark.parametrize("grid_rows", [2_000_000, 3])
def test_gap_filling_joins_no_grid(spark, monkeypatch, bounds, grid_rows):
    """Rows as by a join, with an id without rows on the grid, a null id and two rows in a week."""
    monkeypatch.setattr(WK, "GRID_ROWS", grid_rows, raising=False)
    got = WK.fill_missing_weeks(measured(spark), "baseItemId", bounds)
    want = by_join(measured(spark), *(bounds or (W[0], W[7])))
    assert got.columns == want.columns and got.schema["campaign_week_0"].dataType.simpleString() == "int"
    plain = lambda d: sorted(repr(tuple(r)[:2] + tuple(r)[4:] + ((r["cluster1To1Id"], r["campaignId"]) if r["baseItemId"] != "c" else ())) for r in d.collect())
    assert plain(got) == plain(want)
    assert "Join" not in got._jdf.queryExecution().executedPlan().toString()


def test_normalizers_in_a_window_are_the_grouped_ones(spark):
    g = WK.mark_post_campaign_weeks(WK.fill_missing_weeks(measured(spark).withColumn("campaign_week_3", F.lit(0)), "baseItemId"), "baseItemId")
    grouped = {r[0]: r[1] for r in FE.compute_normalizers(g, "baseItemId").collect()}
    plans = []
    out, norms = FE.normalize(g, "baseItemId", materialize_fn=lambda d: plans.append(d._jdf.queryExecution().executedPlan().toString()) or d.cache())
    assert {r[0]: r[1] for r in norms.collect()} == {k: v for k, v in grouped.items() if v is not None and k is not None}
    assert out.count() == g.count() and "Join" not in plans[0]


def test_a_sample_asks_for_the_latest_weeks_only(spark, monkeypatch):
    """Equal to a plain window over all baseline rows, though ids meet the rows of few weeks."""
    rows = [(f"{i}", W[k], int(i % 3 == 0 and k == 2), int(not (i % 3 == 0 and k == 2))) for i in range(30) for k in range(8)]
    df = spark.createDataFrame(rows, "baseItemId string, week_start date, campaign_week_1 int, campaign_week_0 int")
    df = df.where("NOT (campaign_week_1 = 1 AND baseItemId NOT IN ('0', '3'))")
    seen, real = [], TR.top_recent
    monkeypatch.setattr(TR, "top_recent", lambda d, n, c: seen.append(d.agg(F.min("week_start")).first()[0]) or real(d, n, c))
    got = sorted(tuple(r) for r in TR.balanced_sample(df, "item", 1).collect())
    base = sorted((r for r in rows if r[0] in ("0", "3") and r[2] == 0), key=lambda r: (-r[1].toordinal(), r[0]))[:10]
    assert got == sorted([r for r in rows if r[0] in ("0", "3") and r[2] == 1] + base)
    many = df.unionByName(spark.createDataFrame([(f"{j}", dt.date(2020, 1, 7) + dt.timedelta(weeks=k), 0, 1) for k in range(100) for j in range(10)], df.schema))
    TR.balanced_sample(many, "item", 1)
    assert seen[-1] > dt.date(2021, 1, 1)                 # most of the hundred early weeks aren't joined
