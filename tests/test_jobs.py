"""Hand-made frames for the older generations' jobs, the growing table and rejected lines."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from promolift.operators import weekly as WK
from promolift.operators.encoding import ordered_mean
from promolift.plans import recursive_job as RJ
from promolift.plans import scenario_job as SJ
from promolift.sources import io as IO
from promolift.sources import processed as PR

D = dt.date


# --- ordered target statistics ------------------------------------------------------------

def test_ordered_mean_by_hand(spark):
    """Labels count from the week after they are known; unseen ids get the prior."""
    w = [D(2024, 1, 1) + dt.timedelta(weeks=k) for k in range(5)]
    rows = [("a", w[0], 10.0, w[1]), ("a", w[1], 20.0, w[2]), ("a", w[2], 99.0, w[3]), ("a", w[3], None, None), ("b", w[0], 4.0, w[1]), ("b", w[2], 6.0, w[3]),
            ("c", w[3], 50.0, w[4]), (None, w[3], 1.0, w[4])]
    df = spark.createDataFrame(rows, "id string, week date, label double, known date")
    got = {(r["id"], r["week"]): r["m"] for r in ordered_mean(df, "id", "week", "label", "known", "m").collect()}
    assert got[("a", w[0])] is None and got[("b", w[0])] is None and got[("a", w[1])] is None      # known on w1, used from w2 on
    prior2 = 7.0                                    # (10 + 4) / 2 known before w2
    assert got[("a", w[2])] == pytest.approx((10 + 10 * prior2) / 11) and got[("b", w[2])] == pytest.approx((4 + 10 * prior2) / 11)
    prior3 = (10 + 20 + 4) / 3
    assert got[("a", w[3])] == pytest.approx((30 + 10 * prior3) / 12)
    assert got[("c", w[3])] == got[(None, w[3])] == pytest.approx(prior3)                          # unseen
    changed = spark.createDataFrame([(i, k, 1e6 if k >= w[2] and v is not None else v, n) for i, k, v, n in rows], df.schema)
    later = {(r["id"], r["week"]): r["m"] for r in ordered_mean(changed, "id", "week", "label", "known", "m").collect()}
    assert all(later[k] == v for k, v in got.items() if k[1] <= w[3])                              # no later label enters


# --- scenario overlay ----------------------------------------------------------------------

def snapshot(spark, flags):
    """One week of cluster A (a, b, c) and B (d): counters run over (week, item)."""
    rows, off, on = [], {"A": 5, "B": 2}, {"A": 3, "B": 0}
    for item, cl in (("a", "A"), ("b", "A"), ("c", "A"), ("d", "B")):
        f = flags.get(item, 0)
        off[cl], on[cl] = off[cl] + (1 - f), on[cl] + f
        rows.append((D(2024, 1, 1), item, cl, f, off[cl], on[cl], 0))
    return spark.createDataFrame(rows, "orderDate date, itemId string, cluster1To1Id string, is_campaign_week int, weeks_since_campaign long, campaigns_ytd long, other_campaign_in_cluster int")


def test_a_forced_campaign_moves_its_rivals(spark):
    got = SJ.overlay(snapshot(spark, {}), spark.createDataFrame([("b",)], "baseItemId string"))
    rows = {(r["itemId"], r["scenario"]): r for r in got.collect()}
    assert len(rows) == 8
    on = lambda s: [(rows[(i, s)]["is_campaign_week"], rows[(i, s)]["other_campaign_in_cluster"]) for i in "abcd"]
    assert on("no_campaign") == [(0, 0)] * 4
    assert on("with_campaign") == [(0, 1), (1, 0), (0, 1), (0, 0)]
    count = lambda s: [(rows[(i, s)]["weeks_since_campaign"], rows[(i, s)]["campaigns_ytd"]) for i in "abcd"]
    assert count("no_campaign") == [(6, 3), (7, 3), (8, 3), (3, 0)]
    assert count("with_campaign") == [(6, 3), (6, 4), (7, 4), (3, 0)]


def test_a_campaign_forced_off(spark):
    got = SJ.overlay(snapshot(spark, {"b": 1, "c": 1}), spark.createDataFrame([("b",)], "baseItemId string"))
    rows = {(r["itemId"], r["scenario"]): r for r in got.collect()}
    assert [rows[(i, "no_campaign")]["is_campaign_week"] for i in "abc"] == [0, 0, 1]
    assert [rows[(i, "no_campaign")]["other_campaign_in_cluster"] for i in "abc"] == [1, 1, 0]       # c still has its own
    clusters = spark.createDataFrame([(D(2024, 1, 1), "A", 9, 9.0, 9, 7.5), (D(2024, 1, 1), "B", 9, 9.0, 9, 1.0)],
                                     "orderDate date, cluster1To1Id string, is_campaign_week int, weeks_since_campaign double, campaigns_ytd long, cluster_sales_lag_1 double")
    c = {(r["cluster1To1Id"], r["scenario"]): r for r in SJ.cluster_overlay(clusters, got).collect()}
    assert [c[("A", s)]["is_campaign_week"] for s in SJ.SCENARIOS] == [1, 1] and c[("B", "with_campaign")]["is_campaign_week"] == 0
    assert c[("A", "with_campaign")]["campaigns_ytd"] == 5 and c[("A", "no_campaign")]["campaigns_ytd"] == 4
    assert c[("A", "no_campaign")]["cluster_sales_lag_1"] == 7.5


def test_cluster_totals_differ_by_scenario(spark, monkeypatch):
    """J12 on the fixture with few rounds: some cluster's total is another with the campaign."""
    from dataclasses import replace

    from promolift.plans import params as P
    from promolift.plans.forecast_job import campaign_items
    from promolift.plans.registry import _inputs

    from .conftest import SF_SMALL
    inp = _inputs(spark, SF_SMALL)
    metrics, combined, comparison = SJ.run_scenarios(inp.orders, inp.items, inp.campaigns, campaign_items(inp.orders, 69), P.CAMPAIGN_START, P.CAMPAIGN_END, P.FORECAST_DATE,
                                                     params=replace(SJ.G1_PARAMS, rounds=60, least_rows=20))
    assert [m[0] for m in metrics] == SJ.horizons(P.FORECAST_DATE, P.CAMPAIGN_START, P.CAMPAIGN_END)
    assert all(0 <= m[2] <= 200 and m[4] >= 0 and m[5] > 0 for m in metrics)
    t = combined.groupBy("cluster1To1Id", "horizon").agg(F.min("pred_cluster").alias("a"), F.max("pred_cluster").alias("b"), F.countDistinct("scenario").alias("n"))
    assert t.where("n = 2 AND a < b").count() > 0
    share = combined.groupBy("cluster1To1Id", "horizon", "scenario").agg(F.sum("pred_share").alias("s"))
    assert share.agg(F.max("s")).first()[0] <= 1 + 1e-9 and comparison.count() > 0


# --- recursion -----------------------------------------------------------------------------

class Stub:
    """A model that is a formula over features."""

    def __init__(self, f):
        self.f = f

    def transform(self, df):
        return df.withColumn("prediction", self.f())


def state(spark, rows):
    return spark.createDataFrame(rows, "itemId string, cluster1To1Id string, item_hist array<double>, cluster_hist array<double>, item_campaign_weeks long, cluster_campaign_weeks long, "
                                       "base_ytd long, last_wsc long")


def test_three_steps_by_hand(spark):
    """The cluster's new value is a lag of its item in the next step; lags take the campaign's
    predictions, unfloored; forecasts are floored."""
    models = {
        "item": Stub(lambda: F.col("item_sales_lag_1") + 10 * F.col("cluster_sales_lag_1") + 100 * F.col("is_campaign_week") + F.col("item_sales_lag_2") / 8),
        "cluster": Stub(lambda: F.col("cluster_sales_rolling4w") - 50 + F.col("campaigns_ytd") * 4 - F.col("weeks_since_campaign")),
    }
    st = state(spark, [("i", "c", [1.0, 2.0, 3.0, 4.0], [40.0, 44.0], 5, 12, 2, 3)])
    weeks = RJ.prediction_weeks("2001-07-10", "2001-07-30")
    out, last = RJ.advance(st, weeks, models)
    rows = {(r["step"], r["campaign_on"]): r for r in out.collect()}
    i, c, want = [1.0, 2.0, 3.0, 4.0], [40.0, 44.0], {}
    for k in range(3):
        roll = sum(c[-4:]) / len(c[-4:])
        for on in (True, False):
            ytd, wsc = (2 + k + 1, 0) if on else (2, 3 + k + 1)
            want[(k + 1, on)] = (i[-1] + 10 * c[-1] + 100 * on + i[-2] / 8, roll - 50 + 4 * ytd - wsc)
        i.append(want[(k + 1, True)][0])
        c.append(want[(k + 1, True)][1])
    assert len(rows) == 6 and weeks[0] == D(2001, 7, 9)
    for k, (a, b) in want.items():
        assert rows[k]["item"] == pytest.approx(max(a, 0)) and rows[k]["cluster"] == pytest.approx(max(b, 0)) and rows[k]["week_start"] == weeks[k[0] - 1]
    assert any(b < 0 for _, b in want.values())
    assert last.first()["item_hist"] == pytest.approx(i) and last.first()["cluster_hist"] == pytest.approx(c)


def test_fallback_and_global(spark):
    st = state(spark, [("few", "c", [1.0], [2.0], 2, 12, 0, 0), ("none", "d", [1.0], [2.0], 0, 3, 0, 0), ("own", "c", [1.0], [2.0], 3, 12, 0, 0)])
    rows = [(i, cl, 1, D(2001, 7, 9), on, item, cluster) for i, cl, v in (("few", "c", (9.0, 5.0, 30.0, 20.0)), ("none", "d", (9.0, 5.0, 30.0, 0.0)), ("own", "c", (9.0, 5.0, 30.0, 20.0)))
            for on, item, cluster in ((True, v[0], v[2]), (False, v[1], v[3]))]
    f = spark.createDataFrame(rows, "itemId string, cluster1To1Id string, step int, week_start date, campaign_on boolean, item double, cluster double")
    got = {(r["itemId"], r["campaign_on"]): (r["item"], r["effect_level"]) for r in RJ.with_fallback(f, st).collect()}
    assert got[("few", True)] == (7.5, "cluster") and got[("few", False)] == (5.0, "cluster")
    assert got[("none", True)] == (5.0, "global") and got[("own", True)] == (9.0, "item")
    g = RJ.global_forecast(st, [D(2001, 7, 9)], Stub(lambda: F.col("cluster_sales_lag_1") * F.col("is_campaign_week") - F.col("weeks_since_campaign")))
    assert {(r["itemId"], r["campaign_on"]): r["global"] for r in g.collect()}[("few", True)] == 2.0 and g.agg(F.min("global")).first()[0] == 0.0


def test_ten_weeks(spark):
    """Items below ten weeks get no forecast; a state holds four values of item and cluster."""
    w = [D(2024, 1, 1) + dt.timedelta(weeks=k) for k in range(12)]
    item = spark.createDataFrame([(i, x, "c", float(n), 0, 1, 2) for i, m in (("long", 12), ("short", 9)) for n, x in enumerate(w[:m])],
                                 "key string, orderDate date, cluster1To1Id string, salesQuantityKgL double, is_campaign_week int, weeks_since_campaign long, campaigns_ytd long")
    cluster = spark.createDataFrame([("c", x, 10.0 * n, int(n % 2)) for n, x in enumerate(w)], "key string, orderDate date, salesQuantityKgL double, is_campaign_week int")
    s = RJ.initial_state({"item": item, "cluster": cluster}, spark.createDataFrame([("long",), ("short",)], "b string")).collect()
    assert [r["itemId"] for r in s] == ["long"]
    assert s[0]["item_hist"] == [8.0, 9.0, 10.0, 11.0] and s[0]["cluster_hist"] == [80.0, 90.0, 100.0, 110.0] and s[0]["cluster_campaign_weeks"] == 6


# --- growing processed table -----------------------------------------------------------------

def members(spark):
    return spark.createDataFrame([("a", "A"), ("b", "A"), ("c", "B"), ("d", "C")], "baseItemId string, cluster1To1Id string")


def test_only_missing_clusters_are_built(spark, tmp_path):
    built = []

    def build(keys, version=1):
        own = sorted(r["baseItemId"] for r in keys.collect())
        built.append(own)
        return keys.where("baseItemId <> 'd'").withColumn("v", F.lit(version))       # d is covered, without rows

    store, m = f"file://{tmp_path}/s", members(spark)
    ask = lambda *ids: spark.createDataFrame([(i,) for i in ids], "baseItemId string")
    assert PR.read(spark, store) is None
    assert {(r["baseItemId"], r["part"]) for r in PR.load_or_build(spark, store, ask("b"), m, build).collect()} == {("a", 0), ("b", 0)}
    assert built == [["a", "b"]]                                                       # the whole cluster
    PR.load_or_build(spark, store, ask("a", "c", "d"), m, build)
    assert built[1:] == [["c", "d"]]
    PR.load_or_build(spark, store, ask("a", "b", "c", "d"), m, build)
    assert len(built) == 2                                                             # d isn't built again
    got = PR.load_or_build(spark, store, ask("a"), m, lambda k: build(k, 2), refresh=True)
    assert {(r["baseItemId"], r["v"], r["part"]) for r in got.collect()} == {("a", 2, 2), ("b", 2, 2), ("c", 1, 1)}


def test_a_failed_build_leaves_the_table(spark, tmp_path):
    store, m = f"file://{tmp_path}/s", members(spark)
    ask = spark.createDataFrame([("a",)], "baseItemId string")
    before = PR.load_or_build(spark, store, ask, m, lambda k: k.withColumn("v", F.lit(1))).collect()

    def broken(keys):
        return keys.withColumn("v", F.raise_error(F.lit("lost")).cast("int"))

    with pytest.raises(Exception, match="lost"):
        PR.load_or_build(spark, store, spark.createDataFrame([("c",)], "baseItemId string"), m, broken).collect()
    assert PR.read(spark, store).collect() == before
    again = PR.load_or_build(spark, store, spark.createDataFrame([("c",)], "baseItemId string"), m, lambda k: k.withColumn("v", F.lit(1)))
    assert again.count() == 3


# --- rejected lines --------------------------------------------------------------------------

def lines(spark):
    flags = "campaign_week_0 int, campaign_week_1 int, campaign_week_2 int, campaign_week_3 int"
    rows = [("1", 2.0), ("M1", 3.0), ("2", 5.0), ("2", -1.0), ("9", 7.0)]
    return spark.createDataFrame([(i, D(2024, 1, 1), q, 1, 0, 0, 0, None) for i, q in rows], f"itemId string, week_start date, salesQuantity double, {flags}, campaignId long")


def test_rejects_and_their_threshold(spark):
    master = spark.createDataFrame([("1", "A", 0.5)], "baseItemId string, cluster1To1Id string, itemUnitConversion double")
    weekly = WK.weekly_item_lines(lines(spark), master)
    same = lambda d: d
    with pytest.raises(ValueError, match=r"3 of 5 order lines .*\['2', '9'\]"):
        WK.split_mapped(weekly, same, most_rejected=0.59)
    with pytest.raises(ValueError):
        WK.require_mapped(weekly, same)
    mapped, rejects = WK.split_mapped(weekly, same, most_rejected=0.6)
    assert [(r["baseItemId"], r["salesQuantityKgL"]) for r in mapped.collect()] == [("1", 2.5)]
    assert sorted(map(tuple, rejects.collect())) == [("2", 1, 2, 5.0), ("9", 1, 1, 7.0)]


def test_lines_are_not_dropped(spark):
    master = spark.createDataFrame([("1", "A", 0.5)], "baseItemId string, cluster1To1Id string, itemUnitConversion double")
    with pytest.raises(Exception, match="without a unit in the master"):
        WK.orders_kgl(lines(spark), master).collect()
    assert WK.orders_kgl(lines(spark).where("itemId <> '9' AND itemId <> '2'"), master).count() == 2


# --- formats ------------------------------------------------------------------------------------

def test_unknown_format(spark):
    with pytest.raises(ValueError, match="unsupported storage format: xlsx"):
        IO.read_table(spark, "/nowhere", "xlsx")
