"""Backtest job.

The calendar selection is one small collect (campaigns of a year).  The valid order lines, the
(item, campaign) pairs in them, the harmonised items and the actuals' weekly rows are written once
for all campaigns.  Each campaign is
then a forecast job at ``start - 4 weeks`` on leakage-guarded inputs, whose models are fitted in
one pass for all campaigns; the actuals come from the full history.  A campaign without targets or training rows is skipped, as the modelled
driver does, and returned with its reason; when none can be validated, the job fails.
"""

from __future__ import annotations

import datetime as _dt
import logging
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import lit_date
from ..operators import forecast as FC
from ..operators import report as R
from ..operators import universe as U
from ..operators import weekly as WK
from ..operators.training import id_col
from ..session import union_all
from .forecast_job import NoTrainingRows, campaign_items, fit_jobs, run_forecast
from .preprocess import materialize, weekly_lines

BACKTEST_HORIZON_WEEKS = 4   # fixed: forecast date = campaign start - 4 weeks

log = logging.getLogger(__name__)


class NotEnoughData(ValueError):
    """A campaign that can't be validated: no targets, or no rows to train on."""

RESULT_SCHEMA = ("campaign_id long, item_id string, cluster_id string, campaign_start date, campaign_end date, "
                 + ", ".join(f"{lvl}_{x} double" for lvl in ("item", "cluster")
                             for x in ("actual", "predicted", "baseline", "smape", "lift_actual", "lift_predicted")))


def backtest_campaigns(campaigns: DataFrame, year: int) -> DataFrame:
    """Campaigns whose start and end fall in ``year``."""
    return campaigns.where((F.year("campaignStart") == year) & (F.year("campaignEnd") == year))


def _weekly_actuals(orders, items, campaigns, starts) -> dict:
    """All item weeks, written, for each weekday that one of ``starts`` falls on."""
    by_day = {s.weekday(): s for s in starts}
    return {d: WK.require_mapped(weekly_lines(orders, items, campaigns, s)[0], lambda x: materialize(x, "checkpoint")) for d, s in by_day.items()}


def _actuals(weekly, start, end, level):
    """Raw kg/L per target over the campaign weeks [start, end) on weeks aligned to the
    campaign weekday (Q20: raw kg/L, not re-normalised)."""
    iw = weekly[start.weekday()]
    if level == "cluster":
        iw = iw.groupBy("cluster1To1Id", "week_start").agg(F.sum("salesQuantityKgL").alias("salesQuantityKgL"))
    return iw.where((F.col("week_start") >= lit_date(start)) & (F.col("week_start") < lit_date(end)))


FAILURE_SCHEMA = "campaign_id long, reason string"


def _levels(items, clusters, value):
    """Rows of both levels of a campaign: level, id and ``value``."""
    own = [d.select(F.lit(level).alias("level"), F.col(id_col(level)).alias("id"), value)
           for level, d in (("item", items), ("cluster", clusters))]
    return union_all(own)


def _stored(spark, store, tasks):
    """A campaign's models from ``store``, fitted where they are missing."""
    from .model_store import fit_missing
    try:
        return fit_missing(spark, store, tasks, intervals=False)
    except NoTrainingRows as e:
        return e


def run_backtest(orders: DataFrame, items: DataFrame, campaigns: DataFrame, year: int,
                 max_campaigns: int | None = None, parallelism: int = 1,
                 single_model: bool = False, store: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(results, failures) of all campaigns of ``year`` (of the first ``max_campaigns``, if
    given), each with its own week models, or pooled ones as an option.  ``store``: a folder
    of models, see ``run_forecast``."""
    sel = backtest_campaigns(campaigns, year).orderBy("campaignStart", "campaignId").collect()
    if max_campaigns:
        sel = sel[:max_campaigns]
    harmonized = materialize(items.drop("cluster1To1Id").withColumn("baseItemId", U.base_item_id(F.col("itemId")))
                             .join(U.harmonized_clusters(items), "baseItemId"), "checkpoint")
    valid = materialize(U.valid_orders(orders), "checkpoint")
    sold = materialize(valid.select("itemId", "salesCampignId").distinct(), "checkpoint")
    weekly = _weekly_actuals(valid, items, campaigns, [c["campaignStart"] for c in sel])

    def prepare(c):
        cid, start = c["campaignId"], c["campaignStart"]
        try:
            targets = materialize(campaign_items(valid, cid), "checkpoint")
            if targets.isEmpty():
                raise NotEnoughData("no item was sold on the campaign")
            i2, o2, c2 = U.leakage_guard(valid, harmonized, campaigns, start, sold, lambda d: materialize(d, "checkpoint"))
            return run_forecast(o2, i2, c2, targets, start, start - _dt.timedelta(weeks=BACKTEST_HORIZON_WEEKS), BACKTEST_HORIZON_WEEKS,
                                use_plan=False, single_model=single_model, intervals=False, fit=False)   # results hold no intervals
        except NotEnoughData as e:   # as in the modelled driver; anything else fails the job
            return e

    def finish(c, job, models):
        start, res = c["campaignStart"], job.finish(models)
        ib = FC.seasonal_baseline(res.pre.item_weekly, "item", job.forecast_date, start, res.pre.item_normalizers, job.targets)
        cb = FC.seasonal_baseline(res.pre.cluster_weekly, "cluster", job.forecast_date, start, res.pre.cluster_normalizers)
        predicted = _levels(res.item_predictions.where("campaign_on"), res.cluster_predictions.where("campaign_on"), "prediction_kgl")
        return {"pred": materialize(predicted, "checkpoint"), "base": materialize(_levels(ib, cb, "baseline_kgl"), "checkpoint")}

    def compared(done, level):
        """P18 of all campaigns: their predictions, baselines and actuals."""
        idc = id_col(level)
        pred, base = (union_all([of(i, p[kind].where(F.col("level") == level).drop("level")) for i, _, _, p in done]).withColumnRenamed("id", idc)
                      for kind in ("pred", "base"))
        actual = []
        for i, c, job, _ in done:
            a = _actuals(weekly, c["campaignStart"], c["campaignEnd"], level)
            a = a.join(job.targets, "baseItemId", "left_semi") if level == "item" else a
            actual.append(of(i, a.select(idc, F.col("salesQuantityKgL").alias("actual_kgl"))))
        return R.compare_with_actuals(pred, base, union_all(actual), ["_run", idc], needs_prediction=level == "cluster")

    def of(i, rows):
        return rows.withColumn("_run", F.lit(i))

    def results(done):
        found = ("actual", "predicted", "baseline", "smape", "lift_actual", "lift_predicted")
        m = union_all([of(i, job.pre.items.select("baseItemId", "cluster1To1Id")) for i, _, job, _ in done])
        runs = orders.sparkSession.createDataFrame([(i, c["campaignId"], c["campaignStart"], c["campaignEnd"]) for i, c, _, _ in done],
                                                   "_run int, campaign_id long, campaign_start date, campaign_end date")
        cc = compared(done, "cluster").select("_run", "cluster1To1Id", *[F.col(x).alias(f"cluster_{x}") for x in found])
        rows = compared(done, "item").join(m, ["_run", "baseItemId"], "left").join(cc, ["_run", "cluster1To1Id"], "left").join(runs, "_run")
        return rows.select("campaign_id", F.col("baseItemId").alias("item_id"), F.col("cluster1To1Id").alias("cluster_id"), "campaign_start", "campaign_end",
                           *[F.col(x).alias(f"item_{x}") for x in found], *[f"cluster_{x}" for x in found])

    # campaigns are independent forecast jobs: a few at a time, their models all in one pass
    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        jobs = dict(enumerate(pool.map(prepare, sel)))
        tasks = {i: j.tasks for i, j in jobs.items() if not isinstance(j, NotEnoughData)}
        if store is None:
            models = fit_jobs(tasks, intervals=False) if tasks else {}
        else:
            models = {i: _stored(orders.sparkSession, store, own) for i, own in tasks.items()}
        jobs |= {i: NotEnoughData(str(m)) for i, m in models.items() if isinstance(m, NoTrainingRows)}
        bad = {i: e for i, e in jobs.items() if isinstance(e, NotEnoughData)}
        whole = [i for i in jobs if i not in bad]
        parts = list(pool.map(lambda i: finish(sel[i], jobs[i], models[i]), whole))
    failed = [(sel[i]["campaignId"], f"{type(e).__name__}: {e}"[:500]) for i, e in sorted(bad.items())]
    for cid, reason in failed:
        log.error("backtest of campaign %s failed: %s", cid, reason)
    if sel and not parts:
        raise RuntimeError(f"no campaign of {year} could be validated: {failed}")
    if parts:
        out = materialize(results([(i, sel[i], jobs[i], p) for i, p in zip(whole, parts)]), "checkpoint")
    else:   # no campaign in that year: an empty result with the result columns
        out = orders.sparkSession.createDataFrame([], RESULT_SCHEMA)
    return out, orders.sparkSession.createDataFrame(failed, FAILURE_SCHEMA)
