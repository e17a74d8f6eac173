"""C4: the preprocessing job as one lazy DataFrame program.

Order of steps (as in the modelled pipeline):
as-of filter -> id map, newest version, unit factor -> kg/L -> campaign tagging ->
weekly item and cluster roll-ups (+ competition) -> gap fill -> post-campaign marks
-> normalisation -> campaign-items-only filter -> category lift -> time features ->
lags -> cluster aliases -> cluster context on items -> cluster metadata.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import anchor_weekday
from ..operators import campaigns as C
from ..operators import features as FE
from ..operators import universe as U
from ..operators import weekly as WK
from ..session import cut_lineage


def materialize(df: DataFrame, how: str) -> DataFrame:
    """'checkpoint': reliable checkpoint in the shared ``spark.checkpoint.dir`` (cuts
    lineage, survives executor loss); 'persist': cache and fill; 'none': lazy."""
    if how == "checkpoint":
        return cut_lineage(df)
    if how == "persist":
        df = df.persist()
        df.count()
        return df
    return df


@dataclass
class Preprocessed:
    item_weekly: DataFrame
    cluster_weekly: DataFrame
    items: DataFrame                 # item master, one row per base item
    item_normalizers: DataFrame      # (baseItemId, normalizer)
    cluster_normalizers: DataFrame   # (cluster1To1Id, normalizer)
    rejects: DataFrame               # order lines without a master row, by item


def tagged_orders(orders: DataFrame, items: DataFrame, campaigns: DataFrame, campaign_start=None,
                  forecast_date=None, delivery_floor=None, valid_only: bool = True) -> tuple[DataFrame, DataFrame]:
    """Steps up to the campaign-tagged, week-aligned order lines.  Returns (orders, master)."""
    o = U.valid_orders(orders, delivery_floor) if valid_only else orders
    if forecast_date is not None:
        o = U.asof_orders(o, forecast_date)
    master = U.item_master(items)
    o = WK.orders_kgl(o, master)
    o = C.tag_campaigns(o, campaigns)
    o = WK.with_week(o, anchor_weekday(campaign_start))
    return o, master


def weekly_lines(orders: DataFrame, items: DataFrame, campaigns: DataFrame, campaign_start=None,
                 forecast_date=None, delivery_floor=None, unit: float | None = 1.0, materialize_fn=None) -> tuple[DataFrame, DataFrame]:
    """A1 straight from the order lines: (item-week rows, master).

    Lines are tagged and rolled up to (base item, week) before they meet the item master;
    the unit factor is positive, so the floored sum times the factor is the sum of the
    floored products.  Raw lines are shuffled once, already combined per task, and a hot
    item is a few rows by then.  ``unit``: the factor of items without a usable weight (None:
    their rows are rejects, see ``split_mapped``).  ``materialize_fn``: applied to the master, which
    is read by many steps and else made anew from all item versions by each."""
    o = U.valid_orders(orders, delivery_floor)
    if forecast_date is not None:
        o = U.asof_orders(o, forecast_date)
    o = WK.with_week(C.tag_campaigns(o, campaigns), anchor_weekday(campaign_start))
    master = U.item_master(items, unit)
    if materialize_fn is not None:
        master = materialize_fn(master)
    return WK.weekly_item_lines(o, master), master


def weekly_frames(tagged: DataFrame, intensity: str = "fractional") -> tuple[DataFrame, DataFrame]:
    """A1 + C1 and A2 (before gap filling)."""
    iw = WK.weekly_item_sales(tagged)
    cw = WK.weekly_cluster_sales(iw, intensity=intensity)
    return WK.add_competition(iw).drop("n_lines"), cw


def preprocess(orders: DataFrame, items: DataFrame, campaigns: DataFrame, horizon: int = 8,
               campaign_start=None, forecast_date=None, item_normalizers: DataFrame | None = None,
               cluster_normalizers: DataFrame | None = None, targets: DataFrame | None = None,
               intensity: str = "fractional", delivery_floor=None, materialize_as: str = "checkpoint",
               most_rejected: float = 0.0) -> Preprocessed:
    """Lineage cuts: the item master, after the weekly roll-ups (the order scan is done once), after
    the normalizers are attached (medians computed once), and after the
    campaign-items filter (the item frame every later step and model reads).  Order lines of
    items without a master row fail the job beyond the share ``most_rejected``; below, they
    are left out and returned as ``rejects``."""
    mat = lambda df: materialize(df, materialize_as)
    weekly, master = weekly_lines(orders, items, campaigns, campaign_start, forecast_date, delivery_floor, materialize_fn=mat)
    iw0, rejects = WK.split_mapped(weekly, mat, most_rejected)   # the only pass over the order lines
    cw = mat(WK.weekly_cluster_sales(iw0, intensity=intensity))
    iw = WK.add_competition(iw0).drop("n_lines")
    iw = WK.fill_missing_weeks(iw, "baseItemId")
    cw = WK.fill_missing_weeks(cw, "cluster1To1Id", int_flags=(intensity == "truncate"))
    iw = U.mark_last_campaign_week(WK.mark_post_campaign_weeks(iw, "baseItemId"))
    cw = WK.mark_post_campaign_weeks(cw, "cluster1To1Id")
    iw, inorm = FE.normalize(iw, "baseItemId", item_normalizers, materialize_fn=mat)
    cw, cnorm = FE.normalize(cw, "cluster1To1Id", cluster_normalizers, materialize_fn=mat)
    iw = U.campaign_items_only(iw, targets)
    iw = mat(iw.drop("salesQuantityKgL", "is_post_campaign"))
    cw = cw.drop("salesQuantityKgL", "is_post_campaign")   # already materialised with its normalizer
    iw = FE.add_category_lift_features(iw, master)
    iw = FE.add_time_features(iw)
    cw = FE.add_time_features(cw)
    iw = FE.add_lag_features(iw, "baseItemId", horizon)
    cw = FE.add_cluster_aliases(FE.add_lag_features(cw, "cluster1To1Id", horizon))
    iw = FE.add_cluster_context(iw, cw)
    cw = FE.add_cluster_metadata(cw, iw)
    return Preprocessed(iw, cw, master, inorm, cnorm, rejects)
