"""Query registry shared by the query modules, the output finaliser and the loaders
that build the standard scenario's intermediate frames."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import features as FE
from ..operators import universe as U
from ..operators import weekly as WK
from ..sources import fixtures as FX
from . import params as P
from .preprocess import preprocess, tagged_orders, weekly_lines

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return deco


def finalize(df: DataFrame) -> DataFrame:
    """Uniform output types: integers -> bigint, booleans -> bigint, floating point ->
    double rounded to 4 places (round(x * 1e4 * (1 + 1e-11)) / 1e4, -0.0 -> 0.0; the
    same expression as the oracle's, see ``oracle.r``)."""
    cols = []
    for f in df.schema.fields:
        t = f.dataType
        c = F.col(f"`{f.name}`")
        if isinstance(t, (T.DoubleType, T.FloatType, T.DecimalType)):
            c = F.round(c.cast("double") * F.lit(10000.0) * F.lit(1.00000000001)) / F.lit(10000.0) + F.lit(0.0)
        elif isinstance(t, (T.IntegerType, T.LongType, T.ShortType, T.ByteType, T.BooleanType)):
            c = c.cast("long")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def _inputs(spark, sf, wide=False):
    """The three inputs; ``wide``: every part is a base item of its own."""
    return FX.load_inputs(spark, sf, wide)


def _tagged(spark, sf, forecast_date=None):
    inp = _inputs(spark, sf)
    return tagged_orders(inp.orders, inp.items, inp.campaigns, P.CAMPAIGN_START, forecast_date)


def _weekly(spark, sf, wide=False):
    """A1 materialised once (the only pass over the order lines), then A2 and C1 from it."""
    from ..session import cut_lineage
    inp = _inputs(spark, sf, wide)
    rows, _ = weekly_lines(inp.orders, inp.items, inp.campaigns, P.CAMPAIGN_START)
    iw0 = WK.require_mapped(rows, lambda d: cut_lineage(d, "item-weekly"))
    cw = WK.weekly_cluster_sales(iw0)
    return WK.add_competition(iw0).drop("n_lines"), cw


def _pre(spark, sf, **kw):
    inp = _inputs(spark, sf)
    kw.setdefault("campaign_start", P.CAMPAIGN_START)
    kw.setdefault("horizon", P.HORIZON)
    return preprocess(inp.orders, inp.items, inp.campaigns, **kw)


def _gap_filled_items(spark, sf, wide=False):
    iw, _ = _weekly(spark, sf, wide)
    return WK.fill_missing_weeks(iw, "baseItemId")


def _normalized_items(spark, sf, wide=False):
    return _normalized(WK.mark_post_campaign_weeks(_gap_filled_items(spark, sf, wide), "baseItemId"))


def _normalized(g):
    from ..session import cut_lineage
    return FE.normalize(g, "baseItemId", materialize_fn=lambda d: cut_lineage(d, "items-normalizer"))


def _filtered_items(spark, sf, wide=False):
    """Normalised, campaign-items-only frame, materialised once (as preprocess does)."""
    from ..session import cut_lineage
    g = WK.mark_post_campaign_weeks(_gap_filled_items(spark, sf, wide), "baseItemId")
    n, _ = _normalized(U.mark_last_campaign_week(g))
    return cut_lineage(U.campaign_items_only(n), "items-filtered")


