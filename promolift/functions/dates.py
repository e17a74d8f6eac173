"""Date and calendar expressions (all built-in, codegen friendly).

``weekday`` is 0 = Monday .. 6 = Sunday, as in Python's ``date.weekday()``.
"""

from __future__ import annotations

import datetime as _dt
import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_date(value) -> _dt.date:
    if isinstance(value, _dt.datetime):
        return value.date()
    if isinstance(value, _dt.date):
        return value
    return _dt.date.fromisoformat(str(value)[:10])


def lit_date(value) -> Column:
    return F.lit(as_date(value).isoformat()).cast("date")


def week_start(d: Column, anchor_weekday: int = 0) -> Column:
    """Start of the week containing ``d`` when weeks begin on ``anchor_weekday``."""
    return F.date_sub(d, F.pmod(F.weekday(d) - F.lit(anchor_weekday), F.lit(7)).cast("int"))


def anchor_weekday(campaign_start=None) -> int:
    """Weekday weeks are aligned to: the campaign's start weekday, Monday if none."""
    return 0 if campaign_start is None else as_date(campaign_start).weekday()


def last_complete_week(forecast_date, campaign_start) -> _dt.date:
    """Start of the last complete campaign-aligned week before ``forecast_date``."""
    f = as_date(forecast_date)
    back = ((f.weekday() - as_date(campaign_start).weekday()) % 7) + 7
    return f - _dt.timedelta(days=back)


def horizon_weeks(forecast_date, campaign_start) -> int:
    """Whole weeks between forecast date and campaign start."""
    return int((as_date(campaign_start) - as_date(forecast_date)).days / 7)


def campaign_end(campaign_start) -> _dt.date:
    """A campaign lasts three weeks: end = start + 20 days."""
    return as_date(campaign_start) + _dt.timedelta(days=20)


def campaign_week_number(d: Column, start: Column, end: Column) -> Column:
    """T4: 1-based week of the campaign containing ``d``; 0 when outside it."""
    inside = (d >= start) & (d <= end)
    return F.when(inside, F.floor(F.datediff(d, start) / 7) + 1).otherwise(F.lit(0)).cast("int")


def time_features(week: Column) -> list[Column]:
    """ISO week, calendar year and the week-of-year cycle."""
    w = F.weekofyear(week)
    return [
        w.alias("week_of_year"),
        F.year(week).alias("year"),
        F.sin(F.lit(2 * math.pi) * w / 52).alias("week_of_year_sin"),
        F.cos(F.lit(2 * math.pi) * w / 52).alias("week_of_year_cos"),
    ]


def month_features(d: Column) -> list[Column]:
    """Month / week / year plus month cycle (older generations)."""
    m = F.month(d)
    return [
        F.weekofyear(d).alias("week"), m.alias("month"), F.year(d).alias("year"),
        F.sin(F.lit(2 * math.pi) * m / 12).alias("month_sin"),
        F.cos(F.lit(2 * math.pi) * m / 12).alias("month_cos"),
    ]
