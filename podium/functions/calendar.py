"""Calendar buckets, labels and the reporting date.

Periods are represented by their first day (a DATE), so that a filter on a
period is a date range that prunes partitions and reaches the Parquet scan.
Weeks are ISO weeks (Monday first), as ``weekofyear``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from podium.functions.texts import (
    DATE_LONG,
    DATE_SHORT,
    MONTH_NAME,
    NON_SATURDAY,
    SATURDAY,
    WEEK_LABEL,
    WEEKDAY_LABELS,
    fill,
)
from podium.util import as_col

PERIODS = ("day", "week", "month", "year")


ZONE = "America/Chicago"


def as_of_default(zone: str = ZONE, now: dt.datetime | None = None) -> dt.date:
    """Today in the league's time zone (the reference date when none is given); ``now`` is an aware instant."""
    from zoneinfo import ZoneInfo

    return now.astimezone(ZoneInfo(zone)).date() if now else dt.datetime.now(ZoneInfo(zone)).date()


def day_in_zone(instant, zone: str = ZONE) -> Column:
    """The day it is in ``zone`` at a UTC instant."""
    return F.from_utc_timestamp(as_col(instant), zone).cast("date")


def period_col(date, period: str) -> Column:
    """First day of the day / ISO week / month / year holding ``date``."""
    d = as_col(date)
    if period == "day":
        return d
    if period == "week":
        return F.trunc(d, "week")
    if period == "month":
        return F.trunc(d, "month")
    if period == "year":
        return F.trunc(d, "year")
    raise ValueError(f"period must be one of {PERIODS}, got {period!r}")


def period_label(period_start, period: str) -> Column:
    """Title text of a period: ``Week 31``, ``July``, ``2000``, ``Wednesday, August 01``."""
    p = as_col(period_start)
    if period == "week":
        return fill(WEEK_LABEL, n=F.weekofyear(p))
    if period == "month":
        return month_text(p)
    if period == "year":
        return F.year(p).cast("string")
    if period == "day":
        return date_text_long(p)
    raise ValueError(f"period must be one of {PERIODS}, got {period!r}")


def period_range(as_of: dt.date, period: str, offset: int = 0) -> tuple[dt.date, dt.date]:
    """[start, end) of the period holding ``as_of``, shifted by ``offset`` periods.

    ``offset=-1`` is the previous period (last month, with January wrapping to
    December of the year before).
    """
    if period == "day":
        start = as_of + dt.timedelta(days=offset)
        return start, start + dt.timedelta(days=1)
    if period == "week":
        start = as_of - dt.timedelta(days=as_of.weekday()) + dt.timedelta(weeks=offset)
        return start, start + dt.timedelta(weeks=1)
    if period == "month":
        idx = as_of.year * 12 + (as_of.month - 1) + offset
        start = dt.date(idx // 12, idx % 12 + 1, 1)
        nxt = idx + 1
        return start, dt.date(nxt // 12, nxt % 12 + 1, 1)
    if period == "year":
        y = as_of.year + offset
        return dt.date(y, 1, 1), dt.date(y + 1, 1, 1)
    raise ValueError(f"period must be one of {PERIODS}, got {period!r}")


def in_period(date, as_of: dt.date, period: str, offset: int = 0) -> Column:
    start, end = period_range(as_of, period, offset)
    d = as_col(date)
    return (d >= F.lit(start)) & (d < F.lit(end))


def month_text(date) -> Column:
    return F.date_format(as_col(date), MONTH_NAME)


def date_text_short(date) -> Column:
    """``Sat, Aug 02``."""
    return F.date_format(as_col(date), DATE_SHORT)


def date_text_long(date) -> Column:
    """``Saturday, August 02``."""
    return F.date_format(as_col(date), DATE_LONG)


def weekday_label(date) -> Column:
    dow = F.dayofweek(as_col(date))
    expr = F.lit(None).cast("string")
    for i, label in reversed(list(enumerate(WEEKDAY_LABELS, start=1))):
        expr = F.when(dow == i, F.lit(label)).otherwise(expr)
    return expr


def weekday_order(date) -> Column:
    """Display position, Monday = 1 … Sunday = 7."""
    return (F.pmod(F.dayofweek(as_col(date)) + F.lit(5), F.lit(7)) + F.lit(1)).cast("int")


def saturday_check(date) -> Column:
    return F.when(F.dayofweek(as_col(date)) == 7, F.lit(SATURDAY)).otherwise(F.lit(NON_SATURDAY))
