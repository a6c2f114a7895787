"""Finish times: ``m:ss`` text <-> whole seconds.

Times are stored as text with unbounded minutes (``75:10`` is 75 minutes) and
compared as integer seconds.  Every helper is null-in, null-out and never
raises on bad text (ANSI mode stays on).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from podium.functions.texts import TIME_FORMAT, TIME_FORMAT_UNPADDED
from podium.util import as_col

_TIME_RE = r"^[0-9]+:[0-9]+$"


def repair_time(time) -> Column:
    """``:45`` -> ``0:45``; every other value unchanged."""
    t = as_col(time)
    return F.when(t.startswith(":"), F.concat(F.lit("0"), t)).otherwise(t)


def parse_time(time) -> Column:
    """``m:ss`` text -> total seconds (int); null for unparseable text.

    ``1:5`` and ``1:05`` are both 65; ``1:75`` is 135.  Text that is not two
    digit groups around one colon (``105``, ``x:05``, empty, ``:45`` before
    repair) gives null, as does overflow.
    """
    t = F.trim(as_col(time))
    parts = F.split(t, ":")
    mins = F.get(parts, 0).try_cast("int")
    secs = F.get(parts, 1).try_cast("int")
    total = F.try_add(F.try_multiply(mins, F.lit(60)), secs)
    return F.when(t.rlike(_TIME_RE), total).cast("int")


def format_secs(secs) -> Column:
    """Seconds -> ``m:ss`` (minutes unbounded, seconds zero-padded)."""
    s = as_col(secs)
    return F.when(
        s.isNotNull(),
        F.format_string(TIME_FORMAT, F.floor(s / F.lit(60)), F.pmod(s, F.lit(60))),
    )


def format_secs_unpadded(secs) -> Column:
    """Seconds -> ``m:s`` without padding (``1:5``), the silent updater's form."""
    s = as_col(secs)
    return F.when(
        s.isNotNull(),
        F.format_string(TIME_FORMAT_UNPADDED, F.floor(s / F.lit(60)), F.pmod(s, F.lit(60))),
    )


def minutes(secs) -> Column:
    """Seconds as fractional minutes (double; never a decimal literal)."""
    return as_col(secs) / F.lit(60).cast("double")
