"""Exact medians and the orderings and plot tables built on them.

``median`` is Spark's exact percentile, whose buffer is a value -> count map
that is merged map-side; whole seconds keep that map small even for a player
with a third of all rows.  Medians are taken over integer seconds and divided
afterwards, so minutes come out as exact halves / 60.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from podium.functions.calendar import period_col, saturday_check, weekday_label, weekday_order
from podium.functions.texts import MEDIAN_LINE, fill
from podium.functions.timefmt import format_secs, minutes
from podium.operators.ranking import ranked_position
from podium.util import keys


def _in_periods(results: DataFrame, period: str) -> DataFrame:
    return results.where(F.col("secs").isNotNull()).withColumn("period_start", period_col("date", period))


def median_times(results: DataFrame, by: Sequence[str] | None = None, period: str = "month", checked: bool = False) -> DataFrame:
    """Median seconds per player and period, rounded half to even, as ``m:ss`` too; ``checked`` as in :func:`ranked_position`."""
    grp = keys(by, "period_start")
    med = _in_periods(results, period).groupBy(*grp, "name").agg(F.median("secs").alias("m"))
    return median_list(med, by, checked)


def median_list(med: DataFrame, by: Sequence[str] | None = None, checked: bool = False) -> DataFrame:
    """The ordered list of medians ``(by…, period_start, name, m)``."""
    grp = keys(by, "period_start")
    rounded = F.bround(F.col("m"), 0).cast("bigint")
    out = med.select(*grp, "name", rounded.alias("median_secs"))
    out = ranked_position(out, grp, "median_secs", "name", checked=checked)
    return out.select(
        *grp, "name", "median_secs", format_secs("median_secs").alias("median_time"), "pos"
    ).withColumn("line", fill(MEDIAN_LINE, name="name", time="median_time"))


def weekday_medians(results: DataFrame, by: Sequence[str] | None = None, period: str = "year") -> DataFrame:
    """Median minutes per player, period and weekday (``Su``=1 … ``Sa``=7; display order Monday first)."""
    r = _in_periods(results, period).select(
        *keys(by, "period_start", "name"),
        F.dayofweek("date").alias("dow"),
        weekday_label("date").alias("weekday"),
        weekday_order("date").alias("weekday_order"),
        "secs",
    )
    med = r.groupBy(*keys(by, "period_start", "name", "dow", "weekday", "weekday_order")).agg(F.median("secs").alias("m"))
    return med.select(*keys(by, "period_start", "name", "dow", "weekday", "weekday_order"), minutes("m").alias("median_minutes"))


def name_order(results: DataFrame, by: Sequence[str] | None = None, period: str = "month") -> DataFrame:
    """Plot order of players: position 1 = slowest median (the bottom row), ties by name descending."""
    grp = keys(by, "period_start")
    med = _in_periods(results, period).groupBy(*grp, "name").agg(F.median("secs").alias("median_secs"))
    return ranked_position(med, grp, "median_secs", "name", descending=True, out="name_order")


def time_points(results: DataFrame, by: Sequence[str] | None = None, period: str = "month") -> DataFrame:
    """One point per result: player order, minutes and the Saturday flag (the table behind the strip plot)."""
    grp = keys(by, "period_start")
    order = name_order(results, by, period).select(*grp, "name", "name_order")
    pts = _in_periods(results, period).select(
        *grp, "name", "date", minutes("secs").alias("minutes"), saturday_check("date").alias("saturday_check")
    )
    return pts.join(order, [*grp, "name"], "left")


def minutes_extent(results: DataFrame, by: Sequence[str] | None = None, period: str = "month") -> DataFrame:
    grp = keys(by, "period_start")
    m = _in_periods(results, period).withColumn("minutes", minutes("secs"))
    return m.groupBy(*grp).agg(F.min("minutes").alias("min_minutes"), F.max("minutes").alias("max_minutes"))


def saturday_split(results: DataFrame, by: Sequence[str] | None = None) -> DataFrame:
    """Each result with its minutes, weekday number and Saturday / Non-Saturday flag."""
    return results.select(
        *keys(by, "name", "date"),
        minutes("secs").alias("minutes"),
        F.dayofweek("date").alias("weekday"),
        saturday_check("date").alias("saturday_check"),
    )
