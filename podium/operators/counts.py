"""Counts of times and ranks that add up: a period's reports from its days' or months' counts.

A day's state is its canonical rows with their ranks.  From it come counts
``(by…, period_start, name, kind, dow, value, n)``: how often a player had a
time (``kind`` ``time``, per weekday) or a rank (``rank``, no weekday).  Counts
of disjoint days add up to those of their union and can be taken back, so a day
that was polled again changes its month by the difference (:func:`merged`).
Medians, wins, medals and rank distributions are read off counts alone and equal
those of the rows.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from podium.functions.calendar import period_col, weekday_label, weekday_order
from podium.functions.timefmt import minutes
from podium.operators import medians, ranking
from podium.util import keys

TIME, RANK = "time", "rank"
#: a Sunday, the first day of the week as ``dow`` counts
_SUNDAY = dt.date(2023, 12, 31)


def day_state(results: DataFrame, by: Sequence[str] | None = None) -> DataFrame:
    """Canonical rows -> ``(by…, name, secs, rnk, date)``."""
    return ranking.day_rank(results, by).select(*keys(by, "name"), "secs", "rnk", "date")


def period_counts(days: DataFrame, by: Sequence[str] | None = None, period: str = "month") -> DataFrame:
    """Counts per period of the days' states."""
    none = F.lit(None).cast("int")
    time = F.struct(F.lit(TIME).alias("kind"), F.dayofweek("date").alias("dow"), F.col("secs").cast("bigint").alias("value"))
    rank = F.struct(F.lit(RANK).alias("kind"), none.alias("dow"), F.col("rnk").cast("bigint").alias("value"))
    e = days.select(*keys(by), period_col("date", period).alias("period_start"), "name", F.explode(F.array(time, rank)).alias("e"))
    grp = keys(by, "period_start", "name", "kind", "dow", "value")
    return e.select(*keys(by, "period_start", "name"), "e.*").groupBy(*grp).agg(F.count(F.lit(1)).alias("n"))


def merged(counts: DataFrame, added: DataFrame, removed: DataFrame, by: Sequence[str] | None = None) -> DataFrame:
    """``counts`` with some added and some taken back; values that are left with none go."""
    less = removed.withColumn("n", -F.col("n"))
    grp = keys(by, "period_start", "name", "kind", "dow", "value")
    total = counts.unionByName(added).unionByName(less).groupBy(*grp).agg(F.sum("n").alias("n"))
    return total.where(F.col("n") != 0)


def rolled_up(counts: DataFrame, period: str) -> DataFrame:
    """Counts of months as those of the periods that hold them: unchanged rows, to be added up by whoever reads them."""
    if period not in ("month", "year"):
        raise ValueError(f"months make up a month or a year, not a {period}")
    return counts.withColumn("period_start", period_col("period_start", period))


def _of(counts: DataFrame, kind: str) -> DataFrame:
    return counts.where(F.col("kind") == kind)


def median_times(counts: DataFrame, by: Sequence[str] | None = None, checked: bool = False) -> DataFrame:
    """:func:`podium.operators.medians.median_times` of the counts' periods."""
    med = _of(counts, TIME).groupBy(*keys(by, "period_start", "name")).agg(F.expr("percentile(value, 0.5, n)").alias("m"))
    return medians.median_list(med, by, checked)


def weekday_medians(counts: DataFrame, by: Sequence[str] | None = None) -> DataFrame:
    """:func:`podium.operators.medians.weekday_medians` of the counts' periods."""
    med = _of(counts, TIME).groupBy(*keys(by, "period_start", "name", "dow")).agg(F.expr("percentile(value, 0.5, n)").alias("m"))
    day = F.date_add(F.lit(_SUNDAY), F.col("dow") - 1)
    return med.select(
        *keys(by, "period_start", "name", "dow"),
        weekday_label(day).alias("weekday"),
        weekday_order(day).alias("weekday_order"),
        minutes("m").alias("median_minutes"),
    )


def period_wins(counts: DataFrame, by: Sequence[str] | None = None, checked: bool = False) -> DataFrame:
    """:func:`podium.operators.ranking.period_wins` of the counts' periods."""
    won = _of(counts, RANK).where(F.col("value") == 1)
    return ranking.win_list(won.groupBy(*keys(by, "period_start", "name")).agg(F.sum("n").alias("n")), by, checked)


def medal_table(counts: DataFrame, by: Sequence[str] | None = None, checked: bool = False) -> DataFrame:
    """:func:`podium.operators.ranking.medal_table` of the counts' periods."""
    top = _of(counts, RANK).where(F.col("value") <= 3).select(*keys(by, "period_start", "name"), F.col("value").alias("rnk"), "n")
    return ranking.medal_list(top, by, checked)


def rank_distribution(counts: DataFrame, by: Sequence[str] | None = None) -> DataFrame:
    """:func:`podium.operators.ranking.rank_distribution` of the counts' periods."""
    r = _of(counts, RANK).select(*keys(by, "period_start", "name"), F.col("value").alias("rnk"), "n")
    return r.groupBy(*keys(by, "period_start", "name", "rnk")).agg(F.sum("n").alias("n"))
