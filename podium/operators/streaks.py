"""Winning streaks: consecutive days a player ranked first.

Gaps and islands over winners only (a small table: at most the days × leagues,
plus ties).  ``date - dense_rank`` is constant along a run of consecutive days;
the streak is the position inside that run.  Both windows partition by
``(by…, name)``, so the chain costs one shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from podium.functions.calendar import date_text_short, period_col
from podium.functions.texts import STREAK_LINE, STREAK_SHOWN_FROM, fill
from podium.operators.ranking import ranked_position, winners
from podium.util import keys, null_safe_join


def streaks(results: DataFrame, by: Sequence[str] | None = None) -> DataFrame:
    """``(by…, name, date, streak)`` for every day a player won; ``streak`` counts that day."""
    won = winners(results, by).select(*keys(by, "name", "date"))
    player = keys(by, "name")
    island = F.date_sub(F.col("date"), F.dense_rank().over(Window.partitionBy(*player).orderBy("date")))
    runs = won.withColumn("island", island)
    streak = F.dense_rank().over(Window.partitionBy(*player, "island").orderBy("date"))
    return runs.select(*keys(by, "name", "date"), streak.cast("bigint").alias("streak"))


def extend_streaks(day_results: DataFrame, previous: DataFrame, by: Sequence[str] | None = None) -> DataFrame:
    """Streak rows of one day from that day's results and the streak rows of the day before.

    A winner continues yesterday's streak (+1) or starts at 1 — the same
    arithmetic as :func:`streaks`, one day at a time, reading two days only.
    """
    won = winners(day_results, by).select(*keys(by, "name", "date"))
    prev = previous.select(*keys(by, "name"), F.date_add(F.col("date"), 1).alias("date"), F.col("streak").alias("prev"))
    j = null_safe_join(won, prev, keys(by, "name", "date"), "left")
    return j.select(*keys(by, "name", "date"), (F.coalesce(F.col("prev"), F.lit(0)) + 1).cast("bigint").alias("streak"))


def streaks_from(results: DataFrame, carried: DataFrame, from_day, by: Sequence[str] | None = None) -> DataFrame:
    """Streak rows for days ``>= from_day`` from those days' results and the streaks running on ``from_day - 1``.

    Runs of consecutive wins are found among the recomputed days only; a run
    that starts exactly on ``from_day`` continues the carried streak.  Used to
    redo the days after late results without reading earlier history.
    """
    won = winners(results.where(F.col("date") >= F.lit(from_day)), by).select(*keys(by, "name", "date"))
    player = keys(by, "name")
    island = F.date_sub(F.col("date"), F.dense_rank().over(Window.partitionBy(*player).orderBy("date")))
    k = F.dense_rank().over(Window.partitionBy(*player, "island").orderBy("date"))
    runs = won.withColumn("island", island).withColumn("k", k)
    runs = runs.withColumn("starts_at_from", F.date_sub(F.col("date"), F.col("k") - 1) == F.lit(from_day))
    carry = carried.select(*player, F.col("streak").alias("carry"))
    j = null_safe_join(runs, carry, player, "left")
    bonus = F.when(F.col("starts_at_from"), F.coalesce(F.col("carry"), F.lit(0))).otherwise(F.lit(0))
    return j.select(*keys(by, "name", "date"), (F.col("k") + bonus).cast("bigint").alias("streak"))


def results_with_streaks(results: DataFrame, by: Sequence[str] | None = None, streak_table: DataFrame | None = None) -> DataFrame:
    """Results with the streak of each winning row (null on rows that did not win)."""
    s = streak_table if streak_table is not None else streaks(results, by)
    return null_safe_join(results, s, keys(by, "name", "date"), "left")


def longest_streak(
    results: DataFrame,
    by: Sequence[str] | None = None,
    period: str = "month",
    min_streak: int = STREAK_SHOWN_FROM,
    streak_table: DataFrame | None = None,
) -> DataFrame:
    """Per period, the highest streak reached on a day inside it (history before the period counts).

    Ties are all kept; periods whose best is below ``min_streak`` have no row.
    """
    s = streak_table if streak_table is not None else streaks(results, by)
    s = s.withColumn("period_start", period_col("date", period))
    grp = keys(by, "period_start")
    # a grouped max (combined map-side), then the ties' positions: no window over a whole period
    best = s.groupBy(*grp).agg(F.max("streak").alias("streak")).where(F.col("streak") >= min_streak)
    top = null_safe_join(s, best, [*grp, "streak"], "left_semi")
    line = fill(STREAK_LINE, name="name", streak="streak", day=date_text_short("date"))
    return ranked_position(top, grp, "date", "name").select(*grp, "name", "streak", "date", line.alias("line"), "pos")


def first_winner(results: DataFrame, by: Sequence[str] | None = None, streak_table: DataFrame | None = None) -> DataFrame:
    """Each day's first winner (by name among tied winners) and that row's streak.

    A grouped ``min_by`` over the streak table: combined map-side.
    """
    s = streak_table if streak_table is not None else streaks(results, by)
    first = s.groupBy(*keys(by, "date")).agg(F.min_by(F.struct("name", "streak"), F.col("name")).alias("f"))
    return first.select(*keys(by, "date"), F.col("f.name").alias("name"), F.col("f.streak").alias("streak"))


def broken_streaks(results: DataFrame, by: Sequence[str] | None = None, streak_table: DataFrame | None = None) -> DataFrame:
    """Days on which yesterday's first winner had a longer streak than today's first winner.

    ``(by…, date, name, broken_streak)``: ``name`` is yesterday's first winner.
    No row when either day has no results.
    """
    first = first_winner(results, by, streak_table)
    today = first.select(*keys(by, "date"), F.col("streak").alias("t_streak"))
    yesterday = first.select(
        *keys(by),
        F.date_add(F.col("date"), 1).alias("date"),
        F.col("name"),
        F.col("streak").alias("broken_streak"),
    )
    j = null_safe_join(today, yesterday, keys(by, "date"), "inner")
    return j.where(F.col("broken_streak") > F.col("t_streak")).select(*keys(by, "date", "name"), "broken_streak")
