"""Reports: standings tables and the message text built from them.

Tables are unbounded and stay distributed.  Text is assembled per message
*part*: each section of a message (wins, fastest, medians, longest streak,
daily standings) is cut into pages of at most ``page_size`` lines, and one row
is produced per ``(by…, period, message, seq, page)``.  Concatenating the parts
of a message in ``(seq, page)`` order gives the whole message text — a sink
sends them in that order; no group ever concatenates more than ``page_size``
lines.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from podium.functions import texts as tx
from podium.functions.calendar import date_text_long, period_col, period_label
from podium.functions.texts import fill
from podium.operators import counts, medians, ranking
from podium.operators import streaks as st
from podium.util import checked_broadcast, keys, null_safe_join, partition_keys

PAGE_SIZE = 50


# -- filters -----------------------------------------------------------------


def lookback(results: DataFrame, as_of: dt.date, days: int = 90) -> DataFrame:
    """Rows strictly inside the last ``days`` days before ``as_of`` (``date > as_of - days``)."""
    return results.where(F.col("date") > F.lit(as_of - dt.timedelta(days=days)))


def publish_guard(results: DataFrame, by: Sequence[str] | None = None, period: str = "month") -> DataFrame:
    """Periods that have results (only these get a message), with row count and newest day."""
    p = results.withColumn("period_start", period_col("date", period))
    return p.groupBy(*keys(by, "period_start")).agg(
        F.count(F.lit(1)).alias("rows"), F.max("date").alias("latest_date")
    )


# -- daily -------------------------------------------------------------------


def _medal(rnk: Column, marks: dict[int, str], default) -> Column:
    expr = default
    for k in sorted(marks, reverse=True):
        expr = F.when(rnk == k, F.lit(marks[k])).otherwise(expr)
    return expr


def _day_extras(results: DataFrame, by, streak_table: DataFrame | None) -> DataFrame:
    """Streak of each winner and the broken streak of yesterday's first winner, keyed ``(by…, date, name)``.

    Both are small (a few rows per league and day).  They are stacked and
    collapsed with a grouped ``max`` (combined map-side, no join), then meet
    the results in a single join.
    """
    s = streak_table if streak_table is not None else st.streaks(results, by)
    broken = st.broken_streaks(results, by, s)
    k = keys(by, "date", "name")
    stacked = s.select(*k, "streak", F.lit(None).cast("bigint").alias("broken_streak")).unionByName(
        broken.select(*k, F.lit(None).cast("bigint").alias("streak"), "broken_streak")
    )
    return stacked.groupBy(*k).agg(F.max("streak").alias("streak"), F.max("broken_streak").alias("broken_streak"))


def _tie_window(df: DataFrame, by) -> Window:
    """Order among equal times of a day, by name.  Keyed like the rank join, so it reuses that shuffle."""
    part = partition_keys(df, keys(by, "date", "secs"), plain=ranking.RANK_PLAIN_KEYS)
    return Window.partitionBy(*part).orderBy(F.col("name").asc_nulls_last())


def _ranked_day(results: DataFrame, by, streak_table: DataFrame | None, checked: bool = False) -> DataFrame:
    """Ranked results with a unique line position and the day extras.

    ``pos = rank + place among equal times by name``: the window covers one
    (day, time) and is keyed like the rank join, so it runs on the rank join's
    partitioning before the extras join re-keys the rows by name.
    """
    r = ranking.day_rank(results, by, checked=checked)
    r = r.withColumn("pos", (F.col("rnk") + F.row_number().over(_tie_window(r, by)) - 1).cast("bigint"))
    extras = _day_extras(results, by, streak_table)
    if checked:
        extras = checked_broadcast(extras)
    return null_safe_join(r, extras, keys(by, "date", "name"), "left")


def _standings(results: DataFrame, by, streak_table: DataFrame | None, checked: bool = False) -> DataFrame:
    x = _ranked_day(results, by, streak_table, checked)
    shown = tx.STREAK_SHOWN_FROM
    streak_text = F.when(
        (F.col("rnk") == 1) & (F.col("streak") >= shown), fill(tx.STREAK_NOTE, n="streak")
    ).otherwise(F.lit(""))
    broken_text = F.when(F.col("broken_streak") >= shown, fill(tx.BROKEN_NOTE, n="broken_streak")).otherwise(F.lit(""))
    medal = _medal(F.col("rnk"), tx.MEDALS, F.lit(""))
    line = fill(
        tx.DAILY_LINE,
        name=F.coalesce(F.col("name"), F.lit(tx.MISSING)),
        time=F.coalesce(F.col("time"), F.lit(tx.MISSING)),
        medal="medal",
        streak_note="streak_text",
        broken_note="broken_text",
    )
    return (
        x.select(
            *keys(by, "date", "name"),
            "time",
            "secs",
            "rnk",
            "pos",
            "streak",
            "broken_streak",
            medal.alias("medal"),
            streak_text.alias("streak_text"),
            broken_text.alias("broken_text"),
        )
        .withColumn("line", line)
    )


def daily_standings(
    results: DataFrame, by: Sequence[str] | None = None, streak_table: DataFrame | None = None, checked: bool = False
) -> DataFrame:
    """One line per player and day: ``name: time medal (N-day streak)(N-day streak broken)``.

    Lines of a day are ordered by ``(secs, name)``; ``rnk`` is the competition rank.
    ``checked=True`` measures the two small sides (rank histogram, day extras)
    and broadcasts each only if it fits (:func:`podium.util.checked_broadcast`),
    so the results need not be shuffled for them.
    """
    return _standings(results, by, streak_table, checked).drop("pos")


def daily_plot_data(
    results: DataFrame, by: Sequence[str] | None = None, streak_table: DataFrame | None = None, checked: bool = False
) -> DataFrame:
    """The table behind the daily lollipop chart; ``name_order`` 1 is the slowest (bottom).

    ``name_order = players - (rank + earlier names at the same time) + 1``; the
    tie position is a window over ``(by…, date, secs)``, so a busy day is spread
    over its distinct times rather than sorted in one task.
    """
    x = _ranked_day(results, by, streak_table, checked)
    # players of a day from its histogram of times, joined back on (day, time) as the ranks are
    day = keys(by, "date")
    hist = results.groupBy(*day, "secs").agg(F.count(F.lit(1)).alias("n"))
    players = F.sum("n").over(Window.partitionBy(*day)).alias("players")
    x = null_safe_join(x, hist.select(*day, "secs", players), [*day, "secs"], "left")
    streak_text = F.when((F.col("rnk") == 1) & (F.col("streak") >= tx.STREAK_SHOWN_FROM), fill(tx.PLOT_STREAK_NOTE, n="streak"))
    return x.select(
        *keys(by, "date", "name"),
        (F.col("players") - F.col("pos") + 1).cast("bigint").alias("name_order"),
        "secs",
        "time",
        _medal(F.col("rnk"), tx.PLOT_MEDALS, F.lit("")).alias("medal"),
        streak_text.alias("streak_text"),
    )


def text_bar(results: DataFrame, by: Sequence[str] | None = None) -> DataFrame:
    """A 0-7 cell bar per result, relative to the day's slowest time, padded to 8 cells."""
    # a bar depends on the day and the time alone, so it is worked out once per (day, time) and
    # joined back on both: a busy day is spread over its distinct times
    day = keys(by, "date")
    times = results.select(*day, "secs").where(F.col("secs").isNotNull()).distinct()
    x = null_safe_join(times, ranking.day_max(times, by), day, "left")
    scale = F.lit(tx.BAR_SCALE).cast("double")
    relative = F.floor(F.try_divide(scale, F.col("max_secs").cast("double")) * F.col("secs").cast("double")).cast("int")
    x = null_safe_join(results, x.select(*day, "secs", relative.alias("relative")), [*day, "secs"], "left", plain=("date", "secs"))
    bar = F.concat(F.repeat(F.lit(tx.BAR_CELL), F.col("relative")), F.repeat(F.lit(tx.BAR_BLANK), F.lit(tx.BAR_WIDTH) - F.col("relative")))
    return x.select(*keys(by, "date", "name"), "secs", "relative", bar.alias("bar"))


# -- message parts -------------------------------------------------------------


def _parts(periods: DataFrame, grp: list[str], sections: list[tuple], lines: DataFrame, page_size: int) -> DataFrame:
    """Assemble message parts in one aggregation.

    ``sections``: ``(message, seq, section, header_column, header_when_empty)``.
    Every period contributes an empty marker line (``pos = 0``) to each
    section, so a section without lines still yields its page 0 (its
    separator and, when ``header_when_empty``, its header), as the message
    always has it; the markers ride in the same ``groupBy`` as the lines, so
    no join of headers to pages is needed.
    """
    names = [s for _, _, s, _, _ in sections]
    markers = periods.select(*grp, F.explode(F.array(*[F.lit(n) for n in names])).alias("section")).select(
        *grp,
        "section",
        F.lit(0).cast("bigint").alias("pos"),
        F.lit(None).cast("bigint").alias("o1"),
        F.lit(None).cast("string").alias("o2"),
        F.lit("").alias("line"),
    )
    page = F.when(F.col("pos") > 0, F.floor((F.col("pos") - 1) / F.lit(page_size))).otherwise(F.lit(0)).cast("bigint")
    pages = (
        lines.select(*grp, "section", F.col("pos").cast("bigint").alias("pos"), "o1", "o2", "line")
        .unionByName(markers)
        .withColumn("page", page)
        .groupBy(*grp, "section", "page")
        .agg(
            F.expr("listagg(line, '') WITHIN GROUP (ORDER BY pos, o1, o2)").alias("body"),
            F.max("pos").alias("last_pos"),
        )
    )

    def by_section(i: int, default):
        expr = default
        for spec in sections:
            expr = F.when(F.col("section") == spec[2], spec[i]).otherwise(expr)
        return expr

    message = by_section(0, F.lit(None).cast("int"))
    seq = by_section(1, F.lit(None).cast("int"))
    header = by_section(3, F.lit(None).cast("string"))
    always = by_section(4, F.lit(None).cast("boolean"))
    first = F.col("page") == 0
    sep = F.when(first & (F.col("seq") > 1), F.lit(tx.SECTION_SEPARATOR)).otherwise(F.lit(""))
    head = F.when(first & ((F.col("last_pos") > 0) | always), header).otherwise(F.lit(""))
    return (
        pages.withColumn("seq", seq)
        .select(*grp, message.alias("message"), "seq", "section", "page", F.concat(sep, head, F.col("body")).alias("text"))
    )


def _lines(df: DataFrame, grp: list[str], section: str, pos: str = "pos", o1: str | None = None, o2: str | None = None) -> DataFrame:
    """Section lines with their order key ``(pos, o1, o2)``; ``o1`` / ``o2`` break ties in ``pos``."""
    t1 = F.col(o1).cast("bigint") if o1 else F.lit(None).cast("bigint")
    t2 = F.col(o2).cast("string") if o2 else F.lit(None).cast("string")
    return df.select(*grp, F.lit(section).alias("section"), F.col(pos).alias("pos"), t1.alias("o1"), t2.alias("o2"), "line")


def daily_message(
    results: DataFrame,
    by: Sequence[str] | None = None,
    page_size: int = PAGE_SIZE,
    streak_table: DataFrame | None = None,
    checked: bool = False,
) -> DataFrame:
    """``*Weekday, Month dd*`` and one standings line per player, per day (unique line positions)."""
    grp = keys(by, "date")
    s = _standings(results, by, streak_table, checked)
    days = results.select(*grp).distinct()
    sections = [(1, 1, "standings", fill(tx.DAILY_HEADER, day=date_text_long("date")), True)]
    return _parts(days, grp, sections, _lines(s, grp, "standings"), page_size)


def weekly_message(
    results: DataFrame, by: Sequence[str] | None = None, page_size: int = PAGE_SIZE, checked: bool = False, period_counts: DataFrame | None = None
) -> DataFrame:
    """``*Week N wins*`` and the medal table, per ISO week; ``checked`` as in :func:`podium.operators.ranking.ranked_position`.

    ``period_counts`` (:mod:`podium.operators.counts`) of the weeks spare the ranking of their days.
    """
    grp = keys(by, "period_start")
    table = ranking.medal_table(results, by, "week", checked) if period_counts is None else counts.medal_table(period_counts, by, checked)
    lines = table.withColumn("line", fill(tx.MEDAL_LINE, name="name", placements="placements"))
    weeks = results.select(*keys(by), period_col("date", "week").alias("period_start")).distinct()
    head = fill(tx.WEEK_HEADER, label=period_label("period_start", "week"))
    return _parts(weeks, grp, [(1, 1, "wins", head, True)], _lines(lines, grp, "wins"), page_size)


def period_message(
    results: DataFrame,
    by: Sequence[str] | None = None,
    period: str = "month",
    page_size: int = PAGE_SIZE,
    streak_table: DataFrame | None = None,
    checked: bool = False,
    period_counts: DataFrame | None = None,
) -> DataFrame:
    """Monthly / annual results: wins, fastest three, medians, longest streak.

    A month is one message in that order.  A year is three messages, as
    posted: wins; medians; fastest three and longest streak.  ``checked`` as in
    :func:`podium.operators.ranking.ranked_position`.  Wins and medians are read
    off ``period_counts`` (:mod:`podium.operators.counts`) where they are given.
    """
    grp = keys(by, "period_start")
    s = streak_table if streak_table is not None else st.streaks(results, by)
    if period_counts is None:
        wins, med = ranking.period_wins(results, by, period, checked), medians.median_times(results, by, period, checked)
    else:
        wins, med = counts.period_wins(period_counts, by, checked), counts.median_times(period_counts, by, checked)
    wins = wins.withColumn("line", fill(tx.WINS_LINE, name="name", n="n", mark="mark"))
    lines = (
        _lines(wins, grp, "wins")
        .unionByName(_lines(ranking.fastest(results, by, period, 3), grp, "fastest"))
        .unionByName(_lines(med, grp, "medians"))
        .unionByName(_lines(st.longest_streak(results, by, period, tx.STREAK_SHOWN_FROM, s), grp, "streak"))
    )
    periods = results.select(*keys(by), period_col("date", period).alias("period_start")).distinct()
    heads = {
        "wins": fill(tx.RESULTS_HEADER, label=period_label("period_start", period)),
        "fastest": F.lit(tx.FASTEST_HEADER),
        "medians": F.lit(tx.MEDIANS_HEADER),
        "streak": F.lit(tx.STREAK_HEADER),
    }
    if period == "year":
        layout = [(1, 1, "wins"), (2, 1, "medians"), (3, 1, "fastest"), (3, 2, "streak")]
    else:
        layout = [(1, 1, "wins"), (1, 2, "fastest"), (1, 3, "medians"), (1, 4, "streak")]
    sections = [(m, q, name, heads[name], name != "streak") for m, q, name in layout]
    return _parts(periods, grp, sections, lines, page_size)


def period_report_for(
    results: DataFrame, as_of: dt.date, by: Sequence[str] | None = None, period: str = "month", offset: int = -1, checked: bool = False
) -> DataFrame:
    """The message parts of one period (default: the one before ``as_of``).

    Period-local sections read only that period's dates (a range filter that
    reaches the scan); streaks read history up to the period's end.
    """
    from podium.functions.calendar import period_range

    start, end = period_range(as_of, period, offset)
    local = results.where((F.col("date") >= F.lit(start)) & (F.col("date") < F.lit(end)))
    history = results.where(F.col("date") < F.lit(end))
    streak_table = st.streaks(history, by).where(F.col("date") >= F.lit(start))
    return period_message(local, by, period, streak_table=streak_table, checked=checked)
