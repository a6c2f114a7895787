"""Ranking within a day, and everything counted from ranks.

Two ways to rank, chosen by what the caller needs:

- :func:`top_ranks` keeps only ranks ``<= k`` (winners, medals).  Each day's
  ``k`` least times are found from counts, aggregated map-side and cut to ``k``
  values a day, and joined back: a day holding a third of all rows, all of them
  tied at the top, is neither sorted nor gathered.
- :func:`day_rank` ranks every row.  A window over a whole day would put a hot
  day into one task, so the rank is computed from a per-day histogram of
  distinct whole seconds instead: ``rank = 1 + number of faster rows``.  The
  histogram is aggregated map-side and is bounded by distinct times per day;
  it is joined back on ``(by…, date, secs)``, which spreads a hot day over its
  distinct times (AQE splits a still-skewed time value).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from podium.functions.calendar import date_text_short, period_col
from podium.functions.texts import CROWN, FASTEST_LINE, MEDALS, fill
from podium.session import checkpoint_dir
from podium.util import checked_broadcast, keys, null_safe_join



RANK_PLAIN_KEYS = ("date", "secs")

#: rows of one value that :func:`ranked_position` numbers in one task, when it counts them
TIE_ROWS = 1 << 18
#: tasks that a partition's rows of one value are dealt to in :func:`positions_by_range`
DEALS = 16


def day_rank(
    results: DataFrame, by: Sequence[str] | None = None, method: str = "histogram", checked: bool = False
) -> DataFrame:
    """Competition rank (``1, 1, 3``) of ``secs`` within each ``(by…, date)``; null secs -> null rank.

    ``checked=True`` materialises the histogram first and broadcasts it when
    its measured size allows (:func:`podium.util.checked_broadcast`), so the
    results are never shuffled; otherwise Spark decides from its estimate.
    """
    day = keys(by, "date")
    if method == "window":
        w = Window.partitionBy(*day).orderBy(F.col("secs").asc_nulls_last())
        return results.withColumn("rnk", F.when(F.col("secs").isNotNull(), F.rank().over(w)).cast("bigint"))
    if method != "histogram":
        raise ValueError("method must be 'histogram' or 'window'")
    hist = results.where(F.col("secs").isNotNull()).groupBy(*day, "secs").agg(F.count(F.lit(1)).alias("n"))
    faster = Window.partitionBy(*day).orderBy("secs").rowsBetween(Window.unboundedPreceding, -1)
    ranks = hist.select(*day, "secs", (F.coalesce(F.sum("n").over(faster), F.lit(0)) + 1).cast("bigint").alias("rnk"))
    if checked:
        ranks = checked_broadcast(ranks)
    # date and secs never match when null (a row without a day or a time has no rank);
    # league keys match null-safely
    return null_safe_join(results, ranks, [*day, "secs"], "left", plain=RANK_PLAIN_KEYS)


def ranked_position(
    df: DataFrame,
    group: Sequence[str],
    value: str | Sequence[str],
    tiebreak: str,
    descending: bool = False,
    out: str = "pos",
    tie_descending: bool | None = None,
    rank: str | None = None,
    checked: bool = False,
) -> DataFrame:
    """``row_number()`` over ``group`` ordered by ``(value, tiebreak)``, without sorting a whole group in one task.

    The position is ``(rows with a better value) + (position among equal
    values by tiebreak)``.  The first term comes from a histogram of
    ``(group, value)`` (aggregated map-side; bounded by distinct values, e.g.
    whole or half seconds), the second from a window over ``(group, value)``
    only — so a group holding a third of all rows is spread over its distinct
    values.  ``value`` may be several columns.  ``descending`` orders ``value``
    descending, and ``tiebreak`` too unless ``tie_descending`` says otherwise.
    Null values come last.  ``rank`` names a column for the competition rank.

    Rows of one value are in one task.  ``checked=True`` first writes the rows
    to the checkpoint folder and counts them by value; if one value has more
    than ``TIE_ROWS``, positions come from :func:`positions_by_range` instead,
    which cuts the rows of one value into many tasks.
    """
    g = list(group)
    values = [value] if isinstance(value, str) else list(value)
    down = descending if tie_descending is None else tie_descending
    vorder = [F.col(v).desc_nulls_last() if descending else F.col(v).asc_nulls_last() for v in values]
    torder = F.col(tiebreak).desc_nulls_last() if down else F.col(tiebreak).asc_nulls_last()
    if checked:
        checkpoint_dir(df.sparkSession)
        df = df.checkpoint(eager=True)
    hist = df.groupBy(*g, *values).agg(F.count(F.lit(1)).alias("__n"))
    if checked and (hist.agg(F.max("__n").alias("n")).first()["n"] or 0) > TIE_ROWS:
        return positions_by_range(df, g, values, vorder, torder, out, rank)
    before = Window.partitionBy(*g).orderBy(*vorder).rowsBetween(Window.unboundedPreceding, -1)
    offsets = hist.select(*g, *values, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"))
    j = null_safe_join(df, offsets, [*g, *values], "left")
    tie = Window.partitionBy(*g, *values).orderBy(torder)
    j = j.withColumn(out, (F.col("__off") + F.row_number().over(tie)).cast("bigint"))
    if rank:
        j = j.withColumn(rank, (F.col("__off") + 1).cast("bigint"))
    return j.drop("__off")


def positions_by_range(
    df: DataFrame, group: Sequence[str], values: Sequence[str], vorder: Sequence[Column], torder: Column, out: str = "pos", rank: str | None = None
) -> DataFrame:
    """Positions from a range partitioning by (group, value, tiebreak): a partition's rows are a piece of the whole order.

    The rows are sorted once and kept in the checkpoint folder with their place
    inside their partition.  A cell is what a partition holds of one value; the
    rows of a group before each cell are a running sum over the group's cells
    (as many as it has values and partitions), joined back on the cell, which
    is never larger than a partition.
    """
    g, values = list(group), list(values)
    order = [*[F.col(c).asc_nulls_last() for c in g], *vorder, torder]
    checkpoint_dir(df.sparkSession)
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__at", F.monotonically_increasing_id())
    placed = placed.checkpoint(eager=True).withColumn("__part", F.shiftright("__at", 33))
    cells = placed.groupBy(*g, *values, "__part").agg(F.min("__at").alias("__first"), F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(*g).orderBy(*vorder, "__part").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.withColumn("__off", F.coalesce(F.sum("__n").over(before), F.lit(0))).drop("__n")
    if rank:
        cells = cells.withColumn(rank, (F.min("__off").over(Window.partitionBy(*g, *values)) + 1).cast("bigint"))
    # a partition's cells are large and few, so each is dealt to several tasks
    cells = cells.withColumn("__deal", F.explode(F.sequence(F.lit(0), F.lit(DEALS - 1))))
    placed = placed.withColumn("__deal", F.pmod("__at", F.lit(DEALS)).cast("int"))
    j = null_safe_join(placed, cells, [*g, *values, "__part", "__deal"], "inner", plain=("__part", "__deal"))
    j = j.withColumn(out, (F.col("__off") + F.col("__at") - F.col("__first") + 1).cast("bigint"))
    return j.drop("__off", "__at", "__first", "__part", "__deal")


def top_ranks(results: DataFrame, by: Sequence[str] | None = None, k: int = 1, method: str = "values") -> DataFrame:
    """Rows ranked ``<= k`` within their day (ties kept), with ``rnk``.

    ``values`` finds each day's ``k`` least times with their counts (grouped
    map-side, and cut to ``k`` values a day before they meet) and joins the few
    that count back on day and time, so however many rows tie at the top of a
    day, they are never in one window.  ``window`` is ``rank() <= k``.
    """
    day = keys(by, "date")
    timed = results.where(F.col("secs").isNotNull())
    w = Window.partitionBy(*day).orderBy("secs")
    if method == "window":
        return timed.withColumn("rnk", F.rank().over(w)).where(F.col("rnk") <= k).withColumn("rnk", F.col("rnk").cast("bigint"))
    if method != "values":
        raise ValueError("method must be 'values' or 'window'")
    if k == 1:
        top = timed.groupBy(*day).agg(F.min("secs").alias("secs")).withColumn("rnk", F.lit(1).cast("bigint"))
    else:
        few = timed.groupBy(*day, "secs").agg(F.count(F.lit(1)).alias("n")).withColumn("at", F.rank().over(w)).where(F.col("at") <= k)
        faster = F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        top = few.withColumn("rnk", (faster + 1).cast("bigint")).where(F.col("rnk") <= k).select(*day, "secs", "rnk")
    return null_safe_join(timed, top, [*day, "secs"], "inner", plain=("secs",))


def winners(results: DataFrame, by: Sequence[str] | None = None) -> DataFrame:
    return top_ranks(results, by, 1)


def with_period(df: DataFrame, period: str, column: str = "period_start") -> DataFrame:
    return df.withColumn(column, period_col("date", period))


def medal_counts(results: DataFrame, by: Sequence[str] | None = None, period: str = "week") -> DataFrame:
    """``(by…, period_start, name, rnk, n)`` for ranks 1-3."""
    top = with_period(top_ranks(results, by, 3), period)
    return top.groupBy(*keys(by, "period_start", "name", "rnk")).agg(F.count(F.lit(1)).alias("n"))


def uncount(counts: DataFrame, n: str = "n") -> DataFrame:
    """One row per unit of ``n`` (``n = 0`` gives no row); ``n`` is dropped."""
    other = [c for c in counts.columns if c != n]
    return counts.select(*other, F.explode(F.array_repeat(F.lit(1), F.col(n).cast("int"))).alias("__u")).drop("__u")


def medal_table(results: DataFrame, by: Sequence[str] | None = None, period: str = "week", checked: bool = False) -> DataFrame:
    """Per period and player with a top-3 finish: medal string and gold/silver/bronze counts.

    Counts are null, not 0, when a player has none of that medal.  ``pos``
    orders golds, silvers, bronzes descending (missing last), then name;
    ``checked`` as in :func:`ranked_position`.
    """
    top = with_period(top_ranks(results, by, 3), period)
    return medal_list(top.withColumn("n", F.lit(1)), by, checked)


def medal_list(top: DataFrame, by: Sequence[str] | None = None, checked: bool = False) -> DataFrame:
    """The medal table of ``(by…, period_start, name, rnk, n)``: how often a player came first, second and third."""
    counts = top.groupBy(*keys(by, "period_start", "name")).agg(
        *[F.sum(F.when(F.col("rnk") == k, F.col("n"))).alias(c) for k, c in ((1, "firsts"), (2, "silvers"), (3, "thirds"))]
    )
    placements = F.concat(
        *[F.repeat(F.lit(MEDALS[k]), F.coalesce(F.col(c), F.lit(0)).cast("int")) for k, c in ((1, "firsts"), (2, "silvers"), (3, "thirds"))]
    )
    table = counts.select(*keys(by, "period_start", "name"), placements.alias("placements"), "firsts", "silvers", "thirds")
    # equal counts are many and distinct counts few: a busy period is spread over its counts
    return ranked_position(table, keys(by, "period_start"), ("firsts", "silvers", "thirds"), "name", descending=True, tie_descending=False, checked=checked)


def period_wins(results: DataFrame, by: Sequence[str] | None = None, period: str = "month", checked: bool = False) -> DataFrame:
    """Days won per player and period, the win-count rank (``rnk``) and the crown for the most; ``checked`` as in :func:`ranked_position`."""
    won = with_period(winners(results, by), period)
    return win_list(won.groupBy(*keys(by, "period_start", "name")).agg(F.count(F.lit(1)).alias("n")), by, checked)


def win_list(n: DataFrame, by: Sequence[str] | None = None, checked: bool = False) -> DataFrame:
    """The ordered list of wins ``(by…, period_start, name, n)``."""
    grp = keys(by, "period_start")
    r = ranked_position(n, grp, "n", "name", descending=True, tie_descending=False, rank="rnk", checked=checked)
    return r.select(*keys(by, "period_start", "name"), "n", "rnk", "pos").withColumn(
        "mark", F.when(F.col("rnk") == 1, F.lit(CROWN)).otherwise(F.lit(""))
    )


def fastest(results: DataFrame, by: Sequence[str] | None = None, period: str = "month", k: int = 3) -> DataFrame:
    """The ``k`` fastest results of each period (exactly ``k``; ties by date, then name).

    ``row_number() <= k`` plans as a partial ``WindowGroupLimit``: each task
    ships only its own top ``k`` per period.
    """
    w = Window.partitionBy(*keys(by, "period_start")).orderBy("secs", "date", F.col("name").asc_nulls_last())
    top = (
        with_period(results.where(F.col("secs").isNotNull()), period)
        .withColumn("pos", F.row_number().over(w))
        .where(F.col("pos") <= k)
    )
    line = fill(FASTEST_LINE, time="time", name="name", day=date_text_short("date"))
    return top.select(
        *keys(by, "period_start"), F.col("pos").cast("bigint").alias("pos"), "name", "date", "secs", "time", line.alias("line")
    )


def rank_distribution(results: DataFrame, by: Sequence[str] | None = None, period: str = "year") -> DataFrame:
    """How often each player finished at each rank, per period."""
    r = with_period(day_rank(results, by), period).where(F.col("rnk").isNotNull())
    return r.groupBy(*keys(by, "period_start", "name", "rnk")).agg(F.count(F.lit(1)).alias("n"))


def participants(results: DataFrame, by: Sequence[str] | None = None) -> DataFrame:
    return results.groupBy(*keys(by, "date")).agg(F.count(F.lit(1)).alias("players"))


def day_max(results: DataFrame, by: Sequence[str] | None = None) -> DataFrame:
    return results.groupBy(*keys(by, "date")).agg(F.max("secs").alias("max_secs"))
