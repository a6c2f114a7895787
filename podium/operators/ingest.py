"""Ingest: board documents -> formatted rows -> merged, canonical results.

The reference polls the same day's board many times and appends only rows it
has not stored yet; that anti-join is what makes a rerun harmless, and it is
kept here as the idempotence mechanism of the batch and the streaming ingest.
Comparison is on whole seconds, so ``1:5`` and ``1:05`` are the same result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from podium.functions.timefmt import format_secs, format_secs_unpadded, parse_time, repair_time
from podium.schemas import CORRUPT
from podium.util import keys, null_safe_join


#: tasks a day's stored rows are dealt to when days are matched
DAY_SALTS = 16


def flatten_board(docs: DataFrame, by: Sequence[str] | None = None) -> DataFrame:
    """Nested board documents -> ``(by…, date, name, secs)``, unsolved entries dropped."""
    e = docs.select(*keys(by, "date"), F.explode("data").alias("e"))
    flat = e.select(
        *keys(by, "date"),
        F.col("e.name").alias("name"),
        F.col("e.score.secondsSpentSolving").try_cast("int").alias("secs"),
    )
    return flat.na.drop(subset=["name", "secs"])


def intake(docs: DataFrame, by: Sequence[str] | None = None) -> DataFrame:
    """Landed documents (:func:`podium.sources.tables.read_board_files`) -> ``(by…, date, name, secs, reason, detail)``.

    Unsolved entries (no time at all) are dropped, as the board lists everyone.
    Whatever else is no result has a ``reason``, and in ``detail`` what was read:
    ``unreadable`` (the document), ``bad time`` (no whole number of seconds),
    ``nameless`` or ``dateless``.  Results have neither.
    """
    corrupt = F.col(CORRUPT)
    entry = F.explode_outer(F.when(corrupt.isNull(), F.col("data"))).alias("e")
    e = docs.select(*keys(by, "date"), corrupt.alias("corrupt"), entry)
    text = F.col("e.score.secondsSpentSolving")
    number = text.try_cast("double")
    secs = F.when((number == F.floor(number)) & (F.abs(number) < 2**31), number).cast("int")
    flat = e.where(F.col("corrupt").isNotNull() | text.isNotNull()).select(*keys(by, "date"), F.col("e.name").alias("name"), secs.alias("secs"), "corrupt", text.alias("text"))
    reason = F.when(F.col("corrupt").isNotNull(), "unreadable").otherwise(reject_reason())
    detail = F.when(F.col("corrupt").isNotNull(), F.col("corrupt")).when(F.col("secs").isNull(), F.col("text"))
    return flat.select(*keys(by, "date"), "name", "secs", reason.alias("reason"), detail.alias("detail"))


def reject_reason() -> Column:
    """Why ``(name, secs, date)`` is no result; null for results."""
    return (
        F.when(F.col("secs").isNull(), "bad time").when(F.col("name").isNull(), "nameless").when(F.col("date").isNull(), "dateless")
    )


def pair_positional(docs: DataFrame, names: str, times: str, by: Sequence[str] | None = None) -> DataFrame:
    """Boards given as two parallel arrays: the first ``size(times)`` names get the times.

    Right only when every unsolved entry comes after every solved one, as the
    source orders them.
    """
    zipped = F.arrays_zip(F.slice(F.col(names), 1, F.size(times)).alias("name"), F.col(times).alias("secs"))
    z = docs.select(*keys(by, "date"), F.explode(zipped).alias("z"))
    return z.select(*keys(by, "date"), F.col("z.name").alias("name"), F.col("z.secs").try_cast("int").alias("secs"))


def format_incoming(flat: DataFrame, by: Sequence[str] | None = None, padded: bool = True) -> DataFrame:
    """``(…, secs)`` -> ``(by…, name, time, date)`` with ``m:ss`` (or ``m:s``) text."""
    fmt = format_secs if padded else format_secs_unpadded
    return flat.select(*keys(by, "name"), fmt("secs").alias("time"), "date")


def repair(raw: DataFrame) -> DataFrame:
    return raw.withColumn("time", repair_time("time"))


def dedupe_keep_first(raw: DataFrame, by: Sequence[str] | None = None) -> DataFrame:
    """One row per ``(by…, name, time, date)``, keeping the earliest ``submitted_at``.

    A grouped ``min``: combined map-side, so repeated rows never cross the
    network more than once per task and a hot key does not land in one task.
    """
    return raw.groupBy(*keys(by, "name", "time", "date")).agg(F.min("submitted_at").alias("submitted_at")).select(
        "submitted_at", *keys(by, "name", "time", "date")
    )


def clean_stored(raw: DataFrame, by: Sequence[str] | None = None) -> DataFrame:
    return dedupe_keep_first(repair(raw), by)


def _with_secs(df: DataFrame) -> DataFrame:
    return df if "secs" in df.columns else df.withColumn("secs", parse_time("time"))


def new_rows(incoming: DataFrame, stored: DataFrame, by: Sequence[str] | None = None) -> DataFrame:
    """Incoming rows not stored yet: null-safe anti-join on ``(by…, name, date, secs)``."""
    on = keys(by, "name", "date", "secs")
    st = _with_secs(stored).select(*on)
    out = null_safe_join(_with_secs(incoming), st, on, "left_anti")
    return out if "secs" in incoming.columns else out.drop("secs")


def orphan_rows(stored: DataFrame, incoming: DataFrame, by: Sequence[str] | None = None) -> DataFrame:
    """Stored rows of the days being loaded that the incoming board does not have.

    Only days present in ``incoming`` are compared: a semi-join with the days,
    each repeated once per salt, so that the stored rows of a busy day are dealt
    to ``DAY_SALTS`` tasks by a hash of the name.
    """
    on = keys(by, "name", "date", "secs")
    salts = F.explode(F.sequence(F.lit(0), F.lit(DAY_SALTS - 1))).alias("__salt")
    days = incoming.select(*keys(by, "date")).distinct().select(*keys(by, "date"), salts)
    dealt = _with_secs(stored).withColumn("__salt", F.pmod(F.xxhash64("name"), F.lit(DAY_SALTS)).cast("int"))
    st = null_safe_join(dealt, days, keys(by, "date", "__salt"), "left_semi", plain=("__salt",)).drop("__salt")
    out = null_safe_join(st, _with_secs(incoming).select(*on), on, "left_anti")
    return out if "secs" in stored.columns else out.drop("secs")


def append_rows(stored: DataFrame, new: DataFrame) -> DataFrame:
    """Stored rows plus new ones; columns the new rows lack (``submitted_at``) are null.

    A union, not a join: the anti-join guarantees the two sides share no key.
    """
    return stored.unionByName(new, allowMissingColumns=True)


def canonical(rows: DataFrame, by: Sequence[str] | None = None) -> DataFrame:
    """One row per ``(by…, name, date)``: the fastest parseable time, as ``secs`` and padded text.

    Rows without a name, a date or a parseable time are not results (see :func:`rejects`).
    """
    # min ignores nulls, so filtering after the aggregate gives the same rows and
    # keeps the parse out of pushed-down filters (it runs once per row)
    return (
        _with_secs(rows)
        .groupBy(*keys(by, "name", "date"))
        .agg(F.min("secs").alias("secs"))
        .where(F.col("name").isNotNull() & F.col("date").isNotNull() & F.col("secs").isNotNull())
        .withColumn("time", format_secs("secs"))
    )


def rejects(rows: DataFrame) -> DataFrame:
    """Rows :func:`canonical` leaves out, for a data-quality report."""
    r = _with_secs(rows)
    return r.where(F.col("name").isNull() | F.col("date").isNull() | F.col("secs").isNull())


def ingest(stored_raw: DataFrame, incoming: DataFrame, by: Sequence[str] | None = None) -> DataFrame:
    """The whole update: repair + dedupe stored rows, add new ones, canonicalise."""
    stored = _with_secs(clean_stored(stored_raw, by))
    fresh = new_rows(_with_secs(incoming), stored, by)  # both sides parsed once; secs carried through
    return canonical(append_rows(stored, fresh), by)


def progress_marker(results: DataFrame, by: Sequence[str] | None = None) -> DataFrame:
    """Latest day with results, per league."""
    return results.groupBy(*keys(by)).agg(F.max("date").alias("latest_date"))
