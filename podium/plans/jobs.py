"""End-to-end jobs: what the reference's scripts do, as Spark jobs over stored tables.

- :func:`run_ingest`   — landed board files -> new rows appended to the results table.
- :func:`run_daily`    — one day's standings message (+ progress marker).
- :func:`run_period`   — weekly / monthly / annual message for one period.

Each job reads the results table (``date``-partitioned Parquet), so day and
period filters prune partitions; each writes its output to a shared path and
nothing passes through the driver.  Ingest is append-only and idempotent, so a
job lost half-way is simply rerun.
"""

from __future__ import annotations

import argparse
import datetime as dt
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from podium import versions
from podium.functions.calendar import as_of_default, period_range
from podium.functions.texts import DAILY_TITLE
from podium.functions.timefmt import format_secs
from podium.operators import ingest as ing
from podium.operators import streaks as st
from podium.plans import count_table
from podium.plans import reports as rp
from podium.session import child_names, delete_path, path_exists, scratch_path
from podium.sources.sinks import append_results, cluster_by_day, overwrite_partitions, write_marker, write_messages
from podium.sources.tables import landed_files, read_board, read_board_files
from podium.util import keys, null_safe_join


def stored_schema(by: Sequence[str] | None = None) -> T.StructType:
    fields = [T.StructField(k, T.StringType(), True) for k in (by or [])]
    return T.StructType(
        [
            *fields,
            T.StructField("name", T.StringType(), True),
            T.StructField("time", T.StringType(), True),
            T.StructField("secs", T.IntegerType(), True),
            T.StructField("date", T.DateType(), True),
        ]
    )


def read_stored(spark: SparkSession, table_path: str, by: Sequence[str] | None = None, first_run: bool = False) -> DataFrame:
    """The stored rows (possibly several per player and day: corrections are appended).

    A missing table is an error, but for ``first_run`` (ingest into a new table).
    """
    if first_run:
        return _read_or_empty(spark, table_path, stored_schema(by))
    return spark.read.schema(stored_schema(by)).parquet(table_path)


def read_canonical(
    spark: SparkSession, table_path: str, by: Sequence[str] | None = None, canonical_path: str | None = None
) -> DataFrame:
    """One row per (by…, name, date): the fastest stored time.

    With ``canonical_path`` (kept by :func:`compact_days`) the rows are read as
    they are; otherwise they are derived from the stored rows with a grouped
    ``min`` (a shuffle of the days read).
    """
    if canonical_path:
        schema = T.StructType(
            [*[T.StructField(k, T.StringType(), True) for k in (by or [])],
             T.StructField("name", T.StringType(), True), T.StructField("secs", T.IntegerType(), True),
             T.StructField("time", T.StringType(), True), T.StructField("date", T.DateType(), True)]
        )
        return spark.read.schema(schema).parquet(canonical_path)
    return ing.canonical(read_stored(spark, table_path, by), by)


def compact_days(
    spark: SparkSession, table_path: str, canonical_path: str, days: Sequence[dt.date], by: Sequence[str] | None = None
) -> None:
    """Rewrite the canonical table's partitions for ``days`` from the stored rows.

    Reads only those days of the stored table (a partition filter, see
    :func:`_on_days`) and replaces only those days of the canonical table
    (dynamic partition overwrite of a different path), so a rerun gives the
    same table.
    """
    rows = read_stored(spark, table_path, by).where(F.col("date").isin(list(days)))
    canon = ing.canonical(rows, by).select(*keys(by, "name"), "secs", "time", "date")
    overwrite_partitions(canon, canonical_path, by)


def _on_days(stored: DataFrame, rows: DataFrame, by: Sequence[str] | None) -> DataFrame:
    """Restrict stored rows to the days present in ``rows``.

    The distinct dates of a batch are bounded by the calendar (at most 366 per
    year covered), not by the data, so they are fetched and applied as an
    ``IN`` filter on the partition column: only those partitions are read and
    no join (which would gather a busy day into one task) is needed.  Rows
    without a date are never stored (:func:`append_new_rows`).
    """
    return stored.where(F.col("date").isin(_days(rows)))


def _days(rows: DataFrame) -> list[dt.date]:
    """The days of a batch, a list bounded by the calendar."""
    return sorted(r.date for r in rows.select("date").where("date IS NOT NULL").distinct().collect())


def rejects_path(table_path: str) -> str:
    """Where :func:`append_new_rows` keeps rows that are no results (hidden from readers of the table)."""
    return f"{table_path.rstrip('/')}/_rejects"


def _touched_path(table_path: str) -> str:
    return f"{table_path.rstrip('/')}/_touched"


_TOUCHED = T.StructType([T.StructField("batch", T.StringType()), T.StructField("date", T.DateType())])


def reject_schema(by: Sequence[str] | None = None) -> T.StructType:
    return T.StructType([*stored_schema(by).fields, T.StructField("reason", T.StringType()), T.StructField("detail", T.StringType())])


def read_rejects(spark: SparkSession, table_path: str, by: Sequence[str] | None = None) -> DataFrame:
    """What came and is no result, each once, with the ``reason`` and the text read (:func:`podium.operators.ingest.intake`)."""
    return _read_or_empty(spark, rejects_path(table_path), reject_schema(by))


def append_new_rows(rows: DataFrame, table_path: str, by: Sequence[str] | None = None) -> list[dt.date]:
    """Append ``(by…, name, date, secs)`` rows the table does not hold yet; returns the days of the rows.

    The stored side is first restricted to the days present in ``rows`` (see
    :func:`_on_days`: only those partitions are read).  Rows with a ``reason``
    (of :func:`podium.operators.ingest.intake`), or without a name, a date or a
    time, go to the rejects of the table, once.  The days that get new rows are
    logged before the rows are appended, so that what was derived from the table
    earlier can be brought up to date whoever polled again.

    Rows are read once, into the shared scratch folder, which is left as it was found.
    """
    spark, scratch = rows.sparkSession, []
    for name in ("reason", "detail"):
        if name not in rows.columns:
            rows = rows.withColumn(name, F.lit(None).cast("string"))
    reason = F.coalesce(F.col("reason"), ing.reject_reason()).alias("reason")
    rows = rows.select(*keys(by, "name"), format_secs("secs").alias("time"), F.col("secs").cast("int").alias("secs"), "date", reason, "detail")
    try:
        # the same board polled twice in one batch gives the same rows twice
        rows = _snapshot(rows.dropDuplicates(keys(by, "name", "date", "secs", "reason", "detail")), "incoming", scratch)
        known = read_rejects(spark, table_path, by)
        lost = null_safe_join(rows.where("reason IS NOT NULL"), known, keys(by, "name", "date", "secs", "reason", "detail"), "left_anti")
        lost = _snapshot(lost, "rejects", scratch)
        if not lost.isEmpty():
            lost.write.mode("append").parquet(rejects_path(table_path))
        good = rows.where("reason IS NULL").drop("reason", "detail")
        days = _days(good)
        stored = read_stored(spark, table_path, by, first_run=True).where(F.col("date").isin(days))
        fresh = _snapshot(ing.new_rows(good, stored, by), "fresh", scratch)
        touched = fresh.select(F.lit(uuid.uuid4().hex).alias("batch"), "date").distinct()
        touched.coalesce(1).write.mode("append").parquet(_touched_path(table_path))
        append_results(fresh, table_path, by)
        return days
    finally:
        for path in scratch:
            delete_path(spark, path)


def _snapshot(df: DataFrame, name: str, scratch: list[str]) -> DataFrame:
    """``df`` written to the shared scratch folder: read twice, and never while the files it comes from change."""
    path = scratch_path(df.sparkSession, name)
    scratch.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_FILES = T.StructType([T.StructField("path", T.StringType()), T.StructField("length", T.LongType()), T.StructField("modified", T.TimestampType())])
#: files taken in by one commit, and folders of a ledger before they are written as one
FILES_PER_BATCH, LEDGER_FOLDERS = 10_000, 16


def _ledger_path(table_path: str) -> str:
    return f"{table_path.rstrip('/')}/_files"


def read_ledger(spark: SparkSession, table_path: str) -> DataFrame:
    """path, length and modified of the landed files the table has taken in."""
    return _ledger(spark, table_path, versions.latest(spark, _ledger_path(table_path)))


def _ledger(spark: SparkSession, table_path: str, version: versions.Version | None) -> DataFrame:
    folders = version.state["folders"] if version else []
    if not folders:
        return spark.createDataFrame([], _FILES)
    return spark.read.schema(_FILES).parquet(*[f"{_ledger_path(table_path)}/{f}" for f in folders])


def new_files(
    spark: SparkSession, board_dir: str, table_path: str, since: dt.date | None = None, until: dt.date | None = None
) -> DataFrame:
    """Landed files the ledger does not know as they are now (a changed file is a new one), found without opening any."""
    files = landed_files(spark, board_dir, since, until)
    return files.join(read_ledger(spark, table_path), ["path", "length", "modified"], "left_anti")


def _taken_in(spark: SparkSession, table_path: str, files: list, days: list[dt.date]) -> None:
    """Commit a batch's files to the ledger."""
    path = _ledger_path(table_path)
    folder = versions.new_folder()
    spark.createDataFrame(files, _FILES).coalesce(1).write.parquet(f"{path}/{folder}")

    def change(now: versions.Version | None) -> dict:
        folders = [*(now.state["folders"] if now else []), folder]
        if len(folders) > LEDGER_FOLDERS:
            whole = versions.new_folder()
            spark.read.schema(_FILES).parquet(*[f"{path}/{f}" for f in folders]).distinct().write.parquet(f"{path}/{whole}")
            folders = [whole]
        return {"folders": folders, "files": len(files), "days": [d.isoformat() for d in days]}

    versions.update(spark, path, change)
    versions.expire(spark, path, lambda state: state.get("folders", []))


def run_ingest(
    spark: SparkSession,
    board_dir: str,
    table_path: str,
    by: Sequence[str] | None = None,
    canonical_path: str | None = None,
    since: dt.date | None = None,
    until: dt.date | None = None,
    multi_line: bool = False,
) -> list[versions.Version]:
    """Landed board JSON (one document per day) -> new rows of the results table.

    Only files the ledger of the table does not know are opened, and of those
    named for a day only the days ``since`` .. ``until`` (both the load date to
    take in one day), so a poll costs what has landed since the last one: its
    files, and the stored partitions of their days.  A file is in the ledger
    when its rows are in the table; a run that dies before takes it in again,
    which adds nothing twice.

    With ``canonical_path`` the canonical table is refreshed for the days the
    files cover.  Returns the commits made (their state names files and days).
    """
    made = []
    while True:
        files = new_files(spark, board_dir, table_path, since, until).orderBy("path").limit(FILES_PER_BATCH).collect()
        if not files:
            return made
        docs = read_board_files(spark, board_dir, [f.path for f in files], by, multi_line)
        days = append_new_rows(ing.intake(docs, by), table_path, by)
        if canonical_path and days:
            compact_days(spark, table_path, canonical_path, days, by)
        _taken_in(spark, table_path, files, days)
        made.append(versions.latest(spark, _ledger_path(table_path)))


def run_reconcile(spark: SparkSession, board_dir: str, table_path: str, out_path: str, by: Sequence[str] | None = None) -> None:
    """Stored rows of the boards' days that the boards do not show (any more): one report, replaced by each run."""
    flat = ing.flatten_board(read_board(spark, board_dir, by=by), by)
    stored = _on_days(read_stored(spark, table_path, by), flat, by)
    ing.orphan_rows(stored, flat, by).write.mode("overwrite").parquet(out_path)


def _streak_schema(by: Sequence[str] | None) -> T.StructType:
    fields = [T.StructField(k, T.StringType(), True) for k in (by or [])]
    return T.StructType(
        [*fields, T.StructField("name", T.StringType(), True), T.StructField("streak", T.LongType(), True), T.StructField("date", T.DateType(), True)]
    )


def _read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    if path_exists(spark, path):
        return spark.read.schema(schema).parquet(path)
    return spark.createDataFrame([], schema)


@dataclass(frozen=True)
class StreakState:
    """The last day processed, the folder (generation) that holds the rows, and the one before it."""

    through: dt.date
    generation: str
    previous: str | None


def streak_state(spark: SparkSession, streak_path: str) -> StreakState | None:
    """What the streak table's latest commit says; None if there is no table."""
    now = versions.latest(spark, streak_path)
    if now is None:
        return None
    return StreakState(dt.date.fromisoformat(now.state["through"]), now.state["generation"], now.state["previous"])


def _unseen(spark: SparkSession, table_path: str | None, streak_path: str) -> list:
    """(batch, earliest day) of the polls this streak table has not taken in yet; one row per poll since its last update."""
    if table_path is None:
        return []
    seen = _read_or_empty(spark, f"{streak_path}/_seen", T.StructType(_TOUCHED.fields[:1]))
    touched = _read_or_empty(spark, _touched_path(table_path), _TOUCHED)
    return touched.join(seen, "batch", "left_anti").groupBy("batch").agg(F.min("date").alias("date")).collect()


def _known_until(through: dt.date, unseen: list, late_from: dt.date | None = None) -> dt.date:
    """The last day whose streaks still hold: the day before the earliest change, ``through`` at most."""
    changed = [r.date for r in unseen if r.date is not None] + ([late_from] if late_from else [])
    return min([through, *[d - dt.timedelta(days=1) for d in changed]])


def _redone(results: DataFrame, stored: DataFrame, known: dt.date, upto: dt.date, by: Sequence[str] | None) -> DataFrame:
    """Streak rows of the days after ``known`` through ``upto``, continuing the stored ones of ``known``."""
    carried = stored.where(F.col("date") == F.lit(known))
    rows = st.streaks_from(results.where(F.col("date") <= F.lit(upto)), carried, known + dt.timedelta(days=1), by)
    return rows.select(*keys(by, "name"), "streak", "date")


def update_streaks(
    spark: SparkSession,
    results: DataFrame,
    streak_path: str,
    as_of: dt.date,
    by: Sequence[str] | None = None,
    rebuild: bool = False,
    late_from: dt.date | None = None,
    table_path: str | None = None,
) -> DataFrame:
    """Keep the winners-only streak table current through ``as_of``; return its rows for ``as_of - 1 .. as_of``.

    The table's latest commit (:mod:`podium.versions`) names the last day
    processed and the folder (generation) that holds the rows.  Days after it,
    one or many, are computed from their results and the streaks of the last
    day, and written as new ``date`` partitions; readers see them with the next
    commit.

    With ``table_path`` the days that polls have changed since the last update
    are read from that table's log (:func:`append_new_rows`); ``late_from``
    names such a day by hand.  Then a new generation takes over the rows before
    the earliest changed day (winners only, so few) and recomputes the rest;
    the generation readers may hold is left alone until the next but one.

    The table is rebuilt from history only on the first run or with ``rebuild``.
    """
    at = versions.latest(spark, streak_path)
    marker = streak_state(spark, streak_path)
    unseen = _unseen(spark, table_path, streak_path)
    old = marker.generation if marker else None
    through = marker.through if marker else None
    stored = _read_or_empty(spark, f"{streak_path}/{old}", _streak_schema(by)) if marker else None
    known = _known_until(through, unseen, late_from) if marker else None
    generation = old
    if marker is None or rebuild:
        generation = f"gen-{as_of.isoformat()}-{uuid.uuid4().hex[:8]}"
        upto = max(through, as_of) if through else as_of
        rows = st.streaks(results.where(F.col("date") <= F.lit(upto)), by).select(*keys(by, "name"), "streak", "date")
    elif known < through:
        generation = f"gen-{as_of.isoformat()}-{uuid.uuid4().hex[:8]}"
        upto = max(through, as_of)
        rows = stored.where(F.col("date") <= F.lit(known)).select(*keys(by, "name"), "streak", "date").unionByName(_redone(results, stored, known, upto, by))
    else:
        upto = max(through, as_of)
        rows = _redone(results, stored, through, upto, by) if upto > through else None
    table = f"{streak_path}/{generation}"
    if rows is not None:
        # only days no reader looks at yet are written: a new folder, or partitions after ``through``
        clustered = cluster_by_day(rows, ["date"], order=["name"])
        clustered.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("date").parquet(table)
        previous = old if old != generation else marker.previous
        versions.commit(spark, streak_path, {"through": upto.isoformat(), "generation": generation, "previous": previous}, at)
        versions.expire(spark, streak_path, lambda state: [])
        for name in child_names(spark, streak_path):
            if name.startswith("gen-") and name not in (generation, previous):
                delete_path(spark, f"{streak_path}/{name}")
    if unseen:
        spark.createDataFrame([(r.batch,) for r in unseen], "batch string").coalesce(1).write.mode("append").parquet(f"{streak_path}/_seen")
    rows = _read_or_empty(spark, table, _streak_schema(by))
    return rows.where((F.col("date") >= F.lit(as_of - dt.timedelta(days=1))) & (F.col("date") <= F.lit(as_of)))


def read_streaks(
    spark: SparkSession,
    streak_path: str,
    by: Sequence[str] | None = None,
    results: DataFrame | None = None,
    upto: dt.date | None = None,
    table_path: str | None = None,
) -> DataFrame:
    """The streak table kept by :func:`update_streaks`; a path without one is an error.

    With ``results`` the rows are complete through ``upto``: days the table
    lacks, or that polls have changed since (logged by ``table_path``), are
    recomputed from their results and the streaks before them.
    """
    marker = streak_state(spark, streak_path)
    if marker is None:
        raise FileNotFoundError(f"no streak table at {streak_path}; the daily job keeps one")
    stored = _read_or_empty(spark, f"{streak_path}/{marker.generation}", _streak_schema(by))
    stored = stored.where(F.col("date") <= F.lit(marker.through))
    if results is None or upto is None:
        return stored
    known = _known_until(marker.through, _unseen(spark, table_path, streak_path))
    if known >= upto:
        return stored
    valid = stored.where(F.col("date") <= F.lit(known))
    return valid.unionByName(_redone(results, valid, known, upto, by))


def read_marker(spark: SparkSession, marker_path: str, by: Sequence[str] | None = None) -> DataFrame:
    """The last posted day of each league; empty before the first post."""
    return _marker(spark, marker_path, by, versions.latest(spark, marker_path))


def _marker(spark: SparkSession, marker_path: str, by: Sequence[str] | None, version: versions.Version | None) -> DataFrame:
    schema = T.StructType([*[T.StructField(k, T.StringType(), True) for k in (by or [])], T.StructField("latest_date", T.DateType(), True)])
    if version is None:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{marker_path.rstrip('/')}/{version.state['table']}")


def update_marker(spark: SparkSession, posted: DataFrame, marker_path: str, by: Sequence[str] | None = None) -> None:
    """Raise each league's last posted day to the newest day in ``posted``; other leagues keep theirs.

    The merged marker is a new folder, and the commit that names it is the only
    step that readers see, so a run that dies at any step leaves the old marker.
    """

    def change(now: versions.Version | None) -> dict:
        old, folder = _marker(spark, marker_path, by, now), versions.new_folder()
        merged = old.unionByName(ing.progress_marker(posted, by)).groupBy(*keys(by)).agg(F.max("latest_date").alias("latest_date"))
        write_marker(merged, f"{marker_path.rstrip('/')}/{folder}")
        return {"table": folder}

    versions.update(spark, marker_path, change)
    versions.expire(spark, marker_path, lambda state: [state["table"]] if state else [])


def _kind_messages(parts: DataFrame, kind: str, key: str) -> DataFrame:
    """Tag message parts with their kind and the upload title the reference uses."""
    from podium.functions.calendar import period_label

    m = parts.withColumnRenamed(key, "period_start").withColumn("kind", F.lit(kind))
    title = F.lit(DAILY_TITLE) if kind == "daily" else period_label("period_start", kind)
    return m.withColumn("title", title)


def daily_report_for(
    results: DataFrame, as_of: dt.date, by: Sequence[str] | None = None, streak_rows: DataFrame | None = None
) -> DataFrame:
    """Message parts of one day.

    ``streak_rows`` (streaks of ``as_of - 1`` and ``as_of``, e.g. from
    :func:`update_streaks`) avoid reading history; without them the winners of
    all history up to ``as_of`` are read.
    """
    day = results.where(F.col("date") == F.lit(as_of))
    if streak_rows is None:
        history = results.where(F.col("date") <= F.lit(as_of))
        streak_rows = st.streaks(history, by).where(F.col("date") >= F.lit(as_of - dt.timedelta(days=1)))
    return rp.daily_message(day, by, streak_table=streak_rows)


def run_daily(
    spark: SparkSession,
    table_path: str,
    messages_path: str,
    marker_path: str | None = None,
    as_of: dt.date | None = None,
    by: Sequence[str] | None = None,
    streak_path: str | None = None,
    canonical_path: str | None = None,
) -> None:
    """Post one day.  With ``streak_path`` the streak table is kept incrementally and only the days
    since its last update (or since the earliest day polled again) are read; without it, streaks
    are recomputed from history."""
    as_of = as_of or as_of_default()
    results = read_canonical(spark, table_path, by, canonical_path)
    streak_rows = update_streaks(spark, results, streak_path, as_of, by, table_path=table_path) if streak_path else None
    write_messages(_kind_messages(daily_report_for(results, as_of, by, streak_rows), "daily", "date"), messages_path)
    if marker_path:
        update_marker(spark, results.where(F.col("date") == F.lit(as_of)), marker_path, by)


def period_report_for(
    results: DataFrame,
    as_of: dt.date,
    by: Sequence[str] | None = None,
    period: str = "month",
    offset: int | None = None,
    streak_table: DataFrame | None = None,
    lookback_days: int | None = None,
    checked: bool = False,
    period_counts: DataFrame | None = None,
) -> DataFrame:
    """Week: the current ISO week (offset 0); month / year: the previous one (offset -1).

    ``streak_table`` (e.g. :func:`read_streaks`) spares the scan of history for the longest streak.
    ``lookback_days`` counts streaks from results of that many days before ``as_of`` only (the
    literal monthly report looks back 90), so longer streaks are cut; the default is all history.
    ``checked`` counts ties first and numbers huge ones in many tasks
    (:func:`podium.operators.ranking.ranked_position`).  ``period_counts`` of the
    period (:func:`podium.plans.count_table.read_counts`) spare its ranking and medians.
    """
    if offset is None:
        offset = 0 if period == "week" else -1
    start, end = period_range(as_of, period, offset)
    in_range = (F.col("date") >= F.lit(start)) & (F.col("date") < F.lit(end))
    if period == "week":
        return rp.weekly_message(results.where(in_range), by, checked=checked, period_counts=period_counts)
    if lookback_days is not None:
        streak_table = st.streaks(rp.lookback(results, as_of, lookback_days), by)
    if streak_table is None:
        streak_table = st.streaks(results.where(F.col("date") < F.lit(end)), by)
    return rp.period_message(
        results.where(in_range), by, period, streak_table=streak_table.where(in_range), checked=checked, period_counts=period_counts
    )


def update_counts(spark: SparkSession, table_path: str, counts_path: str, by: Sequence[str] | None = None) -> versions.Version | None:
    """Bring the stored counts (:mod:`podium.plans.count_table`) up to date with the table's polls."""
    touched = _read_or_empty(spark, _touched_path(table_path), _TOUCHED)
    return count_table.update_counts(spark, read_stored(spark, table_path, by), touched, counts_path, by)


def run_period(
    spark: SparkSession,
    table_path: str,
    messages_path: str,
    period: str,
    as_of: dt.date | None = None,
    by: Sequence[str] | None = None,
    streak_path: str | None = None,
    canonical_path: str | None = None,
    lookback_days: int | None = None,
    counts_path: str | None = None,
) -> None:
    """Post one period; ``lookback_days`` as in :func:`period_report_for`.

    With ``counts_path`` the stored state there is first brought up to date
    (:func:`update_counts`) and the report is made from it: of the table only the
    days polled since its last update are read.
    """
    as_of = as_of or as_of_default()
    results, period_counts = read_canonical(spark, table_path, by, canonical_path), None
    if counts_path:
        update_counts(spark, table_path, counts_path, by)
        results = count_table.read_days(spark, counts_path, dt.date.min, dt.date.max, by)
        period_counts = count_table.read_counts(spark, counts_path, as_of, period, 0 if period == "week" else -1, by)
    streak_table = None
    if streak_path and period != "week":
        _, end = period_range(as_of, period, -1)
        streak_table = read_streaks(spark, streak_path, by, results, end - dt.timedelta(days=1), table_path)
    parts = period_report_for(results, as_of, by, period, streak_table=streak_table, lookback_days=lookback_days, checked=True, period_counts=period_counts)
    write_messages(_kind_messages(parts, period, "period_start"), messages_path)


def main(argv: Sequence[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="python -m podium.plans.jobs")
    p.add_argument("job", choices=["ingest", "reconcile", "daily", "week", "month", "year"])
    p.add_argument("--table", required=True, help="results table path (date-partitioned Parquet)")
    p.add_argument("--boards", help="landed board JSON folder (ingest, reconcile)")
    p.add_argument("--messages", help="output path of messages or of the reconciliation")
    p.add_argument("--marker", help="progress marker path (daily)")
    p.add_argument("--streaks", help="incremental streak table path (daily keeps it; month / year read it)")
    p.add_argument("--lookback-days", type=int, default=None, help="streaks of month / year from so many days only (literal form: 90)")
    p.add_argument("--as-of", type=dt.date.fromisoformat, default=None)
    p.add_argument("--by", default="", help="comma-separated league keys")
    p.add_argument("--load-date", type=dt.date.fromisoformat, default=None, help="take in the boards of this day only (ingest)")
    p.add_argument("--since", type=dt.date.fromisoformat, default=None, help="take in boards from this day on only (ingest)")
    p.add_argument("--canonical", help="compacted canonical table path (ingest keeps it; reports read it)")
    p.add_argument("--counts", help="stored counts path (week, month and year keep it and report from it)")
    a = p.parse_args(argv)
    by = [k for k in a.by.split(",") if k] or None
    spark = SparkSession.builder.getOrCreate()
    if a.job == "ingest":
        run_ingest(spark, a.boards, a.table, by, a.canonical, a.load_date or a.since, a.load_date)
    elif a.job == "reconcile":
        run_reconcile(spark, a.boards, a.table, a.messages, by)
    elif a.job == "daily":
        run_daily(spark, a.table, a.messages, a.marker, a.as_of, by, a.streaks, a.canonical)
    else:
        run_period(spark, a.table, a.messages, a.job, a.as_of, by, a.streaks, a.canonical, a.lookback_days, a.counts)


if __name__ == "__main__":
    main()
