"""The stored state behind period reports: each day's ranked rows, and counts of each month.

One folder per update holds the days it rewrote (``layer=days/date=…``) and the
months these lie in (``layer=months/month=…``); the latest commit
(:mod:`podium.versions`) names the folder of every day and month, a list bounded
by the calendar.  Nothing that a reader may hold is replaced, and an update that
dies leaves the state before it; folders that no commit names expire.

An update reads the stored rows of the touched days only.  A month is its stored
counts, less those of the touched days' states before, plus those of the new
ones, so running an update again changes nothing.  One update runs at a time,
after an ingest (another one that commits first makes it fail with
:class:`podium.versions.Conflict`).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from podium import versions
from podium.functions.calendar import period_range
from podium.functions.timefmt import format_secs
from podium.operators import counts as ct
from podium.operators import ingest as ing
from podium.session import child_names
from podium.sources.sinks import cluster_by_day
from podium.util import keys

_FOLDER = "generation=v"
#: counts that one task sorts and writes
FILE_ROWS = 1 << 20
_BATCH = T.StructType([T.StructField("batch", T.StringType())])


def _schema(by: Sequence[str] | None, *fields: tuple[str, T.DataType]) -> T.StructType:
    head = [(k, T.StringType()) for k in keys(by)]
    return T.StructType([T.StructField(n, t, True) for n, t in [*head, *fields]])


def _read(spark: SparkSession, path: str, folders: dict[str, str], layer: str, key: str, schema: T.StructType) -> DataFrame:
    """The partitions ``key=<k>`` of a layer, each from the folder that holds it."""
    if not folders:
        return spark.createDataFrame([], schema)
    base = path.rstrip("/")
    paths = [f"{base}/{folder}/layer={layer}/{key}={k}" for k, folder in sorted(folders.items())]
    return spark.read.option("basePath", base).schema(schema).parquet(*paths).select(*schema.names)


def _days(spark: SparkSession, path: str, folders: dict[str, str], by: Sequence[str] | None) -> DataFrame:
    fields = [("name", T.StringType()), ("secs", T.IntegerType()), ("rnk", T.LongType()), ("date", T.DateType())]
    return _read(spark, path, folders, "days", "date", _schema(by, *fields))


def _months(spark: SparkSession, path: str, folders: dict[str, str], by: Sequence[str] | None) -> DataFrame:
    fields = [("name", T.StringType()), ("kind", T.StringType()), ("dow", T.IntegerType()), ("value", T.LongType()), ("n", T.LongType()), ("month", T.DateType())]
    rows = _read(spark, path, folders, "months", "month", _schema(by, *fields))
    return rows.select(*keys(by), F.col("month").alias("period_start"), "name", "kind", "dow", "value", "n")


def _among(folders: dict[str, str], start: dt.date, end: dt.date) -> dict[str, str]:
    return {k: f for k, f in folders.items() if start <= dt.date.fromisoformat(k) < end}


def _seen_path(path: str) -> str:
    return f"{path.rstrip('/')}/_seen"


def update_counts(
    spark: SparkSession, stored: DataFrame, touched: DataFrame, path: str, by: Sequence[str] | None = None
) -> versions.Version | None:
    """Bring the state up to date with the stored rows; returns its latest version.

    ``touched`` is the table's log ``(batch, date)`` of the days that polls have
    changed.  Without a state all days are taken in, otherwise those of the
    batches it has not seen.
    """
    at = versions.latest(spark, path)
    seen = spark.read.schema(_BATCH).parquet(_seen_path(path)) if "_seen" in child_names(spark, path) else spark.createDataFrame([], _BATCH)
    polls = touched.join(seen, "batch", "left_anti").groupBy("batch").agg(F.collect_set("date").alias("days")).collect()
    if at is None:
        at = _taken_in(spark, stored, path, by, None)
    else:
        days = {d for p in polls for d in p.days}
        if days:
            at = _taken_in(spark, stored.where(F.col("date").isin(sorted(days))), path, by, at)
    if polls:
        spark.createDataFrame([(p.batch,) for p in polls], _BATCH).coalesce(1).write.mode("append").parquet(_seen_path(path))
    return at


def _taken_in(spark: SparkSession, stored: DataFrame, path: str, by: Sequence[str] | None, at: versions.Version | None) -> versions.Version:
    """Write the days of ``stored`` and their months into a new folder, and commit it."""
    old_days, old_months = (at.state["days"], at.state["months"]) if at else ({}, {})
    folder = versions.new_folder(_FOLDER)
    base = f"{path.rstrip('/')}/{folder}"
    state = ct.day_state(ing.canonical(stored, by), by)
    cluster_by_day(state, ["date"]).write.partitionBy("date").parquet(f"{base}/layer=days")
    written = _values(spark, f"{base}/layer=days", "date")
    months = sorted({d[:8] + "01" for d in written})
    new = _days(spark, path, dict.fromkeys(written, folder), by)
    before = _days(spark, path, {d: f for d, f in old_days.items() if d in written}, by)
    held = _months(spark, path, {m: f for m, f in old_months.items() if m in months}, by)
    counts = ct.merged(held, ct.period_counts(new, by), ct.period_counts(before, by), by).withColumnRenamed("period_start", "month")
    rows = held.count() + 2 * new.count()  # a day's row has a time and a rank; both tables are stored, so files' footers tell
    _by_month(counts, -(-rows // FILE_ROWS), by).write.partitionBy("month").parquet(f"{base}/layer=months")
    now = {
        "days": {**old_days, **dict.fromkeys(written, folder)},
        "months": {**old_months, **dict.fromkeys(_values(spark, f"{base}/layer=months", "month"), folder)},
    }
    made = versions.commit(spark, path, now, at)
    versions.expire(spark, path, lambda s: sorted({*s.get("days", {}).values(), *s.get("months", {}).values()}), _FOLDER)
    return made


def _by_month(counts: DataFrame, files: int, by: Sequence[str] | None) -> DataFrame:
    """Counts clustered by month and sorted; with several ``files`` a month's players are dealt to as many tasks by range."""
    order = [*keys(by), "name", "kind", "value"]
    if files <= 1:
        return cluster_by_day(counts, ["month"], order=order)
    return counts.repartitionByRange(files, "month", *order).sortWithinPartitions("month", *order)


def _values(spark: SparkSession, path: str, key: str) -> list[str]:
    return [n.removeprefix(f"{key}=") for n in child_names(spark, path) if n.startswith(f"{key}=")]


def read_days(spark: SparkSession, path: str, start: dt.date, end: dt.date, by: Sequence[str] | None = None) -> DataFrame:
    """Canonical rows with ranks ``(by…, name, secs, rnk, date, time)`` of the days ``start`` .. before ``end``; no state is an error."""
    return _days(spark, path, _among(_state(spark, path)["days"], start, end), by).withColumn("time", format_secs("secs"))


def read_counts(
    spark: SparkSession, path: str, as_of: dt.date, period: str = "month", offset: int = 0, by: Sequence[str] | None = None
) -> DataFrame:
    """Counts (:mod:`podium.operators.counts`) of one period: of its days for a week, else of its months."""
    start, end = period_range(as_of, period, offset)
    if period in ("day", "week"):
        return ct.period_counts(read_days(spark, path, start, end, by), by, period)
    return ct.rolled_up(_months(spark, path, _among(_state(spark, path)["months"], start, end), by), period)


def _state(spark: SparkSession, path: str) -> dict:
    at = versions.latest(spark, path)
    if at is None:
        raise FileNotFoundError(f"no counts at {path}; update_counts keeps them")
    return at.state
