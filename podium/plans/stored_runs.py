"""The jobs run on stored tables, over the board of the driver's ``events``.

Each function lands files, runs the jobs as the command line would, and returns
what they left behind.  The work happens when the function is called, since the
jobs write tables.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from podium import versions
from podium.functions.calendar import day_in_zone
from podium.functions.timefmt import format_secs
from podium.operators import counts as ct
from podium.operators import ingest as ing
from podium.plans import count_table, jobs
from podium.plans import reports as rp
from podium.session import child_names, delete_path, replace_path, scratch_path
from podium.sources import fixtures as fx
from podium.sources.sinks import append_results, overwrite_partitions, write_marker, write_messages
from podium.sources.tables import read_board, read_results_raw

#: the day polled twice, and the first day of the rewritten partitions
POLLED = dt.date(2024, 1, 19)
REWRITTEN = dt.date(2024, 1, 15)


def land_boards(docs: DataFrame, folder: str) -> str:
    """One ``<date>.json`` per day (the documents themselves carry no date), as the boards are named at their source."""
    spark = docs.sparkSession
    landing = scratch_path(spark, "landing")
    docs.withColumnRenamed("date", "day").repartition("day").write.partitionBy("day").json(landing)
    for day in child_names(spark, landing):  # one folder a day, so bounded by the calendar
        if day.startswith("day="):
            for n, name in enumerate(x for x in child_names(spark, f"{landing}/{day}") if x.startswith("part-")):
                replace_path(spark, f"{landing}/{day}/{name}", f"{folder}/{n}-{day[4:]}.json")
    delete_path(spark, landing)
    return folder


def _mkdir(spark: SparkSession, name: str) -> str:
    path = scratch_path(spark, name)
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(p)
    return path


def _entries(change) -> Column:
    """The documents' entries with ``change(date, entry)`` applied to the score; null drops the entry."""
    return F.filter(F.transform("data", lambda e: change(F.col("date"), e)), lambda e: e.isNotNull())


def _ingested(spark: SparkSession, *polls: DataFrame, table: str | None = None) -> str:
    table = table or scratch_path(spark, "table")
    for docs in polls:
        jobs.run_ingest(spark, land_boards(docs, _mkdir(spark, "boards")), table)
    return table


def board_from_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed files, their dates taken from the files' names, flattened."""
    return ing.flatten_board(read_board(spark, land_boards(fx.board_docs(spark, sf_dir), _mkdir(spark, "boards"))))


def stamped_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as formatted rows stamped with the load date."""
    return ing.format_incoming(board_from_files(spark, sf_dir))


def sheet_from_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The results sheet exported as CSV and read back with declared types."""
    path = scratch_path(spark, "sheet")
    fx.sheet(spark, sf_dir).write.option("header", "true").csv(path)
    return read_results_raw(spark, path, "csv")


def _canonical_board(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = fx.board_flat(spark, sf_dir).where("secs IS NOT NULL")
    return flat.select("name", format_secs("secs").alias("time"), "secs", "date")


def appended_and_overwritten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Results appended, then the partitions from ``REWRITTEN`` on replaced by times one second faster."""
    rows, path = _canonical_board(spark, sf_dir), scratch_path(spark, "results")
    append_results(rows, path)
    faster = rows.where(F.col("date") >= F.lit(REWRITTEN)).withColumn("secs", F.col("secs") - 1).withColumn("time", format_secs("secs"))
    overwrite_partitions(faster, path)
    return spark.read.schema(rows.schema).parquet(path)


def write_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per day of the written table, and how many stand after a slower row of their file."""
    path = scratch_path(spark, "results")
    append_results(_canonical_board(spark, sf_dir), path)
    read = spark.read.parquet(path).select("date", "secs", "_metadata.file_name", F.monotonically_increasing_id().alias("at"))
    slower = F.lag("secs").over(Window.partitionBy("date", "file_name").orderBy("at")) > F.col("secs")
    return read.withColumn("bad", slower.cast("int")).groupBy("date").agg(F.count("*").alias("rows"), F.coalesce(F.sum("bad"), F.lit(0)).alias("out_of_order"))


def messages_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily messages of the board with kind and title, written as JSON and read back."""
    path = scratch_path(spark, "messages")
    write_messages(jobs._kind_messages(rp.daily_message(_canonical_board(spark, sf_dir)), "daily", "date"), path)
    return _messages(spark, path)


def _messages(spark: SparkSession, path: str) -> DataFrame:
    read = spark.read.schema("message int, seq int, section string, page long, text string, title string, kind string, period_start date").json(path)
    return read.select("kind", "period_start", "title", "message", "seq", "section", "page", "text")


def days_in_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events per local day of the league's zone."""
    ts = fx._table(spark, sf_dir, "events").select(day_in_zone(F.col("ts").cast("timestamp")).alias("date"))
    return ts.groupBy("date").agg(F.count("*").alias("events"))


def rejected_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What three ingests of rows, some without a date or a name, keep as rejects."""
    flat = fx.board_flat(spark, sf_dir).where("secs IS NOT NULL")
    lost = F.pmod(F.col("secs"), F.lit(11))
    rows = flat.select(F.when(lost != 1, F.col("name")).alias("name"), "secs", F.when(lost != 0, F.col("date")).alias("date"))
    table = scratch_path(spark, "table")
    for _ in range(3):
        jobs.append_new_rows(rows, table)
    return jobs.read_rejects(spark, table).select("name", "time", "secs", "date")


def classified_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What three polls of boards with one of each fault keep as rejects.

    Users whose id leaves 1 by 11 have no name, those divisible by 13 no readable
    time, documents of ``REWRITTEN`` no date, and for every day one document is cut short.
    """
    docs = fx.board_docs(spark, sf_dir)

    def spoilt(e: Column) -> Column:
        secs = e["score"]["secondsSpentSolving"].cast("string")
        text = F.when(e["userID"] % 13 == 0, F.concat(secs, F.lit("x"))).otherwise(secs)
        return F.struct(F.when(e["userID"] % 11 != 1, e["name"]).alias("name"), F.struct(text.alias("secondsSpentSolving")).alias("score"))

    day = F.when(F.col("date") != F.lit(REWRITTEN), F.col("date"))
    whole = docs.select(F.to_json(F.struct(day.alias("date"), F.transform("data", spoilt).alias("data"))).alias("value"))
    cut = docs.select("date").distinct().select(F.concat(F.lit('{"data": [{"name": "'), F.col("date").cast("string")).alias("value"))
    lines, table = whole.unionByName(cut), scratch_path(spark, "table")
    for _ in range(2):
        boards = scratch_path(spark, "boards")
        lines.write.text(boards)
        jobs.run_ingest(spark, boards, table)
    jobs.run_ingest(spark, boards, table)
    return jobs.read_rejects(spark, table)


def polls_by_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which days two polls of one landing folder took in, with the rows stored for them.

    Between the polls the boards of the day after ``POLLED`` land.
    """
    docs, folder, table = fx.board_docs(spark, sf_dir), _mkdir(spark, "boards"), scratch_path(spark, "table")
    days = []
    for poll, landed in ((1, F.col("date") <= F.lit(POLLED)), (2, F.col("date") == F.lit(POLLED + dt.timedelta(days=1)))):
        land_boards(docs.where(landed), folder)
        days += [(poll, dt.date.fromisoformat(d)) for c in jobs.run_ingest(spark, folder, table) for d in c.state["days"]]
    taken = spark.createDataFrame(days, "poll int, date date")
    return taken.join(jobs.read_stored(spark, table), "date").groupBy("poll", "date").agg(F.count("*").alias("rows"))


def marker_after_crash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What readers of the progress marker find after a writer died at each step, and after the next whole run."""
    rows, path = _canonical_board(spark, sf_dir), scratch_path(spark, "marker")
    jobs.update_marker(spark, rows.where(F.col("date") <= F.lit(POLLED)), path)
    found = [("before", jobs.read_marker(spark, path))]
    folder = versions.new_folder()
    write_marker(ing.progress_marker(rows), f"{path}/{folder}")
    found.append(("table written", jobs.read_marker(spark, path)))
    whole = versions._signed({"table": folder})
    versions._create(spark, versions._file(path, versions.latest(spark, path).number + 1), whole[: len(whole) // 2])
    found.append(("commit cut short", jobs.read_marker(spark, path)))
    jobs.update_marker(spark, rows, path)
    found.append(("next run", jobs.read_marker(spark, path)))
    out = [df.select(F.lit(step).alias("step"), "latest_date") for step, df in found]
    return out[0].unionByName(out[1]).unionByName(out[2]).unionByName(out[3])


def reconciled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored rows a second poll does not show: those whose time it has corrected."""
    docs = fx.board_docs(spark, sf_dir)

    def slower(day, e):
        secs = e["score"]["secondsSpentSolving"]
        return e.withField("score.secondsSpentSolving", F.when(F.pmod(secs, F.lit(7)) == 0, secs + 3).otherwise(secs))

    table = _ingested(spark, docs.withColumn("data", _entries(slower)))
    out, boards = scratch_path(spark, "orphans"), land_boards(docs, _mkdir(spark, "boards"))
    jobs.run_ingest(spark, boards, table)
    jobs.run_reconcile(spark, boards, table, out)
    return spark.read.parquet(out)


def daily_after_second_poll(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The message of the day after ``POLLED``, kept incrementally.

    The first poll of ``POLLED`` lacks everyone of the even ids, the day is
    posted, a second poll brings them in (and so other winners), then the next
    day is ingested and posted from the streak table.
    """
    docs = fx.board_docs(spark, sf_dir)
    part = lambda day, e: F.when((day != F.lit(POLLED)) | (e["userID"] % 2 == 1), e)
    table = _ingested(spark, docs.where(F.col("date") <= F.lit(POLLED)).withColumn("data", _entries(part)))
    streaks, out = scratch_path(spark, "streaks"), scratch_path(spark, "messages")
    jobs.run_daily(spark, table, out, None, POLLED, streak_path=streaks)
    _ingested(spark, docs.where(F.col("date") == F.lit(POLLED)), docs.where(F.col("date") > F.lit(POLLED)), table=table)
    following = POLLED + dt.timedelta(days=1)
    jobs.run_daily(spark, table, out, None, following, streak_path=streaks)
    return _messages(spark, out).where(F.col("period_start") == F.lit(following))


def month_from_streak_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """January's report from a streak table that was kept through ``POLLED`` only, so the rest is filled in."""
    table = _ingested(spark, fx.board_docs(spark, sf_dir))
    streaks, out = scratch_path(spark, "streaks"), scratch_path(spark, "messages")
    jobs.update_streaks(spark, jobs.read_canonical(spark, table), streaks, POLLED, table_path=table)
    jobs.run_period(spark, table, out, "month", dt.date(2024, 2, 10), streak_path=streaks)
    return _messages(spark, out)


def _counted_twice(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """Table and counts: kept while everyone of the even ids is missing on ``POLLED``, then after a poll of that day that brings them in."""
    docs, path = fx.board_docs(spark, sf_dir), scratch_path(spark, "counts")
    part = lambda day, e: F.when((day != F.lit(POLLED)) | (e["userID"] % 2 == 1), e)
    table = _ingested(spark, docs.withColumn("data", _entries(part)))
    jobs.update_counts(spark, table, path)
    _ingested(spark, docs.where(F.col("date") == F.lit(POLLED)), table=table)
    jobs.update_counts(spark, table, path)
    return table, path


def month_from_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """January's report made from the stored counts."""
    table, path = _counted_twice(spark, sf_dir)
    out = scratch_path(spark, "messages")
    jobs.run_period(spark, table, out, "month", dt.date(2024, 2, 10), counts_path=path)
    return _messages(spark, out)


def year_ranks_from_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The year's rank distribution, added up from the stored counts of its months."""
    _, path = _counted_twice(spark, sf_dir)
    return ct.rank_distribution(count_table.read_counts(spark, path, POLLED, "year"))


def year_weekdays_from_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The year's weekday medians, from the stored counts of its months."""
    _, path = _counted_twice(spark, sf_dir)
    return ct.weekday_medians(count_table.read_counts(spark, path, POLLED, "year"))
