"""Leaderboard views derived from the driver's TPC-H-like tables.

The reference has no data of its own; these views give it the shapes it reads
(a results sheet, an incoming board, a nested board document) and grow with the
input tables.  Each has a DuckDB twin in ``__spark_entry__.py``.

- ``results``: one row per player and day, time = fastest order of that day.
  Players are the customers (``player_<custkey>``, 20 s + 1 s per 1000 of order
  value) and, for every even order, eight fast regulars (``regular_<k>``, 20 s +
  1 s per 8000) who take turns by the week, so that there are streaks, broken
  streaks and ties at the top.  Every fifth order falls on New Year's Day, so
  that there are crowded days.  Rows grow with the orders.
- ``league_results``: the same, leagues = market segments; customers with a key
  divisible by 101 have no league and those with a key divisible by 499 no name.
- ``sheet``: raw stored rows, one per order, under ``player_<custkey>``; times
  under a minute are written ``:45`` as a form export does, order keys divisible
  by 503 have no name and those divisible by 509 no readable time.
- ``incoming``: formatted new rows, priorities ``1-URGENT`` and ``2-HIGH``; those
  of ``1-URGENT`` are 7 s faster than the stored ones, so some rows are new.
- ``board_flat`` / ``board_docs``: the board from ``events``; ``error`` events
  are unsolved entries.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from podium.functions.timefmt import format_secs

REGULARS = 8
BOARD_PAGE_USERS = 100


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _customer() -> Column:
    return F.concat(F.lit("player_"), F.col("o_custkey").cast("string"))


def _regular() -> Column:
    """Whether an order is a regular's (see the module's ``results``)."""
    return F.col("o_orderkey") % 2 == 0


def _day() -> Column:
    day = F.col("o_orderdate").cast("date")
    return F.when(F.col("o_orderkey") % 5 == 0, F.trunc(day, "year")).otherwise(day)


def _player(day: Column) -> Column:
    week = F.floor(F.datediff(day, F.lit("1990-01-01").cast("date")) / F.lit(7))
    regular = F.concat(F.lit("regular_"), (week % F.lit(REGULARS)).cast("string"))
    return F.when(_regular(), regular).otherwise(_customer())


def _result_secs() -> Column:
    fast = (F.lit(20) + F.floor(F.col("o_totalprice") / F.lit(8000))).cast("int")
    return F.when(_regular(), fast).otherwise(_order_secs())


def _order_secs() -> Column:
    return (F.lit(20) + F.floor(F.col("o_totalprice") / F.lit(1000))).cast("int")


def results(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _table(spark, sf_dir, "orders")
    return (
        o.select(_player(_day()).alias("name"), _day().alias("date"), _result_secs().alias("s"))
        .groupBy("name", "date")
        .agg(F.min("s").alias("secs"))
        .withColumn("time", format_secs("secs"))
    )


def league_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    c = _table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    return (
        o.join(c, o.o_custkey == c.c_custkey, "inner")
        .select(
            F.when(F.col("o_custkey") % 101 != 0, F.col("c_mktsegment")).alias("league"),
            F.when((F.col("o_custkey") % 499 != 0) | _regular(), _player(_day())).alias("name"),
            _day().alias("date"),
            _result_secs().alias("s"),
        )
        .groupBy("league", "name", "date")
        .agg(F.min("s").alias("secs"))
        .withColumn("time", format_secs("secs"))
    )


def sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _table(spark, sf_dir, "orders")
    s = _order_secs()
    mins = F.floor(s / F.lit(60))
    written = F.concat(
        F.when(mins == 0, F.lit("")).otherwise(mins.cast("string")),
        F.lit(":"),
        F.format_string("%02d", F.pmod(s, F.lit(60))),
    )
    return o.select(
        F.timestamp_add("SECOND", F.pmod(F.col("o_orderkey"), F.lit(86400)).cast("int"), F.col("o_orderdate")).alias(
            "submitted_at"
        ),
        F.when(F.col("o_orderkey") % 503 != 0, _customer()).alias("name"),
        F.when(F.col("o_orderkey") % 509 == 0, F.lit("dnf")).otherwise(written).alias("time"),
        F.col("o_orderdate").cast("date").alias("date"),
    )


def incoming(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _table(spark, sf_dir, "orders").where(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"))
    return o.select(
        _customer().alias("name"),
        format_secs(_order_secs() - F.when(F.col("o_orderpriority") == "1-URGENT", 7).otherwise(0)).alias("time"),
        F.col("o_orderdate").cast("date").alias("date"),
    ).distinct()


def board_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _table(spark, sf_dir, "events")
    solved = F.when(F.col("event_type") != "error", F.lit(10) + F.floor(F.col("value")).cast("int"))
    return (
        e.select(
            F.col("ts").cast("date").alias("date"),
            F.concat(F.lit("player_"), F.col("user_id").cast("string")).alias("name"),
            solved.alias("s"),
        )
        .groupBy("date", "name")
        .agg(F.min("s").alias("secs"))
    )


def board_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The board as nested documents, as a paginated API returns it: one per (day, page of 100 user ids).

    Each document holds at most ``BOARD_PAGE_USERS`` entries however large the
    day is.  Unsolved entries carry no score; ``userID`` is the user id and
    ``rank`` and ``me`` are null.
    """
    e = _table(spark, sf_dir, "events")
    solved = F.when(F.col("event_type") != "error", F.lit(10) + F.floor(F.col("value")).cast("int"))
    flat = (
        e.select(F.col("ts").cast("date").alias("date"), "user_id", solved.alias("s"))
        .groupBy("date", "user_id")
        .agg(F.min("s").alias("secs"))
    )
    entry = F.struct(
        F.col("user_id").alias("userID"),
        F.concat(F.lit("player_"), F.col("user_id").cast("string")).alias("name"),
        F.lit(None).cast("string").alias("rank"),
        F.lit(None).cast("boolean").alias("me"),
        F.struct(F.col("secs").cast("bigint").alias("secondsSpentSolving")).alias("score"),
    )
    page = F.floor(F.col("user_id") / F.lit(BOARD_PAGE_USERS))
    return flat.groupBy("date", page.alias("page")).agg(F.collect_list(entry).alias("data")).drop("page")
