"""Readers for stored results and landed leaderboard documents."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from podium import schemas

_FILE_DATE_RE = r"(\d{4}-\d{2}-\d{2})\.json[^/]*$"


def read_results_raw(spark: SparkSession, path: str, fmt: str = "parquet", league: bool = False) -> DataFrame:
    """Stored results with declared types (``submitted_at, name, time, date``).

    Never inferred: CSV exports of a sheet read with the same four types.  A
    ``date=`` partition layout is discovered and pruned on ``date`` filters.
    """
    schema = schemas.RESULTS_RAW
    if league:
        schema = T.StructType([T.StructField("league", T.StringType(), True), *schema.fields])
    reader = spark.read.schema(schema)
    if fmt == "csv":
        return reader.option("header", "true").csv(path)
    return reader.format(fmt).load(path)


def read_results(spark: SparkSession, path: str) -> DataFrame:
    """A canonical results table written by :func:`podium.sources.sinks.overwrite_partitions`."""
    return spark.read.parquet(path)


def read_board(spark: SparkSession, path: str, multi_line: bool = False, by=None) -> DataFrame:
    """Landed leaderboard JSON, one document per puzzle day.

    A document carries ``data`` (the entries) and optionally ``date``; when the
    date is absent it is taken from a ``YYYY-MM-DD.json`` file name, as the
    files are named by day.  League keys (``by``) come from ``league=<value>/``
    folders (partition discovery).
    """
    df = spark.read.schema(schemas.leaderboard_schema(by)).option("multiLine", str(multi_line).lower()).json(path)
    return with_file_date(df)


def landed_files(spark: SparkSession, path: str, since: dt.date | None = None, until: dt.date | None = None) -> DataFrame:
    """path, length and modified of the files under ``path``, from a listing alone: no file is opened.

    With ``since`` / ``until`` (inclusive), files named for another day are left
    out; files whose name has no date are always there.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    files = files.select("path", "length", F.col("modificationTime").alias("modified"))
    day = F.try_to_date(F.regexp_extract("path", _FILE_DATE_RE, 1), "yyyy-MM-dd")
    for bound, inside in ((since, day >= F.lit(since)), (until, day <= F.lit(until))):
        if bound is not None:
            files = files.where(day.isNull() | inside)
    return files


def intake_reader(reader, by=None, multi_line: bool = False):
    """``spark.read`` or ``spark.readStream`` set up for board documents, malformed ones kept whole."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": schemas.CORRUPT, "multiLine": str(multi_line).lower()}
    return reader.schema(schemas.intake_schema(by)).options(**options)


def read_board_files(spark: SparkSession, path: str, files: list[str], by=None, multi_line: bool = False) -> DataFrame:
    """Documents of the given files below ``path``, as :func:`podium.operators.ingest.intake` takes them."""
    plain = [re.sub(r"([\\*?\[\]{}])", r"\\\1", f) for f in files]  # names, not patterns
    return with_file_date(intake_reader(spark.read, by, multi_line).option("basePath", path).json(plain))


def with_file_date(docs: DataFrame) -> DataFrame:
    """Fill a missing document ``date`` from a ``YYYY-MM-DD.json`` file name (batch or stream)."""
    from_name = F.try_to_date(F.regexp_extract(F.col("_metadata.file_name"), _FILE_DATE_RE, 1), "yyyy-MM-dd")
    own = F.col("date") if docs.schema["date"].dataType == T.DateType() else F.try_to_date(F.col("date"), "yyyy-MM-dd")
    return docs.withColumn("date", F.coalesce(own, from_name))


def parse_board_text(text_df: DataFrame, column: str = "value") -> DataFrame:
    """Leaderboard documents held as JSON text (e.g. an HTTP response body table)."""
    parsed = F.from_json(F.col(column), schemas.LEADERBOARD)
    return text_df.select(parsed.alias("doc")).select("doc.*")
