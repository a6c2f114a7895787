"""Declared schemas of the stored and landed data."""

from __future__ import annotations

from pyspark.sql import types as T

# Stored results as they arrive from a submission sheet: local wall-clock timestamp, name, m:ss text, date.
RESULTS_RAW = T.StructType(
    [
        T.StructField("submitted_at", T.TimestampNTZType(), True),
        T.StructField("name", T.StringType(), True),
        T.StructField("time", T.StringType(), True),
        T.StructField("date", T.DateType(), True),
    ]
)

# Canonical results: one row per (by…, name, date).
RESULTS = T.StructType(
    [
        T.StructField("name", T.StringType(), True),
        T.StructField("date", T.DateType(), True),
        T.StructField("secs", T.IntegerType(), True),
        T.StructField("time", T.StringType(), True),
    ]
)

_SCORE = T.StructType([T.StructField("secondsSpentSolving", T.LongType(), True)])
_ENTRY = T.StructType(
    [
        T.StructField("userID", T.LongType(), True),
        T.StructField("name", T.StringType(), True),
        T.StructField("rank", T.StringType(), True),
        T.StructField("me", T.BooleanType(), True),
        T.StructField("score", _SCORE, True),
    ]
)

# One leaderboard document (one landed JSON file per puzzle day).
LEADERBOARD = T.StructType(
    [
        T.StructField("date", T.DateType(), True),
        T.StructField("data", T.ArrayType(_ENTRY, True), True),
    ]
)

#: malformed documents are kept whole in this column
CORRUPT = "_corrupt"

# A landed document as ingest reads it: every value as text, so that one bad value does not spoil the document.
_INTAKE_ENTRY = T.StructType(
    [
        T.StructField("name", T.StringType(), True),
        T.StructField("score", T.StructType([T.StructField("secondsSpentSolving", T.StringType(), True)]), True),
    ]
)


def intake_schema(by=None) -> T.StructType:
    """The board document as text values, with the malformed ones, plus league keys from the folders."""
    fields = [
        T.StructField("date", T.StringType(), True),
        T.StructField("data", T.ArrayType(_INTAKE_ENTRY, True), True),
        T.StructField(CORRUPT, T.StringType(), True),
    ]
    return T.StructType([*fields, *[T.StructField(k, T.StringType(), True) for k in (by or [])]])


def leaderboard_schema(by=None) -> T.StructType:
    """The board document schema plus league keys, filled from ``league=<value>/`` folder names."""
    return T.StructType([*LEADERBOARD.fields, *[T.StructField(k, T.StringType(), True) for k in (by or [])]])


STREAKS = T.StructType(
    [
        T.StructField("name", T.StringType(), True),
        T.StructField("date", T.DateType(), True),
        T.StructField("streak", T.LongType(), True),
    ]
)
