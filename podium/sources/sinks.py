"""Writers: the results table, report messages and the progress marker.

The results table is partitioned by ``date`` and only ever *appended to*: new
rows are, by construction (the anti-join in :func:`podium.operators.ingest.new_rows`),
absent from it, so a rerun after a failure adds nothing twice and no writer
ever overwrites files another job is reading.  Compaction, when wanted, rewrites
touched partitions with dynamic partition overwrite into a fresh path.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def cluster_by_day(df: DataFrame, keys: Sequence[str], files_per_day: int | None = None, order: Sequence[str] = ("secs", "name")) -> DataFrame:
    """Cluster rows by day, so that a day is written to as few files as its size asks for.

    A rebalance on the day: AQE cuts a busy day (or a one-day batch) into
    several writers by size and merges small days into one.  With
    ``files_per_day`` a day is dealt to that many writers by a hash of the name
    instead.
    """
    if files_per_day is None:
        out = df.hint("rebalance", *[F.col(k) for k in keys])
    else:
        out = df.repartition(*[F.col(k) for k in keys], F.pmod(F.xxhash64("name"), F.lit(files_per_day)))
    return out.sortWithinPartitions(*keys, *order)


def append_results(df: DataFrame, path: str, by: Sequence[str] | None = None, files_per_day: int | None = None) -> None:
    """Append rows to the ``date``-partitioned results table (files clustered by day)."""
    keys = [*(by or []), "date"]
    cluster_by_day(df, keys, files_per_day).write.mode("append").partitionBy("date").parquet(path)


def overwrite_partitions(df: DataFrame, path: str, by: Sequence[str] | None = None, files_per_day: int | None = None) -> None:
    """Replace only the ``date`` partitions present in ``df`` (dynamic overwrite), e.g. to compact them.

    ``path`` must not be a table ``df`` reads from: write the compacted days to a
    new path and switch readers to it.
    """
    keys = [*(by or []), "date"]
    (
        cluster_by_day(df, keys, files_per_day)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("date")
        .parquet(path)
    )


def write_messages(messages: DataFrame, path: str, fmt: str = "json", partition_by: Sequence[str] = ("kind", "period_start")) -> None:
    """Report messages (one row per by / period / message / part) for a poster to send in order.

    Written with dynamic partition overwrite on ``(kind, period_start)``: a
    rerun of the same report replaces its own partitions instead of adding a
    second copy, and other reports' partitions are untouched.
    """
    cols = [c for c in partition_by if c in messages.columns]
    (
        messages.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*cols)
        .format(fmt)
        .save(path)
    )


def write_marker(marker: DataFrame, path: str) -> None:
    """Last reported date per league; written after the messages it marks."""
    marker.coalesce(1).write.mode("overwrite").parquet(path)
