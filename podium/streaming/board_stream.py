"""Incremental ingest of landed leaderboard files with Structured Streaming.

``readStream`` of the board JSON -> entries -> ``foreachBatch`` that drops
repeats within the batch and appends only rows the table does not hold yet;
what is no result goes to the table's rejects, with the reason.
The anti-join inside the batch makes a replayed batch (after a failure, the
sink is at-least-once) add nothing, and the stored side is restricted to the
batch's days, which prunes ``date`` partitions.

The stream keeps no state: a watermark-based dedupe would bound its state but
silently drop boards older than the watermark (a backfill, a late poll); the
stored table is the dedupe state instead.  Ranking is not done on the stream:
it is a batch job over the touched days.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from podium.operators.ingest import intake
from podium.plans.jobs import append_new_rows
from podium.session import scratch_path
from podium.sources.tables import intake_reader, with_file_date


def start_board_stream(
    spark: SparkSession,
    board_dir: str,
    table_path: str,
    checkpoint: str,
    by: Sequence[str] | None = None,
    available_now: bool = True,
    max_files_per_trigger: int | None = None,
):
    """Start the ingest stream; returns the ``StreamingQuery``."""
    reader = intake_reader(spark.readStream, by)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    flat = intake(with_file_date(reader.json(board_dir)), by)
    writer = (
        flat.writeStream.foreachBatch(lambda b, _epoch: append_new_rows(b, table_path, by))
        .option("checkpointLocation", checkpoint)
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def stream_board_fixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land the ``events`` board as JSON files, stream them in, return the stored rows."""
    from podium.sources import fixtures

    landing = scratch_path(spark, "board-landing")
    table = scratch_path(spark, "board-results")
    ckpt = scratch_path(spark, "board-stream-ckpt")
    fixtures.board_docs(spark, sf_dir).write.mode("overwrite").json(landing)
    q = start_board_stream(spark, landing, table, ckpt)
    q.awaitTermination()
    return spark.read.parquet(table).select("date", "name", "secs")
