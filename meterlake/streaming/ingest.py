"""Arriving raw files, merged into the processed table as they come.

A stateful dedupe would either keep every key for ever or forget old ones. So
each micro-batch reads the days it touches, adds its rows, keeps one row per
key and replaces those days. The survivor depends on row content only; thus a
stream of any number of batches ends in the table that one batch load gives.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.query import StreamingQuery

from meterlake.sinks.merging import merge_delivery
from meterlake.sources.deliveries import headers, read_by_header, with_file
from meterlake.sources.paths import delete


def arriving_csv(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Lines of arriving CSV files with the file they stand in. Headers may differ from file to file."""
    reader = spark.readStream.schema("value string")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return with_file(reader.text(path))


def delivered(batch: DataFrame) -> DataFrame:
    """The readings of the files whose lines are in the batch, each file read by its own header."""
    spark = batch.sparkSession
    files = sorted(row["file"] for row in batch.select("file").distinct().collect())
    return read_by_header(spark, headers(spark, files))


def merge_batch(raw: DataFrame, batch_id: int, target: str, staging: str, lag_mode: str = "elapsed") -> None:
    """Merge one micro-batch into ``target``; the staged copy of the batch before it is no longer needed."""
    merge_delivery(raw, target, staging, batch_id, lag_mode)
    delete(raw.sparkSession, f"{staging.rstrip('/')}/batch-{batch_id - 1}")


def ingest(
    raw_stream: DataFrame,
    target: str,
    checkpoint: str,
    lag_mode: str = "elapsed",
    available_now: bool = True,
    interval: str = "1 minute",
) -> StreamingQuery:
    """Start loading arriving files; by default take what is there and stop.

    Staging lives under the checkpoint, so batch numbers there always belong to
    this stream. At most the last batch stays in it.
    """
    staging = f"{checkpoint.rstrip('/')}/merge"

    def merge(batch: DataFrame, batch_id: int) -> None:
        merge_batch(delivered(batch), batch_id, target, staging, lag_mode)

    writer = raw_stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(merge)
    trigger = {"availableNow": True} if available_now else {"processingTime": interval}
    return writer.trigger(**trigger).start()
