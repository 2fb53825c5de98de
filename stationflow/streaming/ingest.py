"""Append-only ingest of a CSV drop folder."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType


def stream_csv(
    spark: SparkSession, path: str, schema: StructType, files_per_batch: int | None = None
) -> DataFrame:
    """Streams the CSV files of a folder with a header row and declared columns.

    ``files_per_batch`` bounds one micro-batch, so that a first run over years of
    files becomes many restartable batches.
    """
    reader = spark.readStream.format("csv").schema(schema).option("header", True)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def append_available(
    df: DataFrame, path: str, checkpoint: str, partition_by: Sequence[str] = ()
) -> StreamingQuery:
    """Appends what has arrived to a Parquet table, then stops.

    The checkpoint remembers the files taken, so a rerun adds only new ones.
    """
    writer = (
        df.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return writer.start(path)


def drain(df: DataFrame, path: str, checkpoint: str, partition_by: Sequence[str] = ()) -> None:
    """``append_available`` and wait for the end."""
    append_available(df, path, checkpoint, partition_by).awaitTermination()
