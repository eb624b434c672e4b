"""Starting streams from files and running them to the end of what is there."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ledgerloom.session import scratch_path


def follow_parquet(spark: SparkSession, path: str, schema: T.StructType, max_files: int | None = None) -> DataFrame:
    """Rows of Parquet files as they appear under ``path``; ``max_files`` bounds a micro-batch."""
    reader = spark.readStream.schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def drain(stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Process everything available through ``handle``, then stop. A restart resumes at the checkpoint."""
    query = (
        stream.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def drain_to_files(stream: DataFrame, path: str, checkpoint: str, output_mode: str = "append") -> DataFrame:
    """Process everything available into Parquet files and return them as a table."""
    query = (
        stream.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode(output_mode)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(path)


def new_checkpoint(spark: SparkSession, label: str) -> str:
    return scratch_path(spark, f"{label}-checkpoint")
