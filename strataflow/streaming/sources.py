"""Stream sources that stand in for a topic."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

MESSAGE = "key string, value string"


def stream_message_files(
    spark: SparkSession,
    path: str,
    files_per_trigger: int | None = None,
    schema: str = MESSAGE,
    glob: str | None = None,
) -> DataFrame:
    """Parquet files of messages as a stream, at most so many files per micro-batch."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    if glob is not None:
        reader = reader.option("pathGlobFilter", glob)
    return reader.parquet(path)
