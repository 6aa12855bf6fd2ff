"""Starting and stopping streaming queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from strataflow.streaming.sinks import BatchSink


def start_batches(
    df: DataFrame,
    write: BatchSink,
    checkpoint: str,
    mode: str = "complete",
    every: str | None = None,
) -> StreamingQuery:
    """Feed micro-batches to ``write``.

    Without ``every`` the query works off the backlog, in as many batches as the
    source's rate cap asks for, and ends. ``checkpoint`` is a shared folder: a
    restart goes on after the last finished batch, and the number of shuffle
    partitions of the first start stays with it.
    """
    writer = df.writeStream.foreachBatch(write).outputMode(mode)
    writer = writer.option("checkpointLocation", checkpoint)
    if every is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=every).start()


def start_append(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append the backlog to parquet files, each row once."""
    return (
        df.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def run_for(query: StreamingQuery, limit: float) -> bool:
    """Wait up to ``limit`` seconds, then stop; True if the query ended by itself."""
    try:
        return query.awaitTermination(limit)
    finally:
        query.stop()
