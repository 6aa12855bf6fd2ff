"""Micro-batch sinks and their fan-out."""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame

from strataflow.functions.jsonrows import encode_rows
from strataflow.sinks.connectors import append_jdbc_batch, write_topic
from strataflow.sinks.snapshots import RETAIN, write_snapshot
from strataflow.sources.jdbc import JdbcTarget
from strataflow.sources.kafka import KafkaCluster

BatchSink = Callable[[DataFrame, int], None]


def _merged(batch: DataFrame, files: int | None) -> DataFrame:
    """The batch in at most so many partitions.

    A query with state keeps all its shuffle partitions, and each would write a file
    of its own however few groups there are.
    """
    return batch if files is None else batch.coalesce(files)


def table_sink(root: str, retain: float = RETAIN, files: int | None = None) -> BatchSink:
    """The batch as the current version of a parquet table."""

    def write(batch: DataFrame, batch_id: int) -> None:
        write_snapshot(_merged(batch, files), root, number=batch_id, retain=retain)

    return write


def message_file_sink(root: str, retain: float = RETAIN, files: int | None = None) -> BatchSink:
    """The batch as JSON lines, the file form of a topic."""

    def write(batch: DataFrame, batch_id: int) -> None:
        lines = encode_rows(_merged(batch, files))
        write_snapshot(lines, root, number=batch_id, form="text", retain=retain)

    return write


def topic_sink(cluster: KafkaCluster, topic: str) -> BatchSink:
    """The batch as JSON messages; a retried batch is sent again."""

    def write(batch: DataFrame, batch_id: int) -> None:
        write_topic(encode_rows(batch), cluster, topic)

    return write


def jdbc_sink(target: JdbcTarget) -> BatchSink:
    """The batch as rows of a JDBC table that carry its ``batch_id``.

    Complete mode emits every group each time: the rows of the largest batch are the
    current state, and those of earlier ones can be deleted at leisure.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        append_jdbc_batch(batch, target, batch_id)

    return write


def fan_out(*sinks: BatchSink) -> BatchSink:
    """One ``foreachBatch`` function that feeds every sink.

    The batch is kept while several sinks read it, so the streaming plan runs once; an
    empty batch reaches none of them. Sinks keyed by the batch id stay correct
    when a batch is retried.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        if len(sinks) == 1:
            if not batch.isEmpty():
                sinks[0](batch, batch_id)
            return
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if not batch.isEmpty():
                for sink in sinks:
                    sink(batch, batch_id)
        finally:
            batch.unpersist()

    return write
