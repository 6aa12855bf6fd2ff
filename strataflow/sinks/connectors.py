"""JDBC and Kafka writers."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow.sources.jdbc import JdbcTarget
from strataflow.sources.kafka import KafkaCluster


def jdbc_write_options(target: JdbcTarget, connections: int, batch_size: int) -> dict[str, str]:
    # Spark coalesces to numPartitions, which bounds the connections it opens.
    return {
        **target.options(),
        "numPartitions": str(connections),
        "batchsize": str(batch_size),
    }


def append_jdbc(
    df: DataFrame, target: JdbcTarget, connections: int = 16, batch_size: int = 10_000
) -> None:
    """Append rows to a table. Not idempotent: a retried task may insert again."""
    options = jdbc_write_options(target, connections, batch_size)
    df.write.format("jdbc").options(**options).mode("append").save()


def write_topic(messages: DataFrame, cluster: KafkaCluster, topic: str) -> None:
    """Send ``value`` (and ``key``) columns to a topic."""
    messages.write.format("kafka").options(**cluster.options()).option("topic", topic).save()


def append_jdbc_batch(
    df: DataFrame,
    target: JdbcTarget,
    batch_id: int,
    connections: int = 16,
    batch_size: int = 10_000,
) -> None:
    """Append a whole state of a table, marked with its ``batch_id``.

    Nothing is deleted first, so a failure leaves the states before it readable: the
    table's content is that of its largest complete batch. A batch that is tried again
    may leave rows twice; readers take distinct rows of a batch.
    """
    append_jdbc(df.withColumn("batch_id", F.lit(batch_id)), target, connections, batch_size)


def stage_jdbc(
    df: DataFrame,
    target: JdbcTarget,
    staging: str,
    connections: int = 16,
    batch_size: int = 10_000,
) -> None:
    """Load the rows into the staging table of another; swapping them is one statement there.

    The staging table is emptied first. The table itself is never touched, so it keeps its
    rows whatever happens to the load.
    """
    if staging == target.table:
        raise ValueError("the staging table must be another table")
    spare = replace(target, table=staging)
    options = {**jdbc_write_options(spare, connections, batch_size), "truncate": "true"}
    df.write.format("jdbc").options(**options).mode("overwrite").save()
