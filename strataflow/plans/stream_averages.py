"""JSON messages -> enrichment -> running averages -> sinks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from strataflow.functions.jsonrows import decode_rows, encode_rows
from strataflow.functions.labels import fill_label
from strataflow.operators.cleaning import measured_rows
from strataflow.sinks.connectors import write_topic
from strataflow.sources.kafka import KafkaCluster
from strataflow.streaming.enrich import enrich_stream, running_averages
from strataflow.streaming.run import start_batches
from strataflow.streaming.sinks import BatchSink, fan_out


def publish_table(df: DataFrame, cluster: KafkaCluster, topic: str, key: str | None = None) -> None:
    """Send every row of a table as a JSON message, keyed where a key is named."""
    write_topic(encode_rows(df, key=key), cluster, topic)


def enriched_averages(
    messages: DataFrame,
    schema: StructType | str,
    dim: DataFrame,
    key: str,
    groups: Sequence[str],
    measures: Mapping[str, str],
    category: str | None = None,
    sentinels: Sequence[str] = (),
    shared_from: str = "fact",
    measured_only: bool = False,
    hot: Sequence[Any] = (),
    **averages: Any,
) -> DataFrame:
    """Averages over a stream of messages, whatever source they come from.

    Messages without a key are dropped. ``category`` names a column whose missing
    labels are filled. ``hot`` keys are dealt out, see ``enrich_stream``. ``averages`` are
    options of ``running_averages``.
    """
    rows = decode_rows(messages, schema, required=key)
    if category is not None:
        rows = rows.withColumn(category, fill_label(F.col(category), sentinels=sentinels))
    if measured_only:
        dim = measured_rows(dim, *measures.values())
    enriched = enrich_stream(rows, dim, key, shared_from, hot)
    return running_averages(enriched, groups, measures, **averages)


def start_averages(
    stats: DataFrame, sinks: Sequence[BatchSink], checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Start the averages into all sinks: once over the backlog, or on a timer."""
    return start_batches(stats, fan_out(*sinks), checkpoint, "complete", every)
