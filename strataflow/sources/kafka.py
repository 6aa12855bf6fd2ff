"""Kafka topics: the option set shared by readers and writers, and the stream source."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

# The login module named by the Kafka client documentation.
PLAIN_LOGIN = "org.apache.kafka.common.security.plain.PlainLoginModule"


@dataclass(frozen=True)
class KafkaCluster:
    """Brokers, with a user where they ask for SASL/PLAIN."""

    servers: str
    user: str | None = None
    password: str | None = None

    def options(self) -> dict[str, str]:
        found = {"kafka.bootstrap.servers": self.servers}
        if self.user is not None:
            found["kafka.security.protocol"] = "SASL_PLAINTEXT"
            found["kafka.sasl.mechanism"] = "PLAIN"
            found["kafka.sasl.jaas.config"] = (
                f'{PLAIN_LOGIN} required username="{_quoted(self.user)}"'
                f' password="{_quoted(self.password or "")}";'
            )
        return found


def _quoted(text: str) -> str:
    return text.replace("\\", "\\\\").replace('"', '\\"')


def kafka_read_options(
    cluster: KafkaCluster,
    topic: str,
    starting: str = "earliest",
    max_offsets_per_trigger: int | None = None,
) -> dict[str, str]:
    options = {**cluster.options(), "subscribe": topic, "startingOffsets": starting}
    if max_offsets_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return options


def stream_topic(
    spark: SparkSession,
    cluster: KafkaCluster,
    topic: str,
    starting: str = "earliest",
    max_offsets_per_trigger: int | None = None,
) -> DataFrame:
    """Messages of a topic as a stream; needs the Kafka connector on the class path."""
    options = kafka_read_options(cluster, topic, starting, max_offsets_per_trigger)
    return spark.readStream.format("kafka").options(**options).load()
