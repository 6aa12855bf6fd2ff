"""Connector options and ingest guards; no broker or database is started."""

import pytest
from pyspark.errors import AnalysisException

from strataflow.plans.stream_averages import publish_table
from strataflow.session import scratch_path, scratch_root
from strataflow.sinks.connectors import append_jdbc, jdbc_write_options, append_jdbc_batch, stage_jdbc
from strataflow.sources.files import scan_csv
from strataflow.sources.jdbc import JdbcSplit, JdbcTarget, jdbc_read_options, scan_jdbc, text_ranges
from strataflow.sources.kafka import KafkaCluster, kafka_read_options, stream_topic
from strataflow.sources.tables import UnknownTable, require_table
from strataflow.streaming.sinks import topic_sink

TARGET = JdbcTarget("jdbc:db://host/base", "org.example.Driver", "t", "me", "secret")


def test_kafka_options():
    assert KafkaCluster("h:9092").options() == {"kafka.bootstrap.servers": "h:9092"}
    options = KafkaCluster("h:9092", "me", 'se"cret').options()
    assert options["kafka.security.protocol"] == "SASL_PLAINTEXT"
    assert options["kafka.sasl.mechanism"] == "PLAIN"
    assert options["kafka.sasl.jaas.config"].endswith('username="me" password="se\\"cret";')


def test_kafka_read_options():
    options = kafka_read_options(KafkaCluster("h:9092"), "topic", max_offsets_per_trigger=5000)
    assert options == {
        "kafka.bootstrap.servers": "h:9092",
        "subscribe": "topic",
        "startingOffsets": "earliest",
        "maxOffsetsPerTrigger": "5000",
    }
    assert "maxOffsetsPerTrigger" not in kafka_read_options(KafkaCluster("h"), "topic")


def test_jdbc_read_options():
    plain = jdbc_read_options(TARGET, single_connection=True)
    assert plain["dbtable"] == "t" and plain["password"] == "secret"
    assert "numPartitions" not in plain
    split = jdbc_read_options(TARGET, JdbcSplit("id", "1", "900", 12))
    assert split["partitionColumn"] == "id"
    assert (split["lowerBound"], split["upperBound"], split["numPartitions"]) == ("1", "900", "12")
    assert "user" not in JdbcTarget("u", "d", "t").options()


def test_a_table_through_one_connection_has_to_be_asked_for(spark):
    with pytest.raises(ValueError, match="single_connection"):
        scan_jdbc(spark, TARGET)
    with pytest.raises(ValueError, match="single_connection"):
        jdbc_read_options(TARGET, JdbcSplit("id", "1", "2", 2), single_connection=True)
    with pytest.raises(ValueError, match="another table"):
        stage_jdbc(spark.range(1), TARGET, TARGET.table)


def test_text_ranges_part_every_row(spark):
    rows = spark.createDataFrame([(v,) for v in ("a", "g", "o'x", "p", "z", None)], "name string")
    parts = [rows.filter(p.replace("''", "\\'")) for p in text_ranges("name", ["g", "o'x", "p"])]
    assert [p.count() for p in parts] == [2, 1, 1, 2]
    with pytest.raises(ValueError):
        text_ranges("name", ["p", "g"])


def test_jdbc_write_options():
    options = jdbc_write_options(TARGET, connections=4, batch_size=500)
    assert (options["numPartitions"], options["batchsize"]) == ("4", "500")


def test_jdbc_calls_reach_the_driver_class(spark):
    """No driver is installed, so each call ends where Spark loads it."""
    calls = [
        lambda: scan_jdbc(spark, TARGET, JdbcSplit("id", "1", "900", 12)),
        lambda: scan_jdbc(spark, TARGET, single_connection=True),
        lambda: scan_jdbc(spark, TARGET, text_ranges("name", ["g", "p"])),
        lambda: append_jdbc(spark.range(1), TARGET),
        lambda: append_jdbc_batch(spark.range(1), TARGET, 3),
        lambda: stage_jdbc(spark.range(1), TARGET, "t_staging"),
    ]
    for call in calls:
        with pytest.raises(Exception, match="org.example.Driver"):
            call()


def test_kafka_calls_reach_the_connector(spark):
    """The connector is not installed, so each call ends where Spark looks for it."""
    cluster = KafkaCluster("h:9092")
    calls = [
        lambda: stream_topic(spark, cluster, "in", max_offsets_per_trigger=5000),
        lambda: publish_table(spark.range(1), cluster, "out", key="id"),
        lambda: topic_sink(cluster, "out")(spark.range(1), 0),
    ]
    for call in calls:
        with pytest.raises(AnalysisException, match="kafka"):
            call()


def test_table_registry():
    assert require_table("athlete_bio") == "athlete_bio"
    with pytest.raises(UnknownTable):
        require_table("medals")


def test_csv_guards(spark, tmp_path):
    with pytest.raises(AnalysisException):
        scan_csv(spark, str(tmp_path / "absent"))
    with pytest.raises(ValueError):
        scan_csv(spark, str(tmp_path), types="guess")


def test_scratch_follows_the_cluster_setting(spark):
    assert scratch_root(spark) == spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "a") != scratch_path(spark, "a")
    assert scratch_path(spark, "a").startswith(scratch_root(spark))


class FakeSession:
    """Settings of a session that cannot be started here."""

    def __init__(self, **settings):
        self.conf = self
        self.settings = settings

    def get(self, name, default=None):
        return self.settings.get(name, default)


def test_local_master_gets_one_temporary_folder():
    local = FakeSession(**{"spark.master": "local[2]"})
    local.sparkContext = local
    local.applicationId = "local-test"
    assert scratch_root(local) == scratch_root(local)


def test_cluster_without_a_shared_folder_is_refused():
    with pytest.raises(RuntimeError):
        scratch_root(FakeSession(**{"spark.master": "yarn"}))
    shared = FakeSession(**{"spark.master": "yarn", "spark.checkpoint.dir": "hdfs:///x/"})
    assert scratch_root(shared) == "hdfs:///x"
