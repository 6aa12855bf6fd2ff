import time

import pytest
from pyspark.sql import functions as F

from strataflow.functions.jsonrows import decode_rows
from strataflow.operators.averages import group_averages
from strataflow.sinks.snapshots import current_snapshot, read_snapshot
from strataflow.sources.tables import RESULT_MESSAGE_TYPED
from strataflow.streaming.enrich import enrich_stream, running_averages
from strataflow.streaming.run import run_for, start_append, start_batches
from strataflow.streaming.sinks import fan_out, message_file_sink, table_sink
from strataflow.streaming.sources import stream_message_files

GROUPS = ["sport", "sex"]
AVERAGES = {"avg_weight": "weight"}


def put(spark, path, *rows):
    """One file of messages."""
    values = [(str(k), f'{{"athlete_id": {k}, "sport": "{s}"}}') for k, s in rows]
    values.append((None, "not json"))
    df = spark.createDataFrame(values, "key string, value string")
    df.coalesce(1).write.mode("append").parquet(path)


@pytest.fixture
def people(spark):
    return spark.createDataFrame(
        [(1, "F", 60.5), (2, "M", 80.0), (3, "M", None)], "athlete_id int, sex string, weight double"
    )


def stats(spark, path, people, cap=None, hot=()):
    rows = decode_rows(
        stream_message_files(spark, path, cap), RESULT_MESSAGE_TYPED, required="athlete_id"
    ).select("athlete_id", "sport")
    return running_averages(
        enrich_stream(rows, people, "athlete_id", hot=hot), GROUPS, AVERAGES, exact_scale=1
    )


@pytest.mark.parametrize("hot", [(), (2,)])
def test_stream_equals_batch_over_many_batches(spark, tmp_path, people, hot):
    topic, out = str(tmp_path / "in"), str(tmp_path / "out")
    rows = [[(1, "a"), (2, "a")], [(2, "b"), (2, "a"), (3, "a")], [(1, "a"), (9, "a")]]
    for part in rows:
        put(spark, topic, *part)
    query = start_batches(
        stats(spark, topic, people, cap=1, hot=hot), fan_out(table_sink(out)),
        str(tmp_path / "ck"),
    )
    query.awaitTermination()
    assert len([p for p in query.recentProgress if p.numInputRows]) == 3
    flat = spark.createDataFrame([r for part in rows for r in part], "athlete_id int, sport string")
    batch = group_averages(flat.join(people, "athlete_id"), GROUPS, AVERAGES, exact_scale=1)
    result = read_snapshot(spark, out)
    assert sorted(result.select(batch.columns).collect()) == sorted(batch.collect())
    assert result.select("timestamp").distinct().count() == 1
    assert current_snapshot(spark, out) == 2


def test_restart_reads_only_new_messages(spark, tmp_path, people):
    topic, out, ck = (str(tmp_path / n) for n in ("in", "out", "ck"))
    put(spark, topic, (1, "a"), (2, "a"))
    seen = []

    def count_batches(batch, batch_id):
        seen.append(batch_id)

    sinks = fan_out(count_batches, table_sink(out))
    for _ in range(2):
        start_batches(stats(spark, topic, people), sinks, ck).awaitTermination()
    assert seen == [0]
    put(spark, topic, (2, "a"), (2, "b"))
    start_batches(stats(spark, topic, people), sinks, ck).awaitTermination()
    assert seen == [0, 1]
    assert sorted(read_snapshot(spark, out).drop("timestamp").collect()) == [
        ("a", "F", 60.5), ("a", "M", 80.0), ("b", "M", 80.0)
    ]


def test_retried_batch_leaves_one_copy(spark, tmp_path):
    rows, messages = str(tmp_path / "rows"), str(tmp_path / "messages")
    write = fan_out(table_sink(rows), message_file_sink(messages))
    batch = spark.range(5)
    write(batch, 3)
    write(batch, 3)
    assert read_snapshot(spark, rows).count() == 5
    assert read_snapshot(spark, messages, "text").count() == 5


def test_sinks_can_merge_their_files(spark, tmp_path):
    batch = spark.range(0, 8, 1, 8)
    for files, expected in ((None, 8), (2, 2)):
        for make in (table_sink, message_file_sink):
            root = tmp_path / f"{make.__name__}-{files}"
            make(str(root), files=files)(batch, 0)
            assert len(list(root.glob("snapshot=0/part-*"))) == expected


def test_empty_batch_reaches_no_sink(spark):
    called = []
    fan_out(lambda b, i: called.append(i))(spark.range(0), 0)
    assert called == []


def test_batch_is_released_when_a_sink_fails(spark):
    def fail(batch, batch_id):
        raise RuntimeError("sink down")

    batch = spark.range(3)
    with pytest.raises(RuntimeError):
        fan_out(fail)(batch, 0)
    assert not batch.is_cached or batch.storageLevel.useMemory is False


def test_timed_trigger_is_stopped(spark, tmp_path, people):
    topic, out = str(tmp_path / "in"), str(tmp_path / "out")
    put(spark, topic, (1, "a"))
    query = start_batches(
        stats(spark, topic, people), fan_out(table_sink(out)), str(tmp_path / "ck"),
        every="30 seconds",
    )
    started = time.time()
    query.processAllAvailable()
    assert run_for(query, 1) is False
    assert not query.isActive
    assert time.time() - started < 30
    assert read_snapshot(spark, out).count() == 1


def test_one_table_of_a_folder_as_a_stream(spark, tmp_path):
    for name, ids in (("a", 3), ("b", 5)):
        spark.range(ids).coalesce(1).write.parquet(str(tmp_path / "all" / name))
        part = next((tmp_path / "all" / name).glob("part-*.parquet"))
        part.rename(tmp_path / f"{name}.parquet")
    rows = stream_message_files(spark, str(tmp_path), schema="id long", glob="b.parquet")
    start_append(rows, str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 5


def test_append_writes_each_row_once(spark, tmp_path, people):
    topic, out, ck = (str(tmp_path / n) for n in ("in", "out", "ck"))
    for part in ([(1, "a")], [(2, "b"), (7, "b")]):
        put(spark, topic, *part)
        rows = decode_rows(
            stream_message_files(spark, topic), RESULT_MESSAGE_TYPED, required="athlete_id"
        ).select("athlete_id", "sport")
        start_append(enrich_stream(rows, people, "athlete_id"), out, ck).awaitTermination()
    got = spark.read.parquet(out).select("athlete_id", "sport", F.col("sex"))
    assert sorted(got.collect()) == [(1, "a", "F"), (2, "b", "M")]
