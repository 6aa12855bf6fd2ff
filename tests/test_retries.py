"""Tasks that fail once, after part of their output, and run again."""

import pandas as pd
import pytest
from pyspark import TaskContext
from pyspark.sql import functions as F

from strataflow.operators.numbering import number_rows
from strataflow.operators.upsert import upsert_counter
from strataflow.plans.copies import apply_hits, create_if_absent
from strataflow.sinks.layers import append_rows
from strataflow.sinks.snapshots import read_snapshot, write_snapshot
from strataflow.streaming.enrich import enrich_stream
from strataflow.streaming.sinks import fan_out, message_file_sink, table_sink

ROWS = 4_000


@pytest.fixture
def rows(spark, tmp_path):
    path = str(tmp_path / "rows")
    spark.range(ROWS, numPartitions=6).select(
        F.col("id").alias("n"), (F.col("id") % 7).alias("k")
    ).write.parquet(path)

    def once(batches):
        task = TaskContext.get()
        doomed = task.attemptNumber() == 0 and task.partitionId() % 2 == 0
        for batch in batches:
            yield batch.head(len(batch) // 2) if doomed else batch
            if doomed:
                raise RuntimeError("task lost")

    df = spark.read.parquet(path)
    return df.mapInPandas(once, df.schema)


def test_the_fixture_fails_and_recovers(rows):
    assert pd.DataFrame([r.n for r in rows.collect()])[0].nunique() == ROWS


def test_append_and_snapshot(spark, rows, tmp_path):
    append_rows(rows, str(tmp_path / "log"))
    assert spark.read.parquet(str(tmp_path / "log")).count() == ROWS
    write_snapshot(rows, str(tmp_path / "t"))
    assert read_snapshot(spark, str(tmp_path / "t")).agg(F.countDistinct("n")).first()[0] == ROWS


@pytest.mark.parametrize("order, unique", [("k", False), ("n", True)])
def test_numbering(rows, tmp_path, order, unique):
    numbered = number_rows(rows, [order], str(tmp_path / "stage"), unique=unique)
    seen = numbered.agg(
        F.countDistinct("id"), F.min("id"), F.max("id"), F.countDistinct("n")
    ).first()
    assert tuple(seen) == (ROWS, 1, ROWS, ROWS)


def test_counters(spark, rows, tmp_path):
    root = str(tmp_path / "c")
    schema = "id long, k long, count long, created_at timestamp, updated_at timestamp"
    create_if_absent(spark, root, schema)
    apply_hits(rows.select("k"), root, ["k"])
    stored = read_snapshot(spark, root)
    assert sorted(r.id for r in stored.collect()) == list(range(1, 8))
    assert stored.agg(F.sum("count")).first()[0] == ROWS
    raised = upsert_counter(stored, rows.select("k"), ["k"])
    assert raised.agg(F.sum("count")).first()[0] == 2 * ROWS


def test_salted_join(spark, rows):
    dim = spark.range(7).select(F.col("id").alias("k"), F.lit("d").alias("d"))
    joined = enrich_stream(rows, dim, "k", hot=[1, 3], salts=4)
    assert tuple(joined.agg(F.count("*"), F.countDistinct("n")).first()) == (ROWS, ROWS)


def test_fan_out(spark, rows, tmp_path):
    table, messages = str(tmp_path / "t"), str(tmp_path / "m")
    fan_out(table_sink(table), message_file_sink(messages))(rows, 0)
    assert read_snapshot(spark, table).count() == ROWS
    assert read_snapshot(spark, messages, "text").distinct().count() == ROWS
