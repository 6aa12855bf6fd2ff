"""Streaming queries: the events, published as JSON messages, worked off as a stream."""

from __future__ import annotations

from datetime import datetime
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow.functions.jsonrows import decode_rows
from strataflow.functions.measures import to_measure
from strataflow.operators.cleaning import map_columns
from strataflow.plans.stream_averages import enriched_averages, start_averages
from strataflow.queries.inputs import DIM_COLUMNS, athletes
from strataflow.queries.registry import query, table
from strataflow.session import scratch_path
from strataflow.sinks.snapshots import read_snapshot
from strataflow.streaming.enrich import enrich_stream, hot_keys
from strataflow.streaming.run import start_append
from strataflow.streaming.sinks import message_file_sink, table_sink
from strataflow.streaming.sources import stream_message_files

AS_OF = datetime(2024, 2, 1)
HALF = "2024-01-16"
ROW = "athlete_id bigint, sport string, medal string, result_id bigint, country_noc string"
GROUPS = ("sport", "medal", "sex", "country_noc")
AVERAGES = {"avg_weight": "weight", "avg_balance": "balance"}

MESSAGE_COLUMNS = {
    "athlete_id": "user_id",
    "sport": "event_type",
    "medal": """CASE event_id % 5 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN 'None'
        WHEN 3 THEN 'Gold' ELSE 'Silver' END""",
    "result_id": "event_id",
    "country_noc": "concat('NOC-', cast(event_id % 7 AS varchar(9)))",
}
# A few measures are no finite numbers.
BALANCE = """CASE WHEN c_custkey % 211 = 5 THEN cast('NaN' AS double)
     WHEN c_custkey % 223 = 7 THEN cast('Infinity' AS double) ELSE c_acctbal END"""
_EVENT_SQL = f"""
    SELECT {', '.join(f'{e} AS {n}' for n, e in MESSAGE_COLUMNS.items())}
    FROM events"""
_DIM_SQL = f"""
    SELECT c_custkey AS athlete_id, c_mktsegment AS sex, {BALANCE} AS balance,
           {DIM_COLUMNS['country_noc']} AS country_noc,
           try_cast({DIM_COLUMNS['weight']} AS double) AS weight
    FROM customer"""
_LABEL = "CASE WHEN medal IS NULL OR medal = '' THEN 'No medal' ELSE medal END"
_FINITE = "CASE WHEN isfinite(balance) THEN try_cast(balance AS decimal(18, 2)) END"


def _stats_sql(medal: str = _LABEL, country: str = "d", where: str = "true") -> str:
    return f"""
        SELECT sport, {medal} AS medal, sex, {country}.country_noc,
               cast(sum(cast(weight AS decimal(18, 2))) AS double) / count(weight) AS avg_weight,
               CASE WHEN NOT coalesce(bool_or(NOT isfinite(balance)), false)
                    THEN cast(sum({_FINITE}) AS double) / count({_FINITE}) END AS avg_balance,
               coalesce(bool_or(NOT isfinite(balance)), false) AS poisoned
        FROM ({_EVENT_SQL}) AS f JOIN ({_DIM_SQL}) AS d USING (athlete_id)
        WHERE {where}
        GROUP BY sport, {medal}, sex, {country}.country_noc"""


_STATS_SQL = _stats_sql()


def _told(stats: DataFrame) -> DataFrame:
    """Averages that are not a number as a flag."""
    odd = F.coalesce(F.isnan("avg_balance"), F.lit(False))
    return stats.withColumn("poisoned", odd).withColumn(
        "avg_balance", F.when(~odd, F.col("avg_balance"))
    )


def publish(events: DataFrame, path: str) -> None:
    """Append events to the message files, one folder per week.

    Each error event is followed by a message without a key and one that is no JSON,
    which the decoding has to drop.
    """
    rows = events.selectExpr(*[f"{e} AS {n}" for n, e in MESSAGE_COLUMNS.items()], "ts")
    row, keyless = F.to_json(F.struct(*MESSAGE_COLUMNS)), F.to_json(F.struct("sport"))
    messages = rows.select(
        F.date_trunc("week", "ts").cast("date").alias("week"),
        F.col("athlete_id").cast("string").alias("key"),
        F.explode(
            F.when(F.col("sport") == "error", F.array(row, keyless, F.lit("not json")))
            .otherwise(F.array(row))
        ).alias("value"),
    )
    messages.write.mode("append").partitionBy("week").parquet(path)


def _messages(spark: SparkSession, path: str, cap: int = 2) -> DataFrame:
    """The message files as a stream, ``cap`` files a batch, so that there are several batches."""
    return stream_message_files(spark, path, cap)


def _rows(spark: SparkSession, path: str) -> DataFrame:
    return decode_rows(_messages(spark, path), ROW, required="athlete_id")


def _people(spark: SparkSession, sf_dir: str) -> DataFrame:
    people = athletes(spark, sf_dir, balance=BALANCE)
    return map_columns(people, to_measure, ["weight"]).select(
        "athlete_id", "sex", "country_noc", "weight", "balance"
    )


def _averages(spark: SparkSession, sf_dir: str, path: str, **options: Any) -> DataFrame:
    return enriched_averages(
        _messages(spark, path),
        ROW,
        _people(spark, sf_dir),
        "athlete_id",
        GROUPS,
        AVERAGES,
        exact_scale=2,
        as_of=AS_OF,
        ts_type="timestamp_ntz",
        **{"category": "medal", "shared_from": "dim", **options},
    )


def _published(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_path(spark, "topic")
    publish(table(spark, sf_dir, "events"), path)
    return path


@query("stream_source_json", _EVENT_SQL)
def stream_source_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, rows = scratch_path(spark, "decoded"), _rows(spark, _published(spark, sf_dir))
    start_append(rows, out, scratch_path(spark, "checkpoint")).awaitTermination()
    return spark.read.parquet(out)


@query("stream_enrich", f"""
    SELECT athlete_id, sport, medal, result_id, sex, f.country_noc, weight,
           CASE WHEN isfinite(balance) THEN balance END AS balance
    FROM ({_EVENT_SQL}) AS f JOIN ({_DIM_SQL}) AS d USING (athlete_id)""")
def stream_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The busiest user's rows, if they are a twentieth of all, are dealt out."""
    rows, out = _rows(spark, _published(spark, sf_dir)), scratch_path(spark, "enriched")
    hot = hot_keys(table(spark, sf_dir, "events"), "user_id")
    enriched = enrich_stream(rows, _people(spark, sf_dir), "athlete_id", hot=hot)
    start_append(enriched, out, scratch_path(spark, "checkpoint")).awaitTermination()
    finite = ~F.isnan("balance") & (F.abs("balance") < float("inf"))
    return spark.read.parquet(out).withColumn("balance", F.when(finite, F.col("balance")))


def _finished(spark: SparkSession, stats: DataFrame) -> DataFrame:
    out = scratch_path(spark, "stats")
    start_averages(stats, [table_sink(out)], scratch_path(spark, "checkpoint")).awaitTermination()
    return _told(read_snapshot(spark, out))


def _stamped(sql: str) -> str:
    return f"SELECT *, TIMESTAMP '{AS_OF}' AS \"timestamp\" FROM ({sql})"


@query("stream_avg_complete", _stamped(_STATS_SQL))
def stream_avg_complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _finished(spark, _averages(spark, sf_dir, _published(spark, sf_dir)))


@query("stream_avg_measured_fact", _stamped(_stats_sql("medal", "f", "weight IS NOT NULL")))
def stream_avg_measured_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measured athletes only; the country is that of the result, medals stay as they are."""
    topic = _published(spark, sf_dir)
    stats = _averages(
        spark, sf_dir, topic, measured_only=True, shared_from="fact", category=None
    )
    return _finished(spark, stats)


@query("stream_avg_measured_dim", _stamped(_stats_sql(where="weight IS NOT NULL")))
def stream_avg_measured_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measured athletes only; the country is the athlete's, missing medals are filled."""
    topic = _published(spark, sf_dir)
    return _finished(spark, _averages(spark, sf_dir, topic, measured_only=True))


@query("stream_fanout", f"SELECT *, 2 AS sinks FROM ({_stamped(_STATS_SQL)})")
def stream_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both sinks of the fan-out, time stamp included, matched row by row."""
    stats = _averages(spark, sf_dir, _published(spark, sf_dir))
    rows, messages = scratch_path(spark, "stats"), scratch_path(spark, "stats-topic")
    sinks = [table_sink(rows), message_file_sink(messages)]
    start_averages(stats, sinks, scratch_path(spark, "checkpoint")).awaitTermination()
    stored = read_snapshot(spark, rows)
    sent = decode_rows(read_snapshot(spark, messages, "text"), stored.schema)
    return _told(
        stored.unionByName(sent)
        .groupBy(*stored.columns)
        .agg(F.count(F.lit(1)).cast("int").alias("sinks"))
    )


@query("stream_resume", _stamped(_STATS_SQL))
def stream_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three starts on one checkpoint: half of the messages, the other half, nothing new."""
    events, topic = table(spark, sf_dir, "events"), scratch_path(spark, "topic")
    out, checkpoint = scratch_path(spark, "stats"), scratch_path(spark, "checkpoint")
    early = F.col("ts") < F.lit(HALF).cast("timestamp_ntz")
    for part in (early, ~early, None):
        if part is not None:
            publish(events.filter(part), topic)
        stats = _averages(spark, sf_dir, topic)
        start_averages(stats, [table_sink(out)], checkpoint).awaitTermination()
    return _told(read_snapshot(spark, out))
