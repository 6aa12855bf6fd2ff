"""Recency checks over the events."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from strataflow.operators import freshness
from strataflow.queries.registry import query, table

AS_OF = datetime(2024, 1, 31)
MIDDLE = datetime(2024, 1, 15, 12)
HOUR, DAY = 3_600, 86_400

_AGE = f"date_sub('second', max(ts), TIMESTAMP '{AS_OF}')"


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


@query("freshness_max_age", f"SELECT {_AGE} <= 30 AS is_fresh FROM events")
def freshness_max_age(spark: SparkSession, sf_dir: str) -> DataFrame:
    return freshness.newest_within(_events(spark, sf_dir), "ts", 30, AS_OF)


@query(
    "freshness_case",
    f"""SELECT CASE WHEN max(ts) IS NOT NULL AND {_AGE} <= {HOUR} THEN 1 ELSE 0 END AS is_fresh
        FROM events""",
)
def freshness_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    return freshness.newest_within_flag(_events(spark, sf_dir), "ts", HOUR, AS_OF)


@query(
    "freshness_strict",
    f"""SELECT CASE WHEN max(ts) > TIMESTAMP '{AS_OF}' - INTERVAL {HOUR} SECOND
                    THEN 1 ELSE 0 END AS is_fresh
        FROM events""",
)
def freshness_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return freshness.newest_strictly_within(_events(spark, sf_dir), "ts", HOUR, AS_OF)


@query(
    "freshness_recent_count",
    f"""SELECT count(*) AS recent_rows FROM events
        WHERE ts >= TIMESTAMP '{MIDDLE}' - INTERVAL {DAY} SECOND""",
)
def freshness_recent_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return freshness.recent_count(_events(spark, sf_dir), "ts", DAY, MIDDLE)


@query(
    "freshness_exists",
    f"""SELECT 1 AS found FROM events
        WHERE ts >= TIMESTAMP '{AS_OF}' - INTERVAL {HOUR} SECOND LIMIT 1""",
)
def freshness_exists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return freshness.any_recent(_events(spark, sf_dir), "ts", HOUR, AS_OF)


@query(
    "freshness_exists_whole_seconds",
    f"""SELECT 1 AS found FROM events
        WHERE date_sub('second', ts, TIMESTAMP '{AS_OF}') <= {HOUR} LIMIT 1""",
)
def freshness_exists_whole_seconds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return freshness.any_recent(_events(spark, sf_dir), "ts", HOUR, AS_OF, whole_seconds=True)


@query(
    "freshness_latest_row",
    f"""SELECT event_id, ts, user_id, event_type, value, props FROM events
        WHERE ts >= TIMESTAMP '{AS_OF}' - INTERVAL {DAY} SECOND
        ORDER BY ts DESC, event_id DESC LIMIT 1""",
)
def freshness_latest_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    return freshness.latest_recent_row(_events(spark, sf_dir), "ts", DAY, "event_id", AS_OF)
