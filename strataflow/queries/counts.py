"""Category counts and their log."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow.operators.counts import category_count, category_count_sql, category_counts
from strataflow.operators.reconcile import count_mismatch
from strataflow.plans.count_log import append_numbered, log_and_check, log_counts
from strataflow.queries.registry import query, table
from strataflow.session import scratch_path

STATUSES = ("F", "O", "P", "X")
FIRST, SECOND = datetime(2024, 2, 1, 12), datetime(2024, 2, 1, 12, 0, 20)
CHECKED = datetime(2024, 2, 1, 12, 0, 50, 900_000)
NTZ = {"ts_type": "timestamp_ntz"}

_STATUS_COUNTS = """
    SELECT s.medal_type, count(o_orderkey) AS count
    FROM (SELECT unnest(['F', 'O', 'P', 'X']) AS medal_type) AS s
    LEFT JOIN orders ON o_orderstatus = s.medal_type GROUP BY s.medal_type"""


@query(
    "category_count_one",
    "SELECT 'F' AS medal_type, count(*) AS count FROM orders WHERE o_orderstatus = 'F'",
)
def category_count_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    return category_count(table(spark, sf_dir, "orders"), "o_orderstatus", "F")


@query("category_count_cte", """
    WITH hits AS (SELECT count(*) AS n FROM orders WHERE o_orderstatus = 'P')
    SELECT 'P' AS medal_type, n AS count FROM hits""")
def category_count_cte(spark: SparkSession, sf_dir: str) -> DataFrame:
    return category_count_sql(table(spark, sf_dir, "orders"), "o_orderstatus", "P")


@query("category_count_all", _STATUS_COUNTS)
def category_count_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return category_counts(table(spark, sf_dir, "orders"), "o_orderstatus", STATUSES)


@query("category_count_log", f"""
    SELECT *, TIMESTAMP '{FIRST}' AS created_at FROM ({_STATUS_COUNTS})
    UNION ALL SELECT *, TIMESTAMP '{SECOND}' FROM ({_STATUS_COUNTS})""")
def category_count_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, log = table(spark, sf_dir, "orders"), scratch_path(spark, "count-log")
    log_counts(orders, "o_orderstatus", STATUSES, log, FIRST, **NTZ)
    log_counts(orders, "o_orderstatus", STATUSES, log, SECOND, **NTZ)
    return spark.read.parquet(log)


@query("category_count_log_fresh", f"""
    SELECT CASE WHEN count(*) > 0
                 AND date_sub('second', TIMESTAMP '{SECOND}', TIMESTAMP '{CHECKED}') <= 30
                THEN 1 ELSE 0 END AS is_fresh
    FROM orders""")
def category_count_log_fresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = scratch_path(spark, "count-log")
    return log_and_check(
        spark,
        table(spark, sf_dir, "orders"),
        "o_orderstatus",
        STATUSES,
        log,
        as_of=SECOND,
        checked_at=CHECKED,
        **NTZ,
    )


_DAY_COUNTS = """
    SELECT {category} AS medal_type, count(*) AS count, date_trunc('day', {ts}) AS created_at
    FROM {source} GROUP BY {category}, date_trunc('day', {ts})"""
_ORDER_DAYS = _DAY_COUNTS.format(category="o_orderstatus", ts="o_orderdate", source="orders")
_EVENT_DAYS = _DAY_COUNTS.format(category="event_type", ts="ts", source="events")
_NUMBER = "row_number() OVER (ORDER BY created_at, medal_type)"


def _day_counts(df: DataFrame, category: str, ts: str) -> DataFrame:
    # date_trunc answers in the zoned type; by way of a date it stays zone-less.
    day = F.col(ts).cast("date").cast("timestamp_ntz")
    return df.groupBy(F.col(category).alias("medal_type"), day.alias("created_at")).agg(
        F.count(F.lit(1)).alias("count")
    )


@query("log_with_ids", f"""
    SELECT {_NUMBER} AS id, medal_type, count, created_at FROM ({_ORDER_DAYS})
    UNION ALL
    SELECT {_NUMBER} + (SELECT count(*) FROM ({_ORDER_DAYS})), medal_type, count, created_at
    FROM ({_EVENT_DAYS})""")
def log_with_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two appends of daily counts; the second goes on where the first ended."""
    log, order = scratch_path(spark, "numbered-log"), ("created_at", "medal_type")
    for name, category, ts in (("orders", "o_orderstatus", "o_orderdate"),
                               ("events", "event_type", "ts")):
        rows = _day_counts(table(spark, sf_dir, name), category, ts)
        append_numbered(rows, log, order, scratch_path(spark, "numbering"), unique=True)
    return spark.read.parquet(log)


@query("log_rows_numbered", """
    SELECT row_number() OVER (ORDER BY ts, event_id) AS id, event_id, event_type AS medal_type,
           ts AS created_at
    FROM events""")
def log_rows_numbered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a log row with an id in time order."""
    log = scratch_path(spark, "numbered-log")
    rows = table(spark, sf_dir, "events").select(
        "event_id", F.col("event_type").alias("medal_type"), F.col("ts").alias("created_at")
    )
    order = ("created_at", "event_id")
    append_numbered(rows, log, order, scratch_path(spark, "numbering"), unique=True)
    return spark.read.parquet(log)


@query(
    "log_listing",
    "SELECT event_id AS id, event_type AS medal_type, ts AS created_at FROM events"
    " ORDER BY event_id",
)
def log_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"),
        F.col("event_type").alias("medal_type"),
        F.col("ts").alias("created_at"),
    )
    return rows.orderBy("id")


@query("copy_count_mismatch", """
    SELECT nrows_copy, nrows_original, nrows_copy <> nrows_original AS differs
    FROM (SELECT count(*) AS nrows_copy FROM orders) AS c
    CROSS JOIN (SELECT count(*) AS nrows_original FROM lineitem) AS o""")
def copy_count_mismatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_mismatch(table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders"))
