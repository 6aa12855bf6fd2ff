"""Category counts appended to a log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow.functions.clock import AsOf, stamp
from strataflow.operators.counts import category_counts
from strataflow.operators.freshness import newest_within_flag
from strataflow.operators.numbering import number_rows
from strataflow.sinks.layers import append_rows
from strataflow.sinks.snapshots import (
    current_snapshot,
    read_snapshot,
    remove_path,
    write_snapshot,
)


def log_counts(
    facts: DataFrame,
    column: str,
    values: Sequence[str],
    log: str,
    as_of: AsOf = None,
    ts_type: str = "timestamp",
) -> None:
    """Append ``(medal_type, count, created_at)`` of each listed category.

    The writer fills ``created_at``, as parquet has no column defaults.
    """
    counts = category_counts(facts, column, values)
    append_rows(counts.withColumn("created_at", stamp(as_of, ts_type)), log)


def log_and_check(
    spark: SparkSession,
    facts: DataFrame,
    column: str,
    values: Sequence[str],
    log: str,
    max_age: int = 30,
    as_of: AsOf = None,
    checked_at: AsOf = None,
    ts_type: str = "timestamp",
) -> DataFrame:
    """``log_counts`` and then whether the log's newest row is recent enough."""
    log_counts(facts, column, values, log, as_of, ts_type)
    return newest_within_flag(spark.read.parquet(log), "created_at", max_age, checked_at)


def _sidecar(log: str) -> str:
    return f"{log.rstrip('/')}_last_id"


def last_id(spark: SparkSession, log: str) -> int:
    """Largest id given out for a log, 0 where the log is absent or empty.

    It is one row beside the log; a log that was filled without it is read once.
    """
    if current_snapshot(spark, _sidecar(log)) is not None:
        return read_snapshot(spark, _sidecar(log)).first()["last"]
    try:
        rows = spark.read.parquet(log)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return 0
    return rows.agg(F.coalesce(F.max("id"), F.lit(0)).alias("last")).first()["last"]


def append_numbered(
    rows: DataFrame, log: str, order_by: Sequence[str], staging: str, unique: bool = False
) -> None:
    """Append rows with ids that go on after the log's last one.

    ``unique`` says that no two rows share their place in the order. The ids are reserved
    beside the log before they are used: a lost job leaves a gap, never an id twice, and
    of two writers at the same time one is refused. ``staging`` is emptied at the end.
    """
    spark = rows.sparkSession
    try:
        before = current_snapshot(spark, _sidecar(log))
        start = last_id(spark, log) + 1
        numbered = number_rows(rows, order_by, staging, start, unique=unique)
        last = spark.createDataFrame([(start + numbered.count() - 1,)], "last long")
        write_snapshot(last, _sidecar(log), after=before if before is not None else -1)
        append_rows(numbered, log)
    finally:
        remove_path(spark, staging)
