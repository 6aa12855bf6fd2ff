"""Recency checks of a table that grows.

Each returns a small frame and starts no polling. They differ on their edges: some
cut the age to whole seconds, one is strict, and an empty table gives NULL, zero
or no row. Row filters compare the bare column, so they reach the parquet scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataflow.functions.clock import (
    AsOf,
    at_most_whole_seconds_old,
    seconds,
    stamp,
)

RESULT = "is_fresh"


def _now(df: DataFrame, ts: str, as_of: AsOf) -> Column:
    return stamp(as_of, df.schema[ts].dataType.simpleString())


def newest_within(df: DataFrame, ts: str, max_age: int, as_of: AsOf = None) -> DataFrame:
    """Is the newest row at most ``max_age`` whole seconds old? NULL for no rows.

    A pushed-down filter finds a recent row and the scan skips the rest; whether there is
    any row with a time is a second look that stops at the first.
    """
    recent = df.filter(at_most_whole_seconds_old(F.col(ts), _now(df, ts, as_of), max_age))
    known = df.filter(F.col(ts).isNotNull()).select(F.lit(False).alias("found")).limit(1)
    either = recent.select(F.lit(True).alias("found")).limit(1).unionByName(known)
    return either.agg(F.max("found").alias(RESULT))


def _flag(rows: DataFrame) -> DataFrame:
    return rows.agg(F.when(F.count(F.lit(1)) > 0, 1).otherwise(0).alias(RESULT))


def newest_within_flag(df: DataFrame, ts: str, max_age: int, as_of: AsOf = None) -> DataFrame:
    """``newest_within`` as 1 or 0, with 0 for no rows.

    The newest row is recent if any row is, and a filter lets the scan skip the rest
    of the table where a maximum would read it.
    """
    now = _now(df, ts, as_of)
    return _flag(df.filter(at_most_whole_seconds_old(F.col(ts), now, max_age)))


def newest_strictly_within(
    df: DataFrame, ts: str, max_age: int, as_of: AsOf = None
) -> DataFrame:
    """Is the newest row younger than ``max_age`` seconds? 1 or 0; no cut, no equality."""
    return _flag(df.filter(F.col(ts) > _now(df, ts, as_of) - seconds(max_age)))


def _recent(df: DataFrame, ts: str, max_age: int, as_of: AsOf) -> DataFrame:
    return df.filter(F.col(ts) >= _now(df, ts, as_of) - seconds(max_age))


def recent_count(df: DataFrame, ts: str, max_age: int, as_of: AsOf = None) -> DataFrame:
    """How many rows are at most ``max_age`` seconds old."""
    return _recent(df, ts, max_age, as_of).agg(F.count(F.lit(1)).alias("recent_rows"))


def any_recent(
    df: DataFrame, ts: str, max_age: int, as_of: AsOf = None, whole_seconds: bool = False
) -> DataFrame:
    """One row if a recent row exists, else none; the scan stops at the first."""
    if whole_seconds:
        rows = df.filter(at_most_whole_seconds_old(F.col(ts), _now(df, ts, as_of), max_age))
    else:
        rows = _recent(df, ts, max_age, as_of)
    return rows.select(F.lit(1).alias("found")).limit(1)


def latest_recent_row(
    df: DataFrame, ts: str, max_age: int, tie: str, as_of: AsOf = None
) -> DataFrame:
    """The newest of the recent rows, if there is one; of several the one with the largest ``tie``."""
    rows = _recent(df, ts, max_age, as_of)
    return rows.orderBy(F.col(ts).desc(), F.col(tie).desc_nulls_last()).limit(1)
