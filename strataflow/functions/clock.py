"""Processing time, ages and recency."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

AsOf = datetime | Column | None


def stamp(as_of: AsOf = None, ts_type: str = "timestamp") -> Column:
    """Processing time: the given moment, or the query's (micro-batch's) own."""
    if as_of is None:
        moment = F.current_timestamp()
    elif isinstance(as_of, Column):
        moment = as_of
    elif as_of.tzinfo is None:
        moment = F.lit(as_of.isoformat(sep=" ")).cast("timestamp_ntz")
    else:
        moment = F.lit(as_of)
    return moment.cast(ts_type)


def seconds(amount: float) -> Column:
    """Interval of ``amount`` seconds."""
    return F.make_dt_interval(secs=F.lit(amount).cast("decimal(18,6)"))


def whole_seconds_between(earlier: Column, later: Column) -> Column:
    """Seconds from ``earlier`` to ``later``, cut towards zero.

    Built on timestamp subtraction, which serves both timestamp types; a
    zone-less time is not pushed through the session zone and its clock changes.
    """
    return (later - earlier).cast("interval second").cast("bigint")


def at_most_whole_seconds_old(moment: Column, now: Column, limit: int) -> Column:
    """``whole_seconds_between(moment, now) <= limit``, as a pushable comparison.

    Cutting the fraction lets through everything younger than ``limit + 1``.
    """
    return moment > now - seconds(limit + 1)
