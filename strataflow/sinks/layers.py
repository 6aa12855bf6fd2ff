"""Parquet layers."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from strataflow.sinks.snapshots import RETAIN, read_snapshot, write_snapshot


def write_layer(df: DataFrame, path: str, retain: float = RETAIN) -> None:
    """Replace the table at ``path`` with a new version, also while ``df`` reads it.

    Until the new version is complete, and if its job is lost, readers have the old one.
    """
    write_snapshot(df, path, retain=retain)


def read_layer(spark: SparkSession, path: str) -> DataFrame:
    """The current version of a layer."""
    return read_snapshot(spark, path)


def append_rows(df: DataFrame, path: str) -> None:
    """Add rows to the table at ``path``, creating it where it is absent."""
    df.write.mode("append").parquet(path)


def write_profiled(df: DataFrame, path: str) -> dict[str, int]:
    """``write_layer`` that also counts rows and filled values in the same job."""
    seen = Observation()
    counts = [F.count(F.lit(1)).alias("rows")]
    counts += [F.count(F.col(f"`{c}`")).alias(f"filled_{c}") for c in df.columns]
    write_layer(df.observe(seen, *counts), path)
    return seen.get
