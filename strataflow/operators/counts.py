"""Counts per category."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def category_count(
    df: DataFrame, column: str, value: str, tag: str = "medal_type", count: str = "count"
) -> DataFrame:
    """One row: the category and how many rows have it, zero included."""
    return (
        df.filter(F.col(column) == F.lit(value))
        .agg(F.count(F.lit(1)).alias(count))
        .select(F.lit(value).alias(tag), count)
    )


def category_count_sql(
    df: DataFrame, column: str, value: str, tag: str = "medal_type", count: str = "count"
) -> DataFrame:
    """``category_count`` as a query with a CTE; names and value are bound, not pasted."""
    rows = df.sparkSession.sql(
        """
        WITH hits AS (
            SELECT count(*) AS n FROM {facts} WHERE IDENTIFIER(:column) = :value
        )
        SELECT :value AS tag, n FROM hits
        """,
        args={"column": column, "value": value},
        facts=df,
    )
    return rows.toDF(tag, count)


def category_counts(
    df: DataFrame,
    column: str,
    values: Sequence[str],
    tag: str = "medal_type",
    count: str = "count",
) -> DataFrame:
    """The count of each listed category from one pass, zero for one that is absent."""
    listed = list(dict.fromkeys(values))
    if not listed:
        raise ValueError("name at least one category")
    wanted = df.sparkSession.range(1).select(
        F.explode(F.array(*[F.lit(v) for v in listed])).alias(tag)
    )
    found = (
        df.filter(F.col(column).isin(*listed))
        .groupBy(F.col(column).alias(tag))
        .agg(F.count(F.lit(1)).alias(count))
    )
    return wanted.join(found, tag, "left").select(
        tag, F.coalesce(count, F.lit(0)).cast("bigint").alias(count)
    )
