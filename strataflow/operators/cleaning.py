"""Bronze to silver: text cleaning and removal of copies."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from strataflow.functions.text import clean_text_column, normalise_text_column


def text_columns(df: DataFrame) -> list[str]:
    """Names of the string columns, by type and not by the type's printed name."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]


def map_columns(
    df: DataFrame, change: Callable[[Column], Column], columns: Sequence[str]
) -> DataFrame:
    """``change`` applied to the named columns in one projection, order kept."""
    absent = [c for c in columns if c not in df.columns]
    if absent:
        raise ValueError(f"no such columns: {absent}")
    chosen = set(columns)
    return df.select(
        *[
            change(F.col(f"`{c}`")).alias(c) if c in chosen else F.col(f"`{c}`")
            for c in df.columns
        ]
    )


def clean_text(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    keep_space: bool = False,
    keep_backslash: bool = True,
    trim: bool = False,
    null_policy: str = "keep",
) -> DataFrame:
    """Clean the named columns, by default every string column.

    Lossy for numbers held as text: ``63-65`` becomes ``6365`` and a sign is lost.
    """
    return map_columns(
        df,
        lambda c: clean_text_column(c, keep_space, keep_backslash, trim, null_policy),
        text_columns(df) if columns is None else columns,
    )


def normalise_text(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Trim and lower-case the named columns, by default every string column."""
    return map_columns(
        df, normalise_text_column, text_columns(df) if columns is None else columns
    )


def drop_copies(df: DataFrame) -> DataFrame:
    """Whole-row dedup.

    A grouping without aggregates: each task collapses its own copies before the
    shuffle, so a group of copies sends at most one row per task.
    """
    return df.dropDuplicates()


def measured_rows(df: DataFrame, *measures: str) -> DataFrame:
    """Rows in which no measure is NULL."""
    for name in measures:
        df = df.filter(F.col(name).isNotNull())
    return df
