"""Known tables and their schemas."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql.types import (
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# Column names of the data model.
RESULT_COLUMNS = (
    "edition",
    "edition_id",
    "country_noc",
    "sport",
    "event",
    "result_id",
    "athlete",
    "athlete_id",
    "pos",
    "medal",
    "isTeamSport",
)
RESULT_NUMBERS = ("edition_id", "result_id", "athlete_id")

RESULT_MESSAGE_TEXT = StructType([StructField(c, StringType()) for c in RESULT_COLUMNS])
RESULT_MESSAGE_TYPED = StructType(
    [
        StructField(c, IntegerType() if c in RESULT_NUMBERS else StringType())
        for c in RESULT_COLUMNS
    ]
)
# Columns and types of the games table, in the order of its definition.
GAMES = StructType(
    [
        StructField("edition", StringType()),
        StructField("edition_id", IntegerType()),
        StructField("edition_url", StringType()),
        StructField("year", IntegerType()),
        StructField("city", StringType()),
        StructField("country_flag_url", StringType()),
        StructField("country_noc", StringType()),
        StructField("start_date", StringType()),
        StructField("end_date", StringType()),
        StructField("competition_date", StringType()),
        StructField("isHeld", StringType()),
    ]
)
CATEGORY_LOG = StructType(
    [
        StructField("id", LongType()),
        StructField("medal_type", StringType()),
        StructField("count", LongType()),
        StructField("created_at", TimestampType()),
    ]
)
COUNTER = StructType(
    [
        StructField("id", LongType()),
        StructField("champion_name", StringType()),
        StructField("sport", StringType()),
        StructField("medal_type", StringType()),
        StructField("count", LongType()),
        StructField("created_at", TimestampType()),
        StructField("updated_at", TimestampType()),
    ]
)

# Tables that the medallion jobs accept.
PIPELINE_TABLES = ("athlete_bio", "athlete_event_results")


class UnknownTable(ValueError):
    """A table name outside the registry."""


def require_table(name: str, known: Collection[str] = PIPELINE_TABLES) -> str:
    """``name`` if the registry has it; raises before any path is touched."""
    if name not in known:
        raise UnknownTable(f"unknown table {name!r}, expected one of {sorted(known)}")
    return name
