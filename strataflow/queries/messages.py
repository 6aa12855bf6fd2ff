"""JSON messages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow.functions.jsonrows import decode_rows, encode_rows
from strataflow.queries.registry import query, table

COLUMNS = ("event_id", "ts", "user_id", "event_type", "value", "props")
_TIME = "strftime(ts, '%Y-%m-%dT%H:%M:%S.%f')"
_FIELDS = ", ".join(f"'{c}': {_TIME if c == 'ts' else c}" for c in COLUMNS)
_JSON = f"to_json({{{_FIELDS}}})"


@query("json_encode_rows", f"SELECT cast({_JSON} AS varchar) AS value FROM events")
def json_encode_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_rows(table(spark, sf_dir, "events"))


@query(
    "json_encode_keyed",
    f"SELECT cast(user_id AS varchar) AS key, cast({_JSON} AS varchar) AS value FROM events",
)
def json_encode_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_rows(table(spark, sf_dir, "events"), key="user_id")


@query("json_decode_rows", """
    SELECT event_id, ts, cast(user_id AS varchar) AS user_id, event_type, value, props
    FROM events""")
def json_decode_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A number can be read as text; the broken message after each error event drops out."""
    events = table(spark, sf_dir, "events")
    messages = encode_rows(events, key="event_type").select(
        F.explode(
            F.when(F.col("key") == "error", F.array("value", F.lit("not json")))
            .otherwise(F.array("value"))
        ).alias("value")
    )
    schema = (
        "event_id bigint, ts timestamp_ntz, user_id string, event_type string, value double,"
        " props string"
    )
    return decode_rows(messages, schema, required="event_id")
