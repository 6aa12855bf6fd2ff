"""Rows to JSON messages and back."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


#: Times keep their microseconds; both sides of a topic have to name the same format.
TIMES = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def encode_rows(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    key: str | None = None,
    options: Mapping[str, str] = TIMES,
) -> DataFrame:
    """One ``value`` text per row, with a text ``key`` where a key column is named.

    Equal keys go to one topic partition. NULL fields are left out of the JSON.
    ``options`` are those of Spark's JSON writer.
    """
    value = F.to_json(F.struct(*(columns or df.columns)), dict(options)).alias("value")
    if key is None:
        return df.select(value)
    return df.select(F.col(key).cast("string").alias("key"), value)


def decode_rows(
    messages: DataFrame,
    schema: StructType | str,
    value: str = "value",
    required: str | None = None,
    options: Mapping[str, str] = TIMES,
) -> DataFrame:
    """Columns of the JSON messages; works on batches and streams alike.

    A malformed message decodes to NULLs, so naming a ``required`` column drops it
    together with the rows that lack their key.
    """
    body = F.from_json(F.col(value).cast("string"), schema, dict(options))
    if required is None:
        return messages.select(body.alias("body")).select("body.*")
    # A filter over plain fields would move below the projection and parse every
    # message a second time; it does not move below a generator.
    return messages.select(F.inline(F.array(body))).filter(F.col(required).isNotNull())
