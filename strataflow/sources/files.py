"""File scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def scan_csv(
    spark: SparkSession,
    path: str,
    types: str | StructType = "strings",
    separator: str = ",",
    **options: str,
) -> DataFrame:
    """CSV with a header line.

    ``types``: ``strings`` keeps every column text in a single pass; ``infer``
    reads the data once more to find types; a schema gives typed columns without
    that pass and is the choice for large input. A missing path raises Spark's
    own ``AnalysisException``.
    """
    reader = spark.read.option("header", True).option("sep", separator).options(**options)
    if isinstance(types, StructType):
        reader = reader.schema(types)
    elif types == "infer":
        reader = reader.option("inferSchema", True)
    elif types != "strings":
        raise ValueError(f"types must be 'strings', 'infer' or a schema, got {types!r}")
    return reader.csv(path)


def scan_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Parquet table; filters and pruned columns reach the scan."""
    return spark.read.parquet(path)
