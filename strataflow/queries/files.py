"""File scans, layers and profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strataflow.plans.medallion import DIMENSION, Recipe, ingest
from strataflow.queries.inputs import DIM_SQL, athletes, select_sql
from strataflow.queries.registry import query, table
from strataflow.session import scratch_path
from strataflow.sinks.layers import read_layer, write_layer, write_profiled
from strataflow.sources.files import scan_csv, scan_parquet


def write_csv(df: DataFrame, path: str, separator: str = ",", **options: str) -> None:
    """Landing files; surrounding spaces are part of a value and stay."""
    (
        df.write.options(**options)
        .option("header", True)
        .option("sep", separator)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


@query("csv_scan_strings", f"""
    SELECT cast(athlete_id AS varchar) AS athlete_id, name, sex, height, weight, country_noc
    FROM ({DIM_SQL})""")
def csv_scan_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "landing")
    write_csv(athletes(spark, sf_dir), path)
    return scan_csv(spark, path)


@query("csv_scan_inferred", f"""
    SELECT cast(athlete_id AS integer) AS athlete_id, name, sex, height,
           cast(weight AS double) AS weight, country_noc
    FROM ({DIM_SQL})""")
def csv_scan_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "landing")
    write_csv(athletes(spark, sf_dir), path, separator=";")
    return scan_csv(spark, path, types="infer", separator=";")


# Quotes, a backslash, a separator and a line break within one value.
QUOTED = {
    "athlete_id": "cast(c_custkey AS varchar(9))",
    "name": "concat(c_name, ' ', chr(34), c_mktsegment, chr(34), chr(92), ',', chr(10), 'next ', chr(34))",
    "sex": "c_mktsegment",
}
QUOTED_CSV = {"multiLine": "true", "escape": '"'}


@query("csv_ingest_quoted", select_sql(QUOTED, "customer"))
def csv_ingest_quoted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values that only the CSV options of a recipe read back whole, from landing to bronze."""
    landing, bronze = scratch_path(spark, "landing"), scratch_path(spark, "bronze")
    columns = [f"{expression} AS {name}" for name, expression in QUOTED.items()]
    write_csv(table(spark, sf_dir, "customer").selectExpr(*columns), landing, escape='"')
    ingest(spark, landing, bronze, DIMENSION, Recipe(csv=QUOTED_CSV))
    return read_layer(spark, bronze)


@query("parquet_scan", "SELECT * FROM orders")
def parquet_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_parquet(spark, f"{sf_dir}/orders.parquet")


@query(
    "parquet_scan_pruned",
    "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_orderstatus = 'F'",
)
def parquet_scan_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two columns and a filter, which reach the scan."""
    orders = scan_parquet(spark, f"{sf_dir}/orders.parquet")
    return orders.select("o_orderkey", "o_custkey", "o_orderstatus").filter("o_orderstatus = 'F'")


@query(
    "bronze_roundtrip",
    "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer",
)
def bronze_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "bronze")
    write_layer(table(spark, sf_dir, "customer"), path)
    write_layer(table(spark, sf_dir, "customer"), path)
    return read_layer(spark, path)


@query("layer_profile", f"""
    SELECT count(*) AS rows, count(athlete_id) AS filled_athlete_id,
           count(name) AS filled_name, count(sex) AS filled_sex,
           count(height) AS filled_height, count(weight) AS filled_weight,
           count(country_noc) AS filled_country_noc
    FROM ({DIM_SQL})""")
def layer_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    profile = write_profiled(athletes(spark, sf_dir), scratch_path(spark, "bronze"))
    return spark.createDataFrame([profile])


@query("layer_preview", """
    SELECT o_orderkey, o_orderdate, o_totalprice FROM orders
    ORDER BY o_orderdate DESC, o_orderkey LIMIT 20""")
def layer_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    return orders.orderBy(orders.o_orderdate.desc(), "o_orderkey").limit(20)
