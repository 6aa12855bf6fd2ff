"""Measure conversion, labels and scalar functions."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow.functions.clock import stamp, whole_seconds_between
from strataflow.functions.labels import MISSING_WORDS, fill_label
from strataflow.functions.measures import to_measure
from strataflow.functions.parity import parity_power
from strataflow.operators.cleaning import map_columns, measured_rows
from strataflow.queries.inputs import DIM_SQL, FACT_SQL, HEIGHT_NAN, athletes, results
from strataflow.queries.registry import query, table

AS_OF = datetime(2024, 2, 1)

_RAW = f"SELECT c_custkey AS athlete_id, {HEIGHT_NAN} AS raw FROM customer"


def _converted(spark: SparkSession, sf_dir: str, measure: Column) -> DataFrame:
    """The measure, with NaN shown as a flag since engines compare it differently."""
    rows = athletes(spark, sf_dir, height=HEIGHT_NAN).select(
        "athlete_id", F.col("height").alias("raw")
    )
    rows = rows.withColumn("measure", measure)
    return rows.select(
        "athlete_id",
        "raw",
        F.coalesce(F.isnan("measure"), F.lit(False)).alias("is_nan"),
        F.when(~F.isnan("measure"), F.col("measure")).alias("measure"),
    )


def _converted_sql(measure: str) -> str:
    return f"""
        SELECT athlete_id, raw, coalesce(isnan(m), false) AS is_nan,
               CASE WHEN NOT isnan(m) THEN m END AS measure
        FROM (SELECT *, {measure} AS m FROM ({_RAW}))"""


@query("measure_try_double", _converted_sql("try_cast(raw AS double)"))
def measure_try_double(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _converted(spark, sf_dir, to_measure(F.col("raw")))


@query("measure_try_float", _converted_sql("try_cast(raw AS float)"))
def measure_try_float(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _converted(spark, sf_dir, to_measure(F.col("raw"), "float"))


@query(
    "measure_decimal_comma", _converted_sql("try_cast(replace(raw, ',', '.') AS double)")
)
def measure_decimal_comma(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _converted(spark, sf_dir, to_measure(F.col("raw"), decimal_comma=True))


@query(
    "measure_try_int",
    f"""SELECT athlete_id, raw,
               try_cast(trunc(try_cast(replace(raw, ',', '.') AS double)) AS integer) AS measure
        FROM ({_RAW})""",
)
def measure_try_int(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = athletes(spark, sf_dir, height=HEIGHT_NAN)
    return rows.select(
        "athlete_id",
        F.col("height").alias("raw"),
        to_measure(F.col("height"), "int", decimal_comma=True).alias("measure"),
    )


@query(
    "measured_only",
    f"""SELECT athlete_id, sex, height, weight FROM (
            SELECT athlete_id, sex, try_cast(height AS double) AS height,
                   try_cast(weight AS double) AS weight
            FROM ({DIM_SQL}))
        WHERE height IS NOT NULL AND weight IS NOT NULL""",
)
def measured_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = athletes(spark, sf_dir).select("athlete_id", "sex", "height", "weight")
    numbers = map_columns(rows, to_measure, ["height", "weight"])
    return measured_rows(numbers, "height", "weight")


@query(
    "label_missing_basic",
    f"""SELECT athlete_id, sport, event, country_noc,
               CASE WHEN medal IS NULL OR medal = '' THEN 'No medal' ELSE medal END AS medal
        FROM ({FACT_SQL})""",
)
def label_missing_basic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return results(spark, sf_dir).withColumn("medal", fill_label(F.col("medal")))


@query(
    "label_missing_sentinels",
    f"""SELECT athlete_id, sport, event, country_noc,
               CASE WHEN medal IS NULL OR lower(trim(medal)) IN ('nan', 'none', 'null', '')
                    THEN 'No medal' ELSE medal END AS medal
        FROM ({FACT_SQL})""",
)
def label_missing_sentinels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return results(spark, sf_dir).withColumn(
        "medal", fill_label(F.col("medal"), sentinels=MISSING_WORDS)
    )


@query(
    "stamp_as_of",
    f"SELECT athlete_id, sport, TIMESTAMP '{AS_OF}' AS processed_at FROM ({FACT_SQL})",
)
def stamp_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return results(spark, sf_dir).select(
        "athlete_id", "sport", stamp(AS_OF, "timestamp_ntz").alias("processed_at")
    )


@query(
    "event_age_seconds",
    f"SELECT event_id, date_sub('second', ts, TIMESTAMP '{AS_OF}') AS age_seconds FROM events",
)
def event_age_seconds(spark: SparkSession, sf_dir: str) -> DataFrame:
    now = stamp(AS_OF, "timestamp_ntz")
    return table(spark, sf_dir, "events").select(
        "event_id", whole_seconds_between(F.col("ts"), now).alias("age_seconds")
    )


@query(
    "parity_power",
    """SELECT p_partkey, p_size,
              CASE WHEN p_size % 2 = 0 THEN p_size * p_size
                   ELSE p_size * p_size * p_size END AS power
       FROM part""",
)
def parity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        "p_partkey", "p_size", parity_power(F.col("p_size")).alias("power")
    )
