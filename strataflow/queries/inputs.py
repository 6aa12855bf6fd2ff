"""Stand-ins for the pipeline's tables, derived from the driver's tables.

The expressions are plain SQL that Spark and the checking engine both run, so the
two sides start from the same rows; everything after them is written twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strataflow.queries.registry import table

# Texts of a measure: missing, a range, a decimal comma, a plain number.
HEIGHT = """CASE WHEN c_custkey % 11 = 0 THEN NULL
     WHEN c_custkey % 7 = 0 THEN concat(cast(40 + c_custkey % 60 AS varchar(9)), '-', cast(42 + c_custkey % 60 AS varchar(9)))
     WHEN c_custkey % 5 = 0 THEN concat(cast(40 + c_custkey % 60 AS varchar(9)), ',5')
     ELSE cast(40 + c_custkey % 60 AS varchar(9)) END"""
# The same with the text of a NaN among them.
HEIGHT_NAN = f"CASE WHEN c_custkey % 13 = 0 THEN 'nan' ELSE {HEIGHT} END"
WEIGHT = """CASE WHEN c_custkey % 17 = 0 THEN NULL
     WHEN c_custkey % 3 = 0 THEN concat(cast(50 + c_custkey % 45 AS varchar(9)), '.5')
     ELSE cast(50 + c_custkey % 45 AS varchar(9)) END"""
MEDAL = """CASE WHEN o_orderkey % 7 = 0 THEN NULL WHEN o_orderkey % 11 = 0 THEN 'None'
     WHEN o_orderkey % 13 = 0 THEN ' NaN ' WHEN o_orderkey % 17 = 0 THEN ''
     ELSE o_orderstatus END"""

FACT_COLUMNS = {
    "athlete_id": "o_custkey",
    "sport": "o_orderpriority",
    "event": "concat('Event #', cast(o_orderkey % 4 AS varchar(9)), ' (', o_orderstatus, ')')",
    "medal": MEDAL,
    "country_noc": "concat('NOC-', cast(o_orderkey % 23 AS varchar(9)))",
}
DIM_COLUMNS = {
    "athlete_id": "c_custkey",
    "name": "c_name",
    "sex": "c_mktsegment",
    "height": HEIGHT,
    "weight": WEIGHT,
    "country_noc": "concat('NATION_', cast(c_nationkey AS varchar(9)))",
}


def _projection(columns: dict[str, str]) -> list[str]:
    return [f"{expression} AS {name}" for name, expression in columns.items()]


def select_sql(columns: dict[str, str], source: str) -> str:
    return f"SELECT {', '.join(_projection(columns))} FROM {source}"


FACT_SQL = select_sql(FACT_COLUMNS, "orders")
DIM_SQL = select_sql(DIM_COLUMNS, "customer")


def results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fact rows: one per order."""
    return table(spark, sf_dir, "orders").selectExpr(*_projection(FACT_COLUMNS))


def athletes(spark: SparkSession, sf_dir: str, **changed: str) -> DataFrame:
    """Dimension rows: one per customer."""
    return table(spark, sf_dir, "customer").selectExpr(*_projection({**DIM_COLUMNS, **changed}))


# Documents with NULLs, empty texts, backslashes and quotes.
TEXT_COLUMNS = {
    "doc_id": "doc_id",
    "body": """CASE WHEN doc_id % 9 = 0 THEN NULL WHEN doc_id % 10 = 0 THEN ''
     ELSE concat(' ', text, chr(92), ' "', source, '" ') END""",
    "lang": "lang",
}
TEXT_SQL = select_sql(TEXT_COLUMNS, "documents")


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").selectExpr(*_projection(TEXT_COLUMNS))
