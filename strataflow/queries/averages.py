"""Enrichment joins and grouped averages."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow.functions.labels import MISSING_WORDS, fill_label
from strataflow.functions.measures import to_measure
from strataflow.operators.averages import grouped_averages
from strataflow.operators.cleaning import map_columns
from strataflow.operators.enrich import enrich, enrich_on
from strataflow.plans.medallion import GROUPS, KEY, MEASURES
from strataflow.queries.inputs import DIM_SQL, FACT_SQL, HEIGHT_NAN, athletes, results
from strataflow.queries.registry import query

AS_OF = datetime(2024, 2, 1)
CLOCK = {"as_of": AS_OF, "ts_type": "timestamp_ntz"}
# A few measures are no finite numbers.
BALANCE = """CASE WHEN c_custkey % 499 = 3 THEN cast('NaN' AS double)
     WHEN c_custkey % 503 = 4 THEN cast('-Infinity' AS double) ELSE c_acctbal END"""
_FINITE = "CASE WHEN isfinite(balance) THEN try_cast(balance AS decimal(18, 2)) END"

BASIC_LABEL = "CASE WHEN medal IS NULL OR medal = '' THEN 'No medal' ELSE medal END"
SENTINEL_LABEL = (
    "CASE WHEN medal IS NULL OR lower(trim(medal)) IN ('nan', 'none', 'null', '')"
    " THEN 'No medal' ELSE medal END"
)


def _people(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dimension with numbers in place of its measure texts."""
    return map_columns(
        athletes(spark, sf_dir), lambda c: to_measure(c, decimal_comma=True), ["height", "weight"]
    )


def _number(column: str) -> str:
    return f"try_cast(replace({column}, ',', '.') AS double)"


def _sql(
    country: str,
    medal: str = "medal",
    where: str = "true",
    mean: str = "avg({0})",
) -> str:
    return f"""
        SELECT sport, {medal} AS medal, sex, {country}.country_noc,
               {mean.format('weight')} AS avg_weight, {mean.format('height')} AS avg_height,
               TIMESTAMP '{AS_OF}' AS "timestamp"
        FROM ({FACT_SQL}) AS f
        JOIN (SELECT athlete_id, sex, country_noc, {_number('height')} AS height,
                     {_number('weight')} AS weight
              FROM ({DIM_SQL})) AS d USING (athlete_id)
        WHERE {where}
        GROUP BY sport, {medal}, sex, {country}.country_noc"""


_MEASURED = "height IS NOT NULL AND weight IS NOT NULL"


@query("enrich_inner", f"""
    SELECT athlete_id, sport, event, medal, f.country_noc, name, sex, height, weight
    FROM ({FACT_SQL}) AS f JOIN ({DIM_SQL}) AS d USING (athlete_id)""")
def enrich_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich(results(spark, sf_dir), athletes(spark, sf_dir), KEY)


@query("enrich_inner_aliased", f"""
    SELECT f.athlete_id, f.sport, f.medal, f.country_noc AS result_country,
           d.country_noc AS athlete_country, d.sex
    FROM ({FACT_SQL}) AS f JOIN ({DIM_SQL}) AS d ON f.athlete_id = d.athlete_id""")
def enrich_inner_aliased(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich_on(
        results(spark, sf_dir),
        athletes(spark, sf_dir),
        F.col("f.athlete_id") == F.col("d.athlete_id"),
        [
            "f.athlete_id",
            "f.sport",
            "f.medal",
            F.col("f.country_noc").alias("result_country"),
            F.col("d.country_noc").alias("athlete_country"),
            "d.sex",
        ],
    )


@query("avg_stats_results_country", _sql("f"))
def avg_stats_results_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grouped_averages(
        results(spark, sf_dir), _people(spark, sf_dir), KEY, GROUPS, MEASURES, **CLOCK
    )


@query("avg_stats_folded", _sql("f"))
def avg_stats_folded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grouped_averages(
        results(spark, sf_dir),
        _people(spark, sf_dir),
        KEY,
        GROUPS,
        MEASURES,
        fold_fact=True,
        **CLOCK,
    )


@query("avg_stats_dim_country", _sql("d"))
def avg_stats_dim_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grouped_averages(
        results(spark, sf_dir),
        _people(spark, sf_dir),
        KEY,
        GROUPS,
        MEASURES,
        shared_from="dim",
        **CLOCK,
    )


@query("avg_stats_measured", _sql("d", BASIC_LABEL, _MEASURED))
def avg_stats_measured(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = results(spark, sf_dir).withColumn("medal", fill_label(F.col("medal")))
    return grouped_averages(
        fact,
        _people(spark, sf_dir),
        KEY,
        GROUPS,
        MEASURES,
        shared_from="dim",
        measured_only=True,
        **CLOCK,
    )


@query("avg_stats_rounded", f"""
    SELECT sport, {SENTINEL_LABEL} AS medal, sex, d.country_noc,
           cast(round(cast(avg(weight) AS decimal(28, 10)), 2) AS double) AS avg_weight,
           cast(round(cast(cast(cast(sum(cast(balance AS decimal(18, 2))) AS double)
                                / count(balance) AS varchar) AS decimal(30, 15)), 2)
                AS double) AS avg_balance,
           TIMESTAMP '{AS_OF}' AS "timestamp"
    FROM ({FACT_SQL}) AS f
    JOIN (SELECT athlete_id, sex, country_noc, {_number('weight')} AS weight, c_acctbal AS balance
          FROM ({DIM_SQL}) JOIN customer ON c_custkey = athlete_id) AS d USING (athlete_id)
    WHERE weight IS NOT NULL AND balance IS NOT NULL
    GROUP BY sport, {SENTINEL_LABEL}, sex, d.country_noc""")
def avg_stats_rounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rounded averages of measures with one decimal and with two."""
    fact = results(spark, sf_dir).withColumn(
        "medal", fill_label(F.col("medal"), sentinels=MISSING_WORDS)
    )
    people = map_columns(
        athletes(spark, sf_dir, balance="c_acctbal"),
        lambda c: to_measure(c, decimal_comma=True),
        ["weight"],
    )
    return grouped_averages(
        fact,
        people,
        KEY,
        GROUPS,
        {"avg_weight": "weight", "avg_balance": "balance"},
        shared_from="dim",
        measured_only=True,
        digits=2,
        exact_scale=2,
        **CLOCK,
    )


@query("avg_stats_labelled", _sql("f", SENTINEL_LABEL))
def avg_stats_labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = results(spark, sf_dir).withColumn(
        "medal", fill_label(F.col("medal"), sentinels=MISSING_WORDS)
    )
    return grouped_averages(fact, _people(spark, sf_dir), KEY, GROUPS, MEASURES, **CLOCK)


_EXACT_SQL = f"""
    SELECT sport, sex, f.country_noc, bool_or(NOT isfinite(balance)) AS poisoned,
           CASE WHEN NOT bool_or(NOT isfinite(balance))
                THEN cast(sum({_FINITE}) AS double) / count({_FINITE}) END AS avg_balance
    FROM ({FACT_SQL}) AS f
    JOIN (SELECT c_custkey AS athlete_id, c_mktsegment AS sex, {BALANCE} AS balance
          FROM customer) AS d USING (athlete_id)
    GROUP BY sport, sex, f.country_noc"""


def _exact(spark: SparkSession, sf_dir: str, fold: bool) -> DataFrame:
    stats = grouped_averages(
        results(spark, sf_dir),
        athletes(spark, sf_dir, balance=BALANCE),
        KEY,
        ("sport", "sex", "country_noc"),
        {"avg_balance": "balance"},
        exact_scale=2,
        fold_fact=fold,
        stamp_column=None,
    )
    odd = F.isnan("avg_balance")
    return stats.withColumn("poisoned", odd).withColumn(
        "avg_balance", F.when(~odd, F.col("avg_balance"))
    )


@query("avg_stats_exact", _EXACT_SQL)
def avg_stats_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sums of decimals; one measure that is not finite makes its group's average NaN."""
    return _exact(spark, sf_dir, fold=False)


@query("avg_stats_exact_folded", _EXACT_SQL)
def avg_stats_exact_folded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _exact(spark, sf_dir, fold=True)


@query("avg_stats_nan", f"""
    SELECT sport, medal, country_noc, coalesce(isnan(mean), false) AS poisoned,
           CASE WHEN NOT isnan(mean) THEN mean END AS avg_height
    FROM (SELECT sport, medal, f.country_noc, avg(try_cast(height AS double)) AS mean
          FROM ({FACT_SQL}) AS f
          JOIN (SELECT c_custkey AS athlete_id, {HEIGHT_NAN} AS height FROM customer) AS d
          USING (athlete_id)
          GROUP BY sport, medal, f.country_noc)""")
def avg_stats_nan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A NaN passes the not-null rules and takes over its group's average."""
    people = map_columns(athletes(spark, sf_dir, height=HEIGHT_NAN), to_measure, ["height"])
    stats = grouped_averages(
        results(spark, sf_dir),
        people,
        KEY,
        ("sport", "medal", "country_noc"),
        {"mean": "height"},
        stamp_column=None,
    )
    return stats.select(
        "sport",
        "medal",
        "country_noc",
        F.coalesce(F.isnan("mean"), F.lit(False)).alias("poisoned"),
        F.when(~F.isnan("mean"), F.col("mean")).alias("avg_height"),
    )
