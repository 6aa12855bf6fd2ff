"""Every medallion recipe, from CSV landing files to the gold table."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from strataflow.plans.medallion import DIMENSION, FACT, RECIPES, Recipe, run_medallion
from strataflow.queries.files import write_csv
from strataflow.queries.inputs import DIM_SQL, FACT_SQL, athletes, results
from strataflow.queries.registry import Query, query
from strataflow.session import scratch_path
from strataflow.sinks.layers import read_layer

AS_OF = datetime(2024, 2, 1)


def _cleaned(column: str, recipe: Recipe) -> str:
    if recipe.clean is None:
        return f"trim(lower({column}))"
    kept = r"""a-zA-Z0-9,."''"""
    if recipe.clean.get("keep_backslash", True):
        kept += r"\\"
    if recipe.clean.get("keep_space"):
        kept += " "
    if recipe.clean.get("null_policy") == "literal":
        column = f"coalesce({column}, 'None')"
    cleaned = f"regexp_replace({column}, '[^{kept}]', '', 'g')"
    return f"trim({cleaned})" if recipe.clean.get("trim") else cleaned


def _silver_sql(source: str, texts: tuple[str, ...], others: tuple[str, ...], name: str,
                recipe: Recipe) -> str:
    chosen = texts if recipe.only is None else recipe.only[name]
    columns = [f"{_cleaned(c, recipe)} AS {c}" if c in chosen else c for c in texts]
    distinct = "DISTINCT" if recipe.distinct else ""
    return f"SELECT {distinct} {', '.join([*columns, *others])} FROM ({source})"


def _measure_sql(column: str, recipe: Recipe) -> str:
    if recipe.measure.get("decimal_comma"):
        column = f"replace({column}, ',', '.')"
    kind = recipe.measure.get("kind", "double")
    if kind == "int":
        return f"try_cast(trunc(try_cast({column} AS double)) AS integer)"
    return f"try_cast({column} AS {kind})"


def _gold_sql(recipe: Recipe) -> str:
    # A CSV file holds an empty text as nothing, which reads back as NULL.
    fact = f"SELECT * REPLACE (nullif(medal, '') AS medal) FROM ({FACT_SQL})"
    # Inference turns the id and the plain decimal weight into numbers, and
    # numbers are not cleaned.
    typed = recipe.types == "infer"
    fact = _silver_sql(
        fact, ("sport", "event", "medal", "country_noc"), ("athlete_id",), FACT, recipe
    )
    texts = ("name", "sex", "height", "country_noc")
    dim = _silver_sql(
        DIM_SQL,
        texts if typed else (*texts, "weight"),
        ("athlete_id", "weight") if typed else ("athlete_id",),
        DIMENSION,
        recipe,
    )
    medal = "medal"
    if recipe.sentinels:
        words = ", ".join(f"'{w}'" for w in recipe.sentinels)
        medal = (
            f"CASE WHEN medal IS NULL OR lower(trim(medal)) IN ({words})"
            " THEN 'No medal' ELSE medal END"
        )
    elif recipe.fill:
        medal = "CASE WHEN medal IS NULL OR medal = '' THEN 'No medal' ELSE medal END"
    tests = ["true"]
    if recipe.raw_present:
        tests += ["raw_height IS NOT NULL", "raw_weight IS NOT NULL"]
    if recipe.measured_only:
        tests += ["height IS NOT NULL", "weight IS NOT NULL"]
    mean = "avg({0})"
    if recipe.digits is not None:
        mean = f"cast(round(cast(avg({{0}}) AS decimal(28, 10)), {recipe.digits}) AS double)"
    country = "f" if recipe.country_from == "fact" else "d"
    return f"""
        SELECT sport, {medal} AS medal, sex, {country}.country_noc AS country_noc,
               {mean.format('weight')} AS avg_weight, {mean.format('height')} AS avg_height,
               TIMESTAMP '{AS_OF}' AS "{recipe.stamp_column}"
        FROM ({fact}) AS f
        JOIN (SELECT athlete_id, sex, country_noc,
                     height AS raw_height, weight AS raw_weight,
                     {_measure_sql('height', recipe)} AS height,
                     {_measure_sql('weight', recipe)} AS weight
              FROM ({dim})) AS d USING (athlete_id)
        WHERE {' AND '.join(tests)}
        GROUP BY sport, {medal}, sex, {country}.country_noc"""


def _run(recipe: Recipe) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        landing, lake = scratch_path(spark, "landing"), scratch_path(spark, "lake")
        write_csv(results(spark, sf_dir), f"{landing}/{FACT}")
        write_csv(athletes(spark, sf_dir), f"{landing}/{DIMENSION}")
        gold = run_medallion(spark, landing, lake, recipe, AS_OF, "timestamp_ntz")
        return read_layer(spark, gold)

    return run


for _name, _recipe in RECIPES.items():
    _key = "medallion_gold" if _name == "plain" else f"medallion_{_name}"
    query(_key, _gold_sql(_recipe))(_run(_recipe))
