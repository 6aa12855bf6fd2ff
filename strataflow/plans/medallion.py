"""Landing -> bronze -> silver -> gold.

The stages are separate functions that meet only in parquet folders, so they can
run as one job, or table by table as jobs of their own.
"""

from __future__ import annotations

from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strataflow.functions.clock import AsOf
from strataflow.functions.labels import MISSING_WORDS, fill_label
from strataflow.functions.measures import to_measure
from strataflow.operators.averages import grouped_averages
from strataflow.operators.cleaning import (
    clean_text,
    drop_copies,
    map_columns,
    measured_rows,
    normalise_text,
)
from strataflow.sinks.layers import read_layer, write_layer
from strataflow.sources.files import scan_csv
from strataflow.sources.tables import require_table

# Table and column names of the data model.
DIMENSION, FACT = "athlete_bio", "athlete_event_results"
KEY, CATEGORY = "athlete_id", "medal"
GROUPS = ("sport", "medal", "sex", "country_noc")
MEASURES = {"avg_weight": "weight", "avg_height": "height"}


@dataclass(frozen=True)
class Recipe:
    """Choices in which medallion jobs differ.

    ``types``: CSV scan, ``strings``, ``infer`` or a schema per table, which spares
    large input the extra pass of ``infer``. ``csv``: options of the CSV reader, such as
    ``multiLine`` and ``escape`` for line breaks and quotes within quotes. ``clean``: options of
    ``clean_text``, or None to trim and lower-case instead. ``only``: columns to
    clean per table, all string columns by default. ``distinct``: drop copies in
    silver. ``country_from``: the side whose country counts. ``measure``: options
    of ``to_measure``. ``raw_present``: both measures must be filled before they
    are converted. ``measured_only``: both must be numbers. ``silver_measures``: already
    silver holds numbers, and only the rows that have both. ``fill``: label missing
    categories, with ``sentinels`` as further spellings of missing.
    """

    types: str | Mapping[str, StructType] = "strings"
    csv: Mapping[str, str] = field(default_factory=dict)
    clean: Mapping[str, Any] | None = field(default_factory=dict)
    only: Mapping[str, tuple[str, ...]] | None = None
    distinct: bool = True
    country_from: str = "fact"
    measure: Mapping[str, Any] = field(default_factory=dict)
    raw_present: bool = False
    measured_only: bool = False
    silver_measures: bool = False
    fill: bool = False
    sentinels: tuple[str, ...] = ()
    digits: int | None = None
    stamp_column: str = "timestamp"


RECIPES: dict[str, Recipe] = {
    "plain": Recipe(),
    "typed": Recipe(types="infer"),
    "named_columns": Recipe(
        only={DIMENSION: ("name",), FACT: ("event",)},
        clean={"keep_space": True, "null_policy": "literal"},
        distinct=False,
        country_from="dim",
    ),
    "comma_fixed": Recipe(
        types="infer",
        clean={"null_policy": "literal"},
        measure={"decimal_comma": True},
        raw_present=True,
    ),
    "measured_rounded": Recipe(
        clean={"keep_space": True, "trim": True},
        distinct=False,
        country_from="dim",
        measured_only=True,
        silver_measures=True,
        fill=True,
        sentinels=MISSING_WORDS,
        digits=2,
    ),
    "whole_numbers": Recipe(
        clean={"null_policy": "literal"},
        country_from="dim",
        measure={"kind": "int"},
        stamp_column="processing_timestamp",
    ),
    "lower_case": Recipe(types="infer", clean=None),
    "no_backslash": Recipe(
        types="infer",
        clean={"keep_backslash": False, "null_policy": "literal"},
        distinct=False,
    ),
    "single_precision": Recipe(types="infer", measure={"kind": "float"}),
    "measured_labelled": Recipe(
        types="infer",
        clean={"null_policy": "literal"},
        country_from="dim",
        measured_only=True,
        fill=True,
    ),
}


def ingest(
    spark: SparkSession,
    landing: str,
    bronze: str,
    table: str,
    recipe: Recipe,
    separator: str = ",",
) -> None:
    """CSV file to bronze parquet."""
    types = recipe.types if isinstance(recipe.types, str) else recipe.types[table]
    write_layer(scan_csv(spark, landing, types, separator, **recipe.csv), bronze)


def refined(df: DataFrame, table: str, recipe: Recipe) -> DataFrame:
    """The silver form of a bronze table."""
    columns = None if recipe.only is None else recipe.only.get(table, ())
    if recipe.clean is None:
        df = normalise_text(df, columns)
    else:
        df = clean_text(df, columns, **recipe.clean)
    if recipe.silver_measures and table == DIMENSION:
        names = list(MEASURES.values())
        df = map_columns(df, lambda c: to_measure(c, **recipe.measure), names)
        df = measured_rows(df, *names)
    return drop_copies(df) if recipe.distinct else df


def refine(spark: SparkSession, bronze: str, silver: str, table: str, recipe: Recipe) -> None:
    """Bronze parquet to silver parquet."""
    write_layer(refined(read_layer(spark, bronze), table, recipe), silver)


def averaged(
    fact: DataFrame,
    dim: DataFrame,
    recipe: Recipe,
    as_of: AsOf = None,
    ts_type: str = "timestamp",
) -> DataFrame:
    """The gold table of two silver tables."""
    names = list(MEASURES.values())
    if recipe.raw_present:
        dim = measured_rows(dim, *names)
    dim = map_columns(dim, lambda c: to_measure(c, **recipe.measure), names)
    if recipe.fill:
        fact = fact.withColumn(
            CATEGORY, fill_label(F.col(CATEGORY), sentinels=recipe.sentinels)
        )
    return grouped_averages(
        fact,
        dim,
        KEY,
        GROUPS,
        MEASURES,
        shared_from=recipe.country_from,
        measured_only=recipe.measured_only,
        digits=recipe.digits,
        stamp_column=recipe.stamp_column,
        as_of=as_of,
        ts_type=ts_type,
    )


def aggregate(
    spark: SparkSession,
    silver_fact: str,
    silver_dim: str,
    gold: str,
    recipe: Recipe,
    as_of: AsOf = None,
    ts_type: str = "timestamp",
) -> None:
    """Silver parquet of both tables to gold parquet."""
    fact, dim = read_layer(spark, silver_fact), read_layer(spark, silver_dim)
    write_layer(averaged(fact, dim, recipe, as_of, ts_type), gold)


def run_table(spark: SparkSession, landing: str, lake: str, table: str, recipe: Recipe) -> None:
    """One table from landing to silver."""
    require_table(table)
    bronze, silver = f"{lake}/bronze/{table}", f"{lake}/silver/{table}"
    ingest(spark, f"{landing}/{table}", bronze, table, recipe)
    refine(spark, bronze, silver, table, recipe)


def run_medallion(
    spark: SparkSession,
    landing: str,
    lake: str,
    recipe: Recipe,
    as_of: AsOf = None,
    ts_type: str = "timestamp",
) -> str:
    """All layers of both tables; returns the path of the gold table.

    The tables do not depend on each other before gold, so their jobs run side by
    side and one fills the executors that the tail of the other leaves idle.
    """
    with ThreadPoolExecutor(2) as pool:
        branches = [
            pool.submit(run_table, spark, landing, lake, table, recipe)
            for table in (FACT, DIMENSION)
        ]
    for branch in branches:
        branch.result()
    gold = f"{lake}/gold/avg_stats"
    aggregate(
        spark, f"{lake}/silver/{FACT}", f"{lake}/silver/{DIMENSION}", gold, recipe, as_of, ts_type
    )
    return gold
