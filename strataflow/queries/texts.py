"""Text cleaning and dedup."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow.functions.text import clean_text_arrow
from strataflow.operators.cleaning import clean_text, drop_copies, map_columns, normalise_text
from strataflow.queries.inputs import TEXT_SQL, texts
from strataflow.queries.registry import query, table

STRICT = r"""'[^a-zA-Z0-9,.\\"'']'"""
SPACES = r"""'[^a-zA-Z0-9,.\\"'' ]'"""
NO_BACKSLASH = r"""'[^a-zA-Z0-9,."'']'"""


def _sql(body: str, lang: str) -> str:
    return f"SELECT doc_id, {body} AS body, {lang} AS lang FROM ({TEXT_SQL})"


def _strict(column: str) -> str:
    return f"regexp_replace({column}, {STRICT}, '', 'g')"


@query("clean_text_strict", _sql(_strict("body"), _strict("lang")))
def clean_text_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_text(texts(spark, sf_dir))


@query(
    "clean_text_spaces",
    _sql(
        f"trim(regexp_replace(body, {SPACES}, '', 'g'))",
        f"trim(regexp_replace(lang, {SPACES}, '', 'g'))",
    ),
)
def clean_text_spaces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_text(texts(spark, sf_dir), keep_space=True, trim=True)


@query(
    "clean_text_no_backslash",
    _sql(
        f"regexp_replace(coalesce(body, 'None'), {NO_BACKSLASH}, '', 'g')",
        f"regexp_replace(coalesce(lang, 'None'), {NO_BACKSLASH}, '', 'g')",
    ),
)
def clean_text_no_backslash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_text(texts(spark, sf_dir), keep_backslash=False, null_policy="literal")


@query(
    "clean_text_null_literal",
    _sql(_strict("coalesce(body, 'None')"), _strict("coalesce(lang, 'None')")),
)
def clean_text_null_literal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_text(texts(spark, sf_dir), null_policy="literal")


@query(
    "clean_text_empty_null",
    _sql(
        f"CASE WHEN body <> '' THEN regexp_replace(body, {SPACES}, '', 'g') END",
        f"CASE WHEN lang <> '' THEN regexp_replace(lang, {SPACES}, '', 'g') END",
    ),
)
def clean_text_empty_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_text(texts(spark, sf_dir), keep_space=True, null_policy="empty_to_null")


@query(
    "clean_text_named",
    _sql(f"regexp_replace(coalesce(body, 'None'), {SPACES}, '', 'g')", "lang"),
)
def clean_text_named(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_text(texts(spark, sf_dir), ["body"], keep_space=True, null_policy="literal")


@query("clean_text_udf", _sql(_strict("body"), _strict("lang")))
def clean_text_udf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return map_columns(texts(spark, sf_dir), clean_text_arrow(), ["body", "lang"])


@query("normalise_text", _sql("trim(lower(body))", "trim(lower(lang))"))
def normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalise_text(texts(spark, sf_dir))


@query(
    "clean_then_dedup",
    f"SELECT DISTINCT {_strict('text')} AS text, {_strict('lang')} AS lang FROM documents",
)
def clean_then_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_copies(clean_text(table(spark, sf_dir, "documents").select("text", "lang")))


@query(
    "clean_then_dedup_parts",
    f"SELECT DISTINCT {_strict('p_name')} AS p_name, {_strict('p_brand')} AS p_brand FROM part",
)
def clean_then_dedup_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").select(F.col("p_name"), F.col("p_brand"))
    return drop_copies(clean_text(parts))
