"""From raw documents to token ids: five stages, each written and read again."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from strataflow.llm import bpe, jaccard, lines, mixing, quality
from strataflow.session import scratch_path

#: Fixed value: the columns of ``documents``.
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Near copies share four fifths of their shingles of five words.
NEAR = {"size": 5, "similarity": 0.8}

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the quality classifier rejects."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    return quality.keep_good(docs, labels).select(*COLUMNS)


def cut_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut lines whose template recurs across documents."""
    return lines.drop_recurring_lines(docs).select(*COLUMNS)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each near-copy group."""
    return jaccard.drop_similar(docs, **NEAR).select(*COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat or sample the documents so that the sources meet their weights."""
    return mixing.mixed_documents(docs).select(*COLUMNS)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, checked by decoding them."""
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    encoded = bpe.encode(docs.select("doc_id", "source", "text"), ranks, public_tokenizers.PATTERN)
    return bpe.verified(encoded, ranks).select(
        "doc_id", "source", "n_tokens", "ids", "intact"
    )


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", classify),
    ("line_dedup", cut_lines),
    ("simhash_near_dedup", drop_copies),
    ("source_mixing", mix),
    ("byte_bpe", tokenize),
]

#: No SQL: the classifier, the fingerprints and the merges are beyond it.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; between two of them lies a table in the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
