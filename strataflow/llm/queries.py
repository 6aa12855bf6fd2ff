"""One query for each operator, and the pipeline, on the driver's tables."""

from __future__ import annotations

import string
from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow.llm import (
    bpe,
    lines,
    merkle,
    mixing,
    oracles,
    prefix_trie,
    quality,
    rules,
    secret_scan,
    sharding,
    simhash,
    token_files,
    vectors,
    word_bpe,
)
from strataflow.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.near_groups(_documents(spark, sf_dir).select("doc_id", "text"))
    return groups.select(
        "doc_id", simhash.as_hex(F.col("fp")).alias("fingerprint"), "component_id"
    )


def op2_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = rules.judge_documents(_documents(spark, sf_dir).select("doc_id", "text"))
    return judged.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "posterior",
    )


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    encoded = bpe.encode(docs, ranks, public_tokenizers.PATTERN).drop("text")
    decoded = bpe.decode(encoded, ranks)
    return decoded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        bpe.ids_digest().alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan_secrets(
        _documents(spark, sf_dir).select("doc_id", "text"), scratch_path(spark, "ledger")
    )
    return found.select(
        "doc_id",
        secret_scan.count_kind("assign").alias("n_assign"),
        secret_scan.count_kind("access").alias("n_access"),
        secret_scan.count_kind("hex").alias("n_hex"),
        F.sha2(secret_scan.span_list(secret_scan.BASE_KINDS), 256).alias("base_sha256"),
        secret_scan.span_list().alias("spans"),
    )


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mixing.mix_sources(_documents(spark, sf_dir).select("doc_id", "text", "source"))
    return mix.select("doc_id", "source", "size", "source_size", "target", "taken")


def op6_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = lines.drop_recurring_lines(_documents(spark, sf_dir).select("doc_id", "text"))
    return cleaned.select("doc_id", "text", "n_lines", "n_dropped")


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    token_files.write_tokens(docs, path, public_tokenizers.path("byte_bpe_50k.json"))
    return token_files.read_tokens(spark, path, ids=False)


def op8_histogram_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    sharded = sharding.shard_documents(_documents(spark, sf_dir).select("doc_id", "text"))
    return sharded.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = quality.score_documents(
        _documents(spark, sf_dir).select("doc_id", "text"), labels.select("doc_id", "quality")
    )
    return scored.select("doc_id", "held_out", "score", "predicted")


def op10_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    linked = vectors.near_vectors(rows.select("vec_id", "embedding", "label"))
    return linked.select("vec_id", "n_links", "component_id", "kept")


def op11_word_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    encoded = word_bpe.encode(_documents(spark, sf_dir).select("doc_id", "text"), path)
    return word_bpe.decode(encoded.drop("text"), path).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return prefix_trie.prefix_nodes(
        *prefix_trie.rebuilt(rows.select("conv_id", "turn", "role", "text"))
    )


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = ("doc_id", "source", "lang", "n_chars", "text")
    docs = _documents(spark, sf_dir).select(*fields)
    leaf = merkle.leaf_digest([F.col(f) for f in fields])
    lowered = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    forged = merkle.leaf_digest([*map(F.col, fields[:-1]), lowered])
    struck = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    made = merkle.manifest(
        docs, leaf, "lang", "doc_id", ["doc_id", F.when(struck, forged).alias("forged")]
    )
    folded = merkle.fold("path", F.coalesce("forged", "leaf"))
    return made.rows.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        merkle.proof_digest("path").alias("proof_sha256"),
        folded.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


QUERIES: dict[str, Query] = {
    "op1_simhash": op1_simhash,
    "op2_rules": op2_rules,
    "op3_byte_bpe": op3_byte_bpe,
    "op4_secrets": op4_secrets,
    "op5_mixing": op5_mixing,
    "op6_line_templates": op6_line_templates,
    "op7_token_files": op7_token_files,
    "op8_histogram_sort": op8_histogram_sort,
    "op9_quality": op9_quality,
    "op10_vectors": op10_vectors,
    "op11_word_bpe": op11_word_bpe,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_merkle": op13_merkle,
    "pipeline": corpus_pipeline.run,
}
ORACLES: dict[str, str] = {"op4_secrets": oracles.SECRETS, "op5_mixing": oracles.MIXING}
if corpus_pipeline.ORACLE_SQL is not None:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
