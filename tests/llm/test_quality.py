"""The classifier: held-out accuracy, what it learns from, odd texts."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from strataflow.llm import quality
from tests.llm.conftest import ODD_TEXTS

LABELS = "doc_id long, quality int"


def made(count, seed=2):
    dice = random.Random(seed)
    rows, labels = [], []
    for k in range(count):
        words = ["".join(dice.choice("aeiourstn") for _ in range(dice.randrange(2, 8))) for _ in range(60)]
        good = k % 4 > 0
        text = " ".join(words) + "." if good else " ".join(w.upper() + "!!" for w in words)
        rows.append((k, text))
        labels.append((k, int(good)))
    return rows, labels


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = quality.score_documents(docs, labels).join(labels, "doc_id").where("held_out")
    right = {r.quality: r.share for r in scored.groupBy("quality").agg(F.avg((F.col("predicted") == F.col("quality")).cast("int")).alias("share")).collect()}
    assert right[1] >= 0.95 and right[0] >= 0.9


def test_held_out_labels_are_never_learnt(spark, docs):
    rows, labels = made(160)
    table = docs(rows)
    out = {r.doc_id for r in table.where(quality.held_out("doc_id")).select("doc_id").collect()}
    turned = [(i, 1 - q if i in out else q) for i, q in labels]
    assert 20 < len(out) < 60
    first, second = (
        {r.doc_id: r.score for r in quality.score_documents(table, spark.createDataFrame(known, LABELS)).collect()}
        for known in (labels, turned)
    )
    assert first == second
    truth = dict(labels)
    assert all((first[i] >= 0.7) == bool(truth[i]) for i in out)


def test_odd_texts_and_clashing_columns(spark, docs):
    rows, labels = made(120)
    table = docs([*rows, *[(None if i is None else i + 1000, t) for i, t in ODD_TEXTS]]).withColumn("Score", F.lit("clash"))
    got = quality.score_documents(table, spark.createDataFrame(labels, LABELS))
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", "held_out", "score", "predicted"]
    found = got.collect()
    assert len(found) == len(rows) + len(ODD_TEXTS)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in found)
    assert len({r.score for r in found if r.doc_id in (1001, 1002)}) == 1
    kept = quality.keep_good(table, spark.createDataFrame(labels, LABELS))
    assert kept.columns == table.columns and kept.count() == sum(r.predicted for r in found)


@pytest.mark.parametrize("labels", [[], [(1, 1), (2, 1)], [(1, 0), (1, 1)]])
def test_without_both_classes_the_score_is_constant(spark, docs, labels):
    got = quality.score_documents(docs([(1, "a"), (2, "b")]), spark.createDataFrame(labels, LABELS))
    assert len({r.score for r in got.collect()}) == 1


def test_empty_table(spark, docs):
    assert quality.score_documents(docs([]), spark.createDataFrame([(1, 1)], LABELS)).count() == 0


def test_dual_coordinate_descent_separates():
    dice = np.random.default_rng(4)
    rows, signs = [], []
    for k in range(200):
        sign = 1.0 if k % 2 else -1.0
        rows.append((np.array([0, 1, 2 + k % 50]), np.array([sign + dice.normal() * 0.2, 1.0, 0.3])))
        signs.append(sign)
    weights = quality.dual_coordinate_descent(rows, np.array(signs), np.ones(200), 50)
    assert all(s * (weights[at] @ v + weights[-1]) > 0 for (at, v), s in zip(rows, signs, strict=True))
