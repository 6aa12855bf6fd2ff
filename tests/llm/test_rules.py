"""Measures against brute force; rules and their estimated accuracies."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from strataflow.llm import rules
from tests.llm.conftest import ODD_TEXTS

WORD = r"[^\x20\x09-\x0D]+"


def slow_measures(text):
    text = text or ""
    words = re.findall(WORD, text)
    lines = [line for line in text.split("\n") if re.search(WORD, line)]
    windows = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
    often = Counter(windows)
    covered = {k + j for k, w in enumerate(windows) if often[w] > 1 for j in range(3)}
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)),
        len(covered),
    )


TEXTS = [*ODD_TEXTS, (20, "a b c d a b c"), (21, "x x x x"), (22, "a b a b a b\nq\nq\n q\nq "), (23, "p q r s p q r s t p q")]


def test_measures(docs):
    got = rules.judge_documents(docs(TEXTS).withColumn("Kept", F.lit(1)))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    rows = got.select("doc_id", *names, "base_failed", "kept").collect()
    assert len(rows) == len(TEXTS)
    expected = sorted((str(i), *slow_measures(t)) for i, t in TEXTS)
    assert sorted((str(r.doc_id), *(r[n] for n in names)) for r in rows) == expected
    for row in rows:
        failed = row.n_words < 50 or 100 * row.n_repeat_words > 50 * row.n_words
        assert row.base_failed == failed
        assert not (failed and row.kept)


def test_empty_table(docs):
    assert rules.judge_documents(docs([])).count() == 0


def test_expectation_maximisation_finds_accuracies(spark):
    # 900 good and 100 bad rows; the first two rules see most bad rows, the third guesses.
    rows = []
    for k in range(1000):
        bad = k % 10 == 0
        sure = -1 if bad and k % 100 else 1
        also = -1 if bad and k % 200 != 10 else 0
        rows.append((sure, also, -1 if k % 7 == 0 else 1))
    votes = spark.createDataFrame(rows, "a int, b int, c int")
    model = rules.fit_votes(votes, ["a", "b", "c"])
    assert model.prior == pytest.approx(0.9, abs=0.03)
    assert model.given_bad[0][-1] > 0.8 > 0.1 > model.given_good[0][-1]
    assert abs(model.given_bad[2][-1] - model.given_good[2][-1]) < 0.15


@pytest.mark.parametrize("sf_dir", ["/root/testdata/sf0.01"])
def test_clean_documents_are_kept(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    judged = rules.judge_documents(docs).where("not base_failed").join(labels, "doc_id")
    share = {r.quality: r.share for r in judged.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("share")).collect()}
    assert share[1] > 0.98
    assert share[0] < 0.1
