"""The corpus pipeline: stages, what they keep, and the library without it."""

import re
import shutil
import subprocess
import sys
from pathlib import Path

from pyspark.sql import functions as F

import corpus_pipeline
from strataflow.llm import bpe, lines, quality

SF_DIR = "/root/testdata/sf0.001"
ROOT = Path(__file__).resolve().parents[2]


def test_stages_chain(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    counts = [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        stage(spark, docs, SF_DIR).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        counts.append(docs.count())
        if name != "byte_bpe":
            assert docs.columns == list(corpus_pipeline.COLUMNS)
        if name == "quality_classifier":
            labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
            scored = quality.score_documents(before, labels)
            assert counts[-1] == scored.where("predicted = 1").count()
        if name == "line_dedup":
            cleaned = lines.drop_recurring_lines(before)
            assert not docs.select("doc_id", "text").exceptAll(cleaned.select("doc_id", "text")).count()
        if name == "source_mixing":
            assert not docs.join(before, "doc_id", "left_anti").count()
    assert counts[0] > counts[1] == counts[2] > counts[3] and counts[4] == counts[5]
    assert docs.where(~F.col("intact") | (F.col("n_tokens") != F.size("ids"))).count() == 0
    table = bpe.token_bytes(corpus_pipeline.public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    texts = {r.doc_id: r.text for r in before.collect()}
    for row in docs.limit(20).collect():
        assert b"".join(table[i] for i in row.ids).decode() == texts[row.doc_id]


def test_near_copies_go_and_others_stay(spark, docs):
    base = [f"w{k % 97}x{k}" for k in range(400)]
    near = base.copy()
    near[50], near[300] = "changed", "too"
    rows = docs([(1, " ".join(base)), (2, " ".join(near)), (3, " ".join(base)), (4, " ".join(reversed(base)))])
    kept = corpus_pipeline.drop_copies(spark, rows, SF_DIR).select("doc_id").collect()
    assert sorted(r.doc_id for r in kept) == [1, 4]


def test_run(spark):
    result = corpus_pipeline.run(spark, SF_DIR)
    assert result.columns == ["doc_id", "source", "n_tokens", "ids", "intact"]
    assert result.count() > 0


def test_the_rest_works_without_the_subpackage(tmp_path):
    copy = tmp_path / "repo"
    shutil.copytree(
        ROOT, copy, ignore=lambda d, names: [n for n in names if n in (".git", "llm", "corpus_pipeline.py")]
    )
    code = "import __spark_entry__ as e; print(len(e.queries()), sum(n.startswith('op') for n in e.queries()))"
    run = subprocess.run([sys.executable, "-c", code], cwd=copy, capture_output=True, text=True, timeout=120)
    assert run.returncode == 0, run.stderr
    assert int(run.stdout.split()[0]) > 70 and run.stdout.split()[1] == "0"
    text = "".join(p.read_text() for p in (ROOT / "strataflow").rglob("*.py") if "llm" not in p.parts)
    assert not re.search(r"strataflow\.llm|corpus_pipeline", text)
