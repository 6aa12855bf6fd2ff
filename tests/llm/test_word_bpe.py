"""Backtracking BPE of words: against the library, and the cases without ids."""

import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer, models

from strataflow.llm import word_bpe
from tests.llm.conftest import ODD_TEXTS

PATH = public_tokenizers.path("word_bpe_49k.json")
PARTS = [
    "a", "A", "th", "in", "the", " ", "\n", "\t", "\x1c", "\x85", "\xa0", " ", "é", "é",
    "İ", "Σ", "ß", "ﬀ", "ǅ", "1", "²", "½", "٣", "'s", "'LL", "’", "|", "日本", "\U0001f600",
    "‍", "Å", "가", "\x00", "\xad", "zzz", "...", "<|endoftext|>", "<|ENDOFTEXT|>", "<|",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def _agrees(codec, library, text):
    ids = library.encode(text, add_special_tokens=False).ids
    got = np.frombuffer(codec.encode(text), "<u4")
    assert got.tolist() == ids, text
    assert codec.decode(got).decode() == library.decode(ids, skip_special_tokens=False)


def test_random_texts_as_the_library(library):
    codec, draw = word_bpe.WordCodec(PATH, remember=500), random.Random(1)
    for _ in range(3_000):
        _agrees(codec, library, "".join(draw.choices(PARTS, k=draw.randint(0, 25))))


def test_documents_as_the_library(spark, library):
    codec = word_bpe.WordCodec(PATH)
    for row in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect():
        _agrees(codec, library, row["text"] or "")


def test_any_merges_as_the_library():
    """Vocabularies whose merges overlap, tie and hide each other."""
    draw = random.Random(2)
    for _ in range(150):
        names = [c + end for end in ("", "</w>") for c in "abc"]
        merges = []
        for _ in range(draw.randint(0, 25)):
            a = draw.choice([n for n in names if not n.endswith("</w>")])
            b = draw.choice(names)
            if a + b not in names:
                names.append(a + b)
                merges.append((a, b))
        vocabulary = {n: k for k, n in enumerate(names)}
        exact = models.BPE(vocab=vocabulary, merges=merges, end_of_word_suffix="</w>")
        tables = word_bpe.Merges(vocabulary, merges, "</w>")
        words = ["".join(draw.choices("abc"[: draw.randint(1, 3)], k=n)) for n in range(1, 14)]
        got = tables.encode([tables.ended(w) for w in words])
        for word, tokens in zip(words, got, strict=True):
            want = [t.id for t in exact.tokenize(word)]
            assert tables.ids[tokens].tolist() == want, (word, merges)


def test_slices_and_a_word_longer_than_one(library, monkeypatch):
    monkeypatch.setattr(word_bpe, "SLICE_CHARACTERS", 50)
    monkeypatch.setattr(word_bpe, "SLICE_IDS", 7)
    codec = word_bpe.WordCodec(PATH)
    _agrees(codec, library, "some words and <|endoftext|> " * 40)
    _agrees(codec, library, "x" * 400 + " tail")


def test_decode_leaves_unknown_ids_out():
    codec = word_bpe.WordCodec(PATH)
    assert codec.decode(np.array([343, 10**6, 343], "<u4")) == "x</w> x</w>".replace(
        "x</w>", codec.decode(np.array([343], "<u4")).decode()
    ).encode()
    assert codec.decode(np.zeros(0, "<u4")) == b""


def test_other_vocabularies_are_refused():
    with pytest.raises(ValueError, match="words"):
        word_bpe.WordCodec(public_tokenizers.path("byte_bpe_50k.json"))


def test_odd_rows_and_columns(spark, docs, library):
    rows = docs(ODD_TEXTS).withColumn("IDS", F.lit(1)).withColumn("decoded", F.lit("x"))
    got = word_bpe.decode(word_bpe.encode(rows, PATH), PATH).collect()
    assert len(got) == len(ODD_TEXTS)
    for row in got:
        ids = library.encode(row["text"] or "", add_special_tokens=False).ids
        assert np.frombuffer(row["ids"], "<u4").tolist() == ids
        assert row["decoded"] == library.decode(ids, skip_special_tokens=False)
    assert word_bpe.encode(docs([]), PATH).count() == 0
