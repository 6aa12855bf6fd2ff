"""Fixtures for the training-data operators."""

import pytest
from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


@pytest.fixture
def docs(spark):
    """Documents from (doc_id, text) or (doc_id, text, source)."""

    def make(rows):
        full = [
            (r[0], r[1], "en", r[2] if len(r) > 2 else "web", len(r[1]) if r[1] else 0) for r in rows
        ]
        return spark.createDataFrame(full, DOCS)

    return make


#: NULL and empty texts, white space of all kinds, repeats, ties, odd characters.
ODD_TEXTS = [
    (1, None),
    (2, ""),
    (3, " \t\n\x0b\x0c\r "),
    (4, "word"),
    (5, "two words"),
    (5, "two words"),
    (None, "no id at all here"),
    (6, "ÄÖ naïve 日本語 \U0001f600 mixed\x85nbsp\xa0end\x1c!\x1d"),
    (7, "A b C a B c a b c A B C"),
    (8, "line\n\nline\r\nline\n"),
    (9, "long " * 30_000),
    (10, "don't we'll 's 1234 $$$ ### <|endoftext|> |||"),
]
