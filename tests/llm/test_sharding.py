"""Shards of equal bytes, gapless slots and hot groups."""

import zlib
from collections import defaultdict

from pyspark.sql import functions as F

from strataflow.llm import sharding
from tests.llm.conftest import ODD_TEXTS


def held(rows):
    found = defaultdict(list)
    for row in rows:
        found[row.shard].append(row)
    return found


def test_law_slots_and_checksums(docs):
    rows = [(1000 + k, "x" * (k % 50) + "é") for k in range(4000)] + [(9000 + k, "same text") for k in range(2000)]
    got = sharding.shard_documents(docs(rows), shards=16).collect()
    assert len(got) == len(rows)
    texts = dict(rows)
    for row in got:
        raw = texts[row.doc_id].encode()
        assert (row.size, row.text_crc32) == (len(raw) + 1, zlib.crc32(raw))
    shards = held(got)
    assert sorted(shards) == list(range(16))
    sizes = [sum(r.size for r in s) for s in shards.values()]
    assert max(sizes) - min(sizes) <= 2 * (0.001 * sum(sizes) / 16 + 60)
    for some in shards.values():
        assert sorted(r.slot for r in some) == list(range(len(some)))
    # Copies lie in neighbouring shards, more of them than one shard holds.
    hot = sorted({r.shard for r in got if texts[r.doc_id] == "same text"})
    assert hot == list(range(hot[0], hot[-1] + 1)) and len(hot) < 8


def test_rows_that_agree_in_everything(docs):
    got = sharding.shard_documents(docs([(7, "same")] * 300), shards=4).collect()
    assert sorted(len(s) for s in held(got).values()) == [75] * 4
    assert {len({r.slot for r in s}) for s in held(got).values()} == {75}


def test_odd_rows_and_reruns(docs):
    table = docs(ODD_TEXTS).withColumn("Shard", F.lit("clash")).withColumn("slot", F.lit(1))
    first = sharding.shard_documents(table, shards=3)
    assert first.columns == ["doc_id", "lang", "source", "n_chars", "size", "text_crc32", "shard", "slot"]
    rows = sorted(map(str, first.collect()))
    assert rows == sorted(map(str, sharding.shard_documents(table, shards=3).collect()))
    assert len(rows) == len(ODD_TEXTS)
    null = next(r for r in first.collect() if r.doc_id == 1)
    assert (null.size, null.text_crc32) == (1, 0)


def test_empty_table_and_files(spark, docs, tmp_path):
    assert sharding.shard_documents(docs([])).count() == 0
    path = str(tmp_path / "shards")
    sharding.write_shards(docs([(k, "t" * (k + 1)) for k in range(400)]), path, shards=4)
    back = spark.read.parquet(path)
    assert back.count() == 400
    sizes = [r.n for r in back.groupBy("shard").agg(F.sum(F.length("text") + 1).alias("n")).collect()]
    assert len(sizes) == 4 and max(sizes) - min(sizes) < 900
