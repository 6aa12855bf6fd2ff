"""Encoding against the tiktoken library, decoding as a round trip, offsets, token files."""

import base64
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from strataflow.llm import bpe, token_files
from tests.llm.conftest import ODD_TEXTS

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
JSON = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def oracle():
    pairs = (line.split() for line in open(RANKS, "rb"))
    ranks = {base64.b64decode(a): int(b) for a, b in pairs}
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


def random_texts(count):
    dice = random.Random(11)
    pools = [
        "abc 's't \n\r\x1c\x1f\x85 ᠎​　\xa0 é1²½٣Ⅷ!?#",
        "  \n\nab.,'s",
        "".join(chr(dice.randrange(32, 0x2FFF)) for _ in range(2000)),
        "".join(chr(k) for k in range(0x10000, 0x1FFFF, 37)),
        "the of and, to. In\n<|endoftext|> naïve façade ",
    ]
    for _ in range(count):
        pool = dice.choice(pools)
        yield "".join(dice.choice(pool) for _ in range(dice.randrange(40)))


def test_codec_matches_the_library(oracle):
    texts = [*random_texts(4000), *[t or "" for _, t in ODD_TEXTS]]
    codec = bpe.Codec(RANKS, public_tokenizers.PATTERN)
    table = bpe.token_bytes(RANKS)
    for text, ids in zip(texts, codec.encode(texts), strict=True):
        assert ids.tolist() == oracle.encode_ordinary(text), repr(text)
        assert bpe.decode_ids(ids, table) == text.encode()


def test_codec_of_a_json_vocabulary():
    texts = list(random_texts(2000))
    codec, table = bpe.Codec(JSON), bpe.token_bytes(JSON)
    plain = codec.tokenizer.encode_batch(texts, add_special_tokens=False)
    for text, ids, known in zip(texts, codec.encode(texts), plain, strict=True):
        assert ids.tolist() == known.ids, repr(text)
        assert bpe.decode_ids(ids, table) == text.encode()


def test_small_memory_gives_the_same_ids(monkeypatch):
    texts = list(random_texts(500)) * 3
    expected = [i.tolist() for i in bpe.Codec(JSON).encode(texts)]
    monkeypatch.setattr(bpe, "GROUP_CHARACTERS", 100)
    assert [i.tolist() for i in bpe.Codec(JSON, remember=20).encode(texts)] == expected


def test_whole_documents(spark, docs, oracle):
    rows = docs(ODD_TEXTS).withColumn("IDS", F.lit("clash")).withColumn("decoded", F.lit(0))
    encoded = bpe.encode(rows, RANKS, public_tokenizers.PATTERN, offsets=True)
    got = bpe.decode(encoded, RANKS).collect()
    assert len(got) == len(ODD_TEXTS)
    for row in got:
        text = row.text or ""
        assert row.ids == oracle.encode_ordinary(text)
        assert bytes(row.decoded) == text.encode()
        at = 0
        for start, token in zip(row.starts, row.ids, strict=True):
            assert start == len(text.encode()[:at].decode(errors="ignore"))
            at += len(oracle.decode_single_token_bytes(token))
    assert bpe.encode(docs([]), RANKS, public_tokenizers.PATTERN).count() == 0


def test_numeral_system_round_trip():
    dice = np.random.default_rng(3)
    for size, lanes in ((1, 1), (7, 3), (5000, 64), (64, 64), (65, 64), (100_000, 2048)):
        symbols = np.minimum(dice.zipf(1.3, size), 50_000).astype(np.uint32)
        ids, counts = np.unique(symbols, return_counts=True)
        table = token_files.Table(
            *token_files.normal_frequencies(dict(zip(ids.tolist(), counts.tolist(), strict=True)))
        )
        states, words = table.encode(symbols, lanes)
        assert (table.decode(size, lanes, states, words) == symbols).all()
        entropy = -(counts * np.log2(counts / size)).sum() / 8
        assert len(words) <= entropy * 1.01 + 8 * lanes


def test_frequencies_fill_the_table():
    ids, frequencies = token_files.normal_frequencies({5: 1, 2: 10**12, 9: 3})
    assert ids.tolist() == [2, 5, 9]
    assert frequencies.min() >= 1 and frequencies.sum() == 1 << token_files.PRECISION


def expected_files(rows, tokenizer, end_id=2):
    start, found = 0, []
    known = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    for i, t in known:
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, end_id], "<u4")
        found.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return found


def test_token_files(spark, docs, tmp_path, monkeypatch):
    monkeypatch.setattr(token_files, "BLOCK_TOKENS", 500)
    rows = [(i, t) for i, t in ODD_TEXTS if t is not None] + [(100 + k, f"t {k} " * k) for k in range(60)]
    path = str(tmp_path / "files")
    token_files.write_tokens(docs(rows), path, JSON)
    got = token_files.read_tokens(spark, path).collect()
    tokenizer = bpe.load_tokenizer(JSON)
    assert sorted((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == [
        (s, i, n, c) for i, s, n, c in expected_files(rows, tokenizer)
    ]
    assert all(zlib.crc32(bytes(r.ids)) == r.ids_crc32 for r in got)
    assert token_files.read_tokens(spark, path, ids=False).columns == [
        "doc_id", "start", "n_tokens", "ids_crc32",
    ]


def test_null_texts_and_an_empty_table(spark, docs, tmp_path):
    path = str(tmp_path / "one")
    token_files.write_tokens(docs([(1, None), (2, "")]), path, JSON)
    got = sorted(tuple(r) for r in token_files.read_tokens(spark, path, ids=False).collect())
    crc = zlib.crc32(np.array([2], "<u4").tobytes())
    assert got == [(1, 0, 1, crc), (2, 1, 1, crc)]
    path = str(tmp_path / "none")
    token_files.write_tokens(docs([]), path, JSON)
    assert token_files.read_tokens(spark, path).count() == 0


def test_a_damaged_block_raises(spark, docs, tmp_path):
    path = str(tmp_path / "files")
    token_files.write_tokens(docs([(1, "some text of a few words")]), path, JSON)
    blocks = spark.read.parquet(f"{path}/blocks").withColumn("checksum", F.col("checksum") + 1)
    blocks.write.parquet(f"{path}-bad/blocks")
    spark.read.parquet(f"{path}/table").write.parquet(f"{path}-bad/table")
    with pytest.raises(Exception, match="is damaged"):
        token_files.read_tokens(spark, f"{path}-bad").collect()
