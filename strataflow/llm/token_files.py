"""Token files: ids under a static range asymmetric numeral system, read in parallel."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strataflow.llm.bpe import Codec, over_batches, text_sizes
from strataflow.llm.common import stage

#: Id that ends a document.
END_ID = 2
#: Tokens after which a block ends with the document that it is in.
BLOCK_TOKENS = 1 << 19
#: Streams whose symbols take turns within a block.
LANES = 2048
# The frequencies of a table add up to 2 ** PRECISION. States are 64-bit, at least
# 2 ** LOW_BITS, and give off words of 32 bits.
PRECISION, LOW_BITS, WORD_BITS = 20, 31, 32

#: Words that a worker keeps the ids of; here nothing else takes its memory.
REMEMBERED = 1_200_000

_BLOCK = (
    "file int, block int, first long, n_tokens long, lanes int, doc_ids array<long>,"
    " sizes array<long>, states binary, words binary, checksum long"
)


def normal_frequencies(counts: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Ids in order and their frequencies, at least 1 each and 2 ** PRECISION together."""
    ids = np.array(sorted(counts), np.int64)
    seen = np.array([counts[i] for i in ids.tolist()], np.float64)
    total = 1 << PRECISION
    if len(ids) > total:
        raise ValueError("more symbols than the table has places")
    spare = total - len(ids)
    exact = seen / seen.sum() * spare if len(ids) else seen
    frequencies = np.floor(exact).astype(np.int64) + 1
    missing = total - int(frequencies.sum()) if len(ids) else 0
    frequencies[np.argsort(-(exact - np.floor(exact)), kind="stable")[:missing]] += 1
    return ids, frequencies


class Table:
    """The shared frequency table, by id for encoding and by place for decoding."""

    def __init__(self, ids: np.ndarray, frequencies: np.ndarray) -> None:
        size = int(ids.max()) + 1 if len(ids) else 0
        self.frequency = np.zeros(size, np.uint64)
        self.frequency[ids] = frequencies
        self.start = np.zeros(size, np.uint64)
        self.start[ids] = np.cumsum(frequencies) - frequencies
        self._at = np.repeat(ids, frequencies).astype(np.uint32)

    def encode(self, symbols: np.ndarray, lanes: int) -> tuple[bytes, bytes]:
        """Final states and words of a block; symbol i belongs to lane i mod ``lanes``.

        Encoding runs from the last symbol to the first, decoding the other way, so the
        words of each step are put before those of the steps encoded earlier.
        """
        states = np.full(lanes, 1 << LOW_BITS, np.uint64)
        steps: list[np.ndarray] = []
        frequency, start = self.frequency[symbols], self.start[symbols]
        room = np.uint64(LOW_BITS - PRECISION + WORD_BITS)
        for at in range((len(symbols) - 1) // lanes * lanes, -1, -lanes):
            f, c = frequency[at : at + lanes], start[at : at + lanes]
            x = states[: len(f)]
            full = x >= (f << room)
            steps.append(x[full].astype(np.uint32))
            x = np.where(full, x >> np.uint64(WORD_BITS), x)
            whole = x // f
            states[: len(f)] = (whole << np.uint64(PRECISION)) + (x - whole * f) + c
        words = np.concatenate(steps[::-1]) if steps else np.zeros(0, np.uint32)
        return states.astype("<u8").tobytes(), words.astype("<u4").tobytes()

    def decode(self, count: int, lanes: int, states: bytes, words: bytes) -> np.ndarray:
        """The symbols of a block, one step of all lanes after another."""
        x_all = np.frombuffer(states, "<u8").copy()
        left = np.frombuffer(words, "<u4")
        symbols, read = np.empty(count, np.uint32), 0
        places = np.uint64((1 << PRECISION) - 1)
        for at in range(0, count, lanes):
            x = x_all[: min(lanes, count - at)]
            slot = x & places
            found = self._at[slot]
            symbols[at : at + len(found)] = found
            x = self.frequency[found] * (x >> np.uint64(PRECISION)) + slot - self.start[found]
            low = np.flatnonzero(x < np.uint64(1 << LOW_BITS))
            more = left[read : read + len(low)].astype(np.uint64)
            x[low] = (x[low] << np.uint64(WORD_BITS)) | more
            read += len(low)
            x_all[: len(found)] = x
        if read != len(left) or not (x_all == np.uint64(1 << LOW_BITS)).all():
            raise ValueError("a block does not end where its words do")
        return symbols


@lru_cache(maxsize=1)
def _zstandard() -> tuple[zstandard.ZstdCompressor, zstandard.ZstdDecompressor]:
    """One of each per worker: they are costly to make."""
    return zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()


def _pack(ids: np.ndarray) -> bytes:
    """Ids on their way to their file: byte planes, compressed."""
    planes = np.ascontiguousarray(ids.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    used = 4 if planes[2:].any() else 2
    return bytes([used]) + _zstandard()[0].compress(planes[:used].tobytes())


def _unpack(packed: bytes) -> np.ndarray:
    used = packed[0]
    planes = np.frombuffer(_zstandard()[1].decompress(packed[1:]), np.uint8)
    planes = planes.reshape(used, -1)
    ids = planes[0].astype(np.uint32)
    for k in range(1, used):
        ids |= planes[k].astype(np.uint32) << np.uint32(8 * k)
    return ids


def _tokens(
    docs: DataFrame, tokenizer: str, pattern: str | None, end_id: int, remember: int
) -> DataFrame:
    """A row for each document, and behind those of each task a ``tally`` of all their ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << 16, np.int64)

        def add(batch: pa.RecordBatch) -> dict[str, pa.Array]:
            nonlocal counts
            texts = [t or "" for t in batch.column("text").to_pylist()]
            ids = Codec.of(tokenizer, pattern, remember).encode(texts)
            end = np.array([end_id], "<u4")
            packed = [_pack(np.concatenate((i, end))) for i in ids]
            found = np.bincount(np.concatenate((*ids, end)), minlength=len(counts))
            found[end_id] += len(ids) - 1
            found[: len(counts)] += counts
            counts = found
            n = len(texts)
            return {
                "text": pa.nulls(n, pa.string()),
                "packed": pa.array(packed, pa.binary()),
                "tally": pa.nulls(n, _TALLY),
            }

        yield from over_batches(add, text_sizes)(batches)
        ids = np.flatnonzero(counts)
        if len(ids):
            pairs = pa.StructArray.from_arrays([pa.array(ids), pa.array(counts[ids])], ["id", "n"])
            tally = pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), pairs)
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(1, pa.int64()), pa.nulls(1, pa.string()), pa.nulls(1, pa.binary()), tally],
                ["doc_id", "text", "packed", "tally"],
            )

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return (
        rows.mapInArrow(
            run, "doc_id long, text string, packed binary, tally array<struct<id: long, n: long>>"
        )
        .drop("text")
        .withColumn("_row", F.monotonically_increasing_id())
    )


_TALLY = pa.list_(pa.struct([("id", pa.int64()), ("n", pa.int64())]))


def _histogram(tokens: DataFrame) -> dict[int, int]:
    """Number of occurrences of each id in the whole corpus: one entry per id of the vocabulary."""
    counts = tokens.where("tally IS NOT NULL").select(F.inline("tally"))
    return {r["id"]: r["n"] for r in counts.groupBy("id").agg(F.sum("n").alias("n")).collect()}


def _blocks(table: Table):
    def block(file: int, number: int, first: int, ids: list, parts: list) -> pa.RecordBatch:
        symbols = np.concatenate(parts)
        # A block shorter than its lanes would spend more on states than on words.
        lanes = max(1, min(LANES, len(symbols) // 64))
        states, words = table.encode(symbols, lanes)
        row = {
            "file": file,
            "block": number,
            "first": first,
            "n_tokens": len(symbols),
            "lanes": lanes,
            "doc_ids": ids,
            "sizes": [len(p) for p in parts],
            "states": states,
            "words": words,
            "checksum": zlib.crc32(words, zlib.crc32(states)),
        }
        return pa.RecordBatch.from_pylist([row], _ARROW_BLOCK)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file = TaskContext.get().partitionId()
        number = first = held = 0
        ids: list = []
        parts: list = []
        for batch in batches:
            for doc_id, packed in zip(
                batch.column("doc_id").to_pylist(), batch.column("packed").to_pylist(), strict=True
            ):
                ids.append(doc_id)
                parts.append(_unpack(packed))
                held += len(parts[-1])
                if held >= BLOCK_TOKENS:
                    yield block(file, number, first, ids, parts)
                    number, first, held, ids, parts = number + 1, first + held, 0, [], []
        if parts:
            yield block(file, number, first, ids, parts)

    return run


_ARROW_BLOCK = pa.schema(
    [
        ("file", pa.int32()),
        ("block", pa.int32()),
        ("first", pa.int64()),
        ("n_tokens", pa.int64()),
        ("lanes", pa.int32()),
        ("doc_ids", pa.list_(pa.int64())),
        ("sizes", pa.list_(pa.int64())),
        ("states", pa.binary()),
        ("words", pa.binary()),
        ("checksum", pa.int64()),
    ]
)


def write_tokens(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    pattern: str | None = None,
    end_id: int = END_ID,
    remember: int = REMEMBERED,
) -> None:
    """Write the ids of all texts, each with ``end_id`` behind, in ascending doc_id order.

    ``path/table`` holds the frequency table, counted over all documents. ``path/blocks``
    holds blocks of whole documents: each is decoded by itself from the table, its lane
    states and its words. A block's row is also its checkpoint: its file, number and first
    token, the ids and sizes of its documents, and a checksum. Files are in doc_id order
    by their number (NULL doc_ids first), so are the blocks of a file. Documents that share
    a doc_id lie together. NULL and empty texts are documents of the end id alone.

    ``remember`` is that of ``bpe.encode``. The ids are staged once; the files are then cut by ranges of doc_id. Rows with one
    doc_id are split between files by their place in the input.
    """
    spark = docs.sparkSession
    tokens = stage(_tokens(docs, tokenizer, pattern, end_id, remember), "tokens")
    ids, frequencies = normal_frequencies(_histogram(tokens))
    rows = [(int(i), int(f)) for i, f in zip(ids, frequencies, strict=True)]
    spark.createDataFrame(rows, "id long, frequency long").coalesce(1).write.parquet(f"{path}/table")
    rows = tokens.where("tally IS NULL").select("doc_id", "packed", "_row")
    ordered = rows.repartitionByRange("doc_id", "_row").sortWithinPartitions("doc_id", "_row")
    blocks = ordered.select("doc_id", "packed").mapInArrow(_blocks(Table(ids, frequencies)), _BLOCK)
    blocks.write.option("compression", "none").parquet(f"{path}/blocks")


def read_tokens(spark: SparkSession, path: str, ids: bool = True) -> DataFrame:
    """One row per document: ``doc_id``, ``start``, ``n_tokens``, ``ids_crc32`` and ``ids``.

    ``start`` is the number of ids of all documents before it. Blocks are decoded in
    parallel; one whose checksum or end is wrong raises. ``ids`` are little-endian unsigned
    32-bit integers, left out unless asked for; ``ids_crc32`` is the checksum of those.
    """
    known = spark.read.parquet(f"{path}/table").collect()  # at most one row per id
    order = sorted((r["id"], r["frequency"]) for r in known)
    table = Table(
        np.array([i for i, _ in order], np.int64), np.array([f for _, f in order], np.int64)
    )
    schema = pa.schema(
        [
            ("file", pa.int32()),
            ("doc_id", pa.int64()),
            ("offset", pa.int64()),
            ("n_tokens", pa.int64()),
            ("ids_crc32", pa.int64()),
            ("ids", pa.binary()),
        ]
    )

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                if zlib.crc32(row["words"], zlib.crc32(row["states"])) != row["checksum"]:
                    raise ValueError(f"block {row['block']} of file {row['file']} is damaged")
                found = table.decode(row["n_tokens"], row["lanes"], row["states"], row["words"])
                sizes = np.array(row["sizes"], np.int64)
                ends = np.cumsum(sizes)
                raw = memoryview(found.astype("<u4").tobytes())
                parts = [raw[4 * (e - s) : 4 * e] for s, e in zip(sizes.tolist(), ends.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(sizes), row["file"], np.int32)),
                        pa.array(row["doc_ids"], pa.int64()),
                        pa.array(row["first"] + ends - sizes),
                        pa.array(sizes),
                        pa.array([zlib.crc32(p) for p in parts], pa.int64()),
                        pa.array([bytes(p) for p in parts] if ids else [None] * len(parts), pa.binary()),
                    ],
                    schema=schema,
                )

    blocks = spark.read.schema(_BLOCK).parquet(f"{path}/blocks")
    docs = blocks.mapInArrow(
        decode, "file int, doc_id long, offset long, n_tokens long, ids_crc32 long, ids binary"
    )
    earlier = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    # One row per file: a broadcast as small as the list of files.
    before = (
        blocks.groupBy("file")
        .agg(F.sum("n_tokens").alias("_n"))
        .select("file", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    )
    found = docs.join(F.broadcast(before), "file").select(
        "doc_id", (F.col("_before") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32", "ids"
    )
    return found if ids else found.drop("ids")
