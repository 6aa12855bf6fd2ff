"""Sharding by a histogram sort. DataFrame functions only."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataflow.llm.common import stage, whole, without
from strataflow.operators.numbering import number_rows
from strataflow.session import scratch_path

SHARDS = 16
#: Bytes that a splitter may miss its mark by, as a share of a shard.
TOLERANCE = 0.001
#: Bits by which one round of counting refines a boundary.
STEP_BITS = 8
_LONG_BITS = 64
# The key of a row, part after part: equal texts lie together, and repeats have an order.
_KEY = ("_text", "_id", "_row")


@dataclass(frozen=True)
class _Range:
    """Keys whose first parts are ``fixed`` and whose next part starts with ``depth`` given bits."""

    fixed: tuple[int, ...] = ()
    depth: int = 0
    bits: int = 0

    @property
    def part(self) -> Column:
        return F.col(_KEY[len(self.fixed)])

    def holds(self) -> Column:
        inside = F.lit(True)
        for name, value in zip(_KEY, self.fixed, strict=False):
            inside &= F.col(name) == value
        if self.depth:
            inside &= F.shiftrightunsigned(_unsigned(self.part), _LONG_BITS - self.depth) == self.bits
        return inside

    def bucket(self) -> Column:
        shifted = F.shiftrightunsigned(_unsigned(self.part), _LONG_BITS - self.depth - STEP_BITS)
        return shifted.bitwiseAND(F.lit((1 << STEP_BITS) - 1))

    def edge(self, bucket: int) -> tuple[int, ...]:
        """Smallest key, as far as it is decided, of a bucket; past the last one, of what follows."""
        rest = _LONG_BITS - self.depth - STEP_BITS
        unsigned = ((self.bits << STEP_BITS) + bucket) << rest
        if unsigned >> _LONG_BITS:
            return (*self.fixed[:-1], self.fixed[-1] + 1) if self.fixed else (1 << 63,)
        return (*self.fixed, unsigned - (1 << (_LONG_BITS - 1)))

    def below(self, bucket: int) -> _Range | None:
        """The bucket's own range, None once no bit of the key is left."""
        bits, depth = (self.bits << STEP_BITS) + bucket, self.depth + STEP_BITS
        if depth < _LONG_BITS:
            return replace(self, depth=depth, bits=bits)
        fixed = (*self.fixed, bits - (1 << (_LONG_BITS - 1)))
        return _Range(fixed) if len(fixed) < len(_KEY) else None


def _unsigned(value: Column) -> Column:
    """The long with its sign bit turned: unsigned order is then its order."""
    return value.bitwiseXOR(F.lit(-(1 << 63)))


def find_splitters(
    rows: DataFrame, shards: int = SHARDS, tolerance: float = TOLERANCE
) -> list[tuple[int, ...]]:
    """Keys that part the rows into shards of nearly equal bytes.

    Each round counts the exact bytes between the probes of all open splitters in one
    grouping over all rows, at most ``(shards - 1) * 2 ** STEP_BITS`` sums. A splitter is
    done once a probe lies within the tolerance of its mark; else its range shrinks to the
    bucket that holds the mark. The key ends with a row number, so even rows that agree in
    everything can be parted.
    """
    total = rows.agg(F.sum("size")).first()[0] or 0
    slack = tolerance * total / shards
    open_ranges = {k: (_Range(), 0) for k in range(1, shards)} if total else {}
    found: dict[int, tuple[int, ...]] = {}
    while open_ranges:
        ranges = sorted(set(r for r, _ in open_ranges.values()), key=repr)
        probe = None
        for at, span in enumerate(ranges):
            key = F.struct(F.lit(at).alias("at"), span.bucket().alias("bucket"))
            probe = F.when(span.holds(), key) if probe is None else probe.when(span.holds(), key)
        sums: dict[_Range, dict[int, int]] = {r: {} for r in ranges}
        counted = rows.select(probe.alias("probe"), "size").where("probe is not null")
        for row in counted.groupBy("probe.at", "probe.bucket").agg(F.sum("size").alias("n")).collect():
            sums[ranges[row["at"]]][int(row["bucket"])] = row["n"]
        for k, (span, before) in list(open_ranges.items()):
            mark, low = k * total / shards, before
            for bucket in sorted(sums[span]):
                high = low + sums[span][bucket]
                if high >= mark:
                    break
                low = high
            near = min((abs(low - mark), bucket), (abs(high - mark), bucket + 1))
            inner = span.below(bucket)
            if near[0] <= slack or inner is None:
                found[k] = span.edge(near[1])
                del open_ranges[k]
            else:
                open_ranges[k] = (inner, low)
    return [found[k] for k in sorted(found)]


def _at_least(splitter: tuple[int, ...]) -> Column:
    """Whether a row's key is not below the splitter; undecided parts count as smallest."""
    reached = F.lit(True)
    for name, value in reversed(list(zip(_KEY, splitter, strict=False))):
        if value >= 1 << 63:  # past every long
            reached = F.lit(False)
        else:
            reached = (F.col(name) > value) | ((F.col(name) == value) & reached)
    return reached


def _shard(splitters: list[tuple[int, ...]]) -> Column:
    shard = F.lit(0)
    for splitter in splitters:
        shard += _at_least(splitter).cast("int")
    return shard.cast("int")


def _keyed(docs: DataFrame) -> DataFrame:
    text = whole("text")
    return (
        docs.withColumn("size", (F.octet_length(text) + 1).cast("bigint"))
        .withColumn("_text", F.xxhash64(text))
        .withColumn("_id", F.xxhash64("doc_id"))
        .withColumn("_row", F.monotonically_increasing_id())
    )


def shard_documents(
    docs: DataFrame, shards: int = SHARDS, tolerance: float = TOLERANCE
) -> DataFrame:
    """Every row, without its text, with ``size``, ``text_crc32``, ``shard`` and ``slot``.

    Shards get nearly equal bytes (a text's UTF-8 bytes plus one). Rows are ordered by
    the hash of their text, then of their doc_id, so copies lie together, in one shard
    or, where a splitter falls among them, in neighbouring ones: a group of copies may be
    larger than a shard. Only splitters and counts by shard reach the driver. One exchange
    by ranges then sorts the rows, and ``slot`` numbers a shard's rows from 0 in order.

    NULL texts have size 1 and the checksum of nothing. NULL and repeated doc_ids are
    ordinary keys; rows that agree in all are parted by their place in the input. An
    empty table gives an empty result.
    """
    clear = without(docs, "size", "text_crc32", "shard", "slot")
    narrow = _keyed(clear).withColumn("text_crc32", F.crc32(whole("text"))).drop("text")
    rows = stage(narrow, "sharding")
    sharded = rows.withColumn("shard", _shard(find_splitters(rows, shards, tolerance)))
    counts = {r["shard"]: r["count"] for r in sharded.groupBy("shard").count().collect()}
    first, starts = 0, []
    for k in range(shards):
        starts.append(F.lit(first).cast("bigint"))
        first += counts.get(k, 0)
    numbered = number_rows(
        sharded,
        order_by=["shard", *_KEY],
        staging=scratch_path(docs.sparkSession, "sharding-order"),
        start=0,
        name="_place",
        unique=True,
    )
    slot = F.col("_place") - F.element_at(F.array(*starts), F.col("shard") + 1)
    kept = [c for c in clear.columns if c != "text"]
    return numbered.select(
        *[F.col(f"`{c}`") for c in kept], "size", "text_crc32", "shard", slot.alias("slot")
    )


def write_shards(
    docs: DataFrame, path: str, shards: int = SHARDS, tolerance: float = TOLERANCE
) -> None:
    """Write whole documents into one folder per shard, with one exchange of the texts."""
    rows = _keyed(without(docs, "size", "shard"))
    splitters = find_splitters(
        stage(rows.select(*_KEY, "size"), "sharding"), shards, tolerance
    )
    rows.withColumn("shard", _shard(splitters)).repartitionByRange("shard", *_KEY).drop(
        *_KEY, "size"
    ).write.partitionBy("shard").parquet(path)
