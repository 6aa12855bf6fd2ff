"""Prefix trie of conversations: member intervals by range minima over sorted common prefixes."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataflow.llm.common import stage, whole
from strataflow.operators.numbering import number_rows
from strataflow.session import scratch_path

#: Turns of a conversation in one sorted row; longer ones are rows of several segments.
SEGMENT = 1_024
#: Rows and turns that one task sorts out at a time.
BLOCK = 65_536

_TURN = "struct<a:bigint,b:bigint,bytes:bigint>"
_SEGMENT = ("seg", "top_a", "top_b", "turns", "more", "seq")
_PLACED = (
    f"pid int, blk int, at bigint, seg bigint, top_a bigint, top_b bigint, above bigint, "
    f"turns array<{_TURN}>, more boolean, seq bigint"
)
_PARTS = (
    "pid int, blk int, gain boolean, a bigint, b bigint, depth bigint, up_a bigint, up_b bigint, "
    "n bigint, low bigint, children bigint, saved bigint, leaves bigint, is_open boolean, "
    "up_open boolean, up_low bigint, ends string, ends_sha256 string"
)
_NODE = ("a", "b", "depth")
_NO_ENDS = sha256(b"").hexdigest()


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """``conv_id, pos, a, b, bytes``: the turns of each conversation, numbered from 0.

    Turns ascend (NULL first); turns of one number by role, then by a hash of their text,
    so reruns agree. NULL roles and texts are empty; rows without a ``conv_id`` are left out.
    A turn goes on as two 64-bit hashes of role and text. A conversation of any length is
    numbered over range partitions, never in one task.
    """
    spark = conversations.sparkSession
    role, text = whole(F.col("role").cast("string")), whole(F.col("text").cast("string"))
    flat = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        role.alias("role"),
        F.xxhash64(role, text).alias("a"),
        F.xxhash64(F.lit("b"), text, role).alias("b"),
        F.octet_length(text).cast("bigint").alias("bytes"),
    )
    return number_rows(
        flat, ["conv_id", "turn", "role", "a", "b"], scratch_path(spark, "trie-turns"), start=0
    ).drop("turn", "role")


def rebuilt(conversations: DataFrame, fan: int = 5, most: int = 9) -> tuple[DataFrame, DataFrame]:
    """Turns and sizes of conversations that start with turns of the first of their ``fan``.

    The first ``h`` turns, a checksum of the id modulo ``most``, are those of conversation
    ``c - c % fan`` (all if it has fewer, none if it is absent); then come the conversation's
    own turns after its first ``h``. Gives ``(seq, depth, a, b, bytes, total)`` with depths from
    0, and ``(seq, total)`` for every conversation, without turns or not.
    """
    turns = numbered_turns(conversations)
    base = F.col("conv_id") - F.col("conv_id") % fan
    heads = F.crc32(F.col("conv_id").cast("string")) % most
    convs = turns.groupBy("conv_id").agg(F.min("id").alias("first"), F.count("*").alias("n"))
    family = (
        convs.select(base.alias("base"), F.struct("conv_id", "first", "n", heads.alias("h")).alias("m"))
        .groupBy("base")
        .agg(F.collect_list("m").alias("family"))  # fewer than 2 * fan
    )
    n_base = F.coalesce(
        F.get(F.filter("family", lambda m: m["conv_id"] == F.col("base")), F.lit(0))["n"], F.lit(0)
    )
    sized = family.withColumn("n_base", n_base).withColumn(
        "family",
        F.transform(
            "family",
            lambda m: F.struct(
                m["conv_id"].alias("seq"),
                m["first"].alias("first"),
                m["h"].alias("h"),
                F.when(m["conv_id"] == F.col("base"), m["n"])
                .otherwise(F.least(m["h"], F.col("n_base")) + F.greatest(m["n"] - m["h"], F.lit(0)))
                .alias("total"),
            ),
        ),
    )
    members = stage(
        sized.select("base", "n_base", "family", F.explode("family").alias("own")), "trie-families"
    )
    own_id, pos = F.col("own.seq"), F.col("id") - F.col("own.first")
    is_base = own_id == F.col("base")
    h, shared = F.col("own.h"), F.least(F.col("own.h"), F.col("n_base"))
    kept = F.when(
        is_base | (pos >= h),
        F.array(
            F.struct(
                own_id.alias("seq"),
                F.when(is_base, pos).otherwise(pos - h + shared).alias("depth"),
                F.col("own.total").alias("total"),
            )
        ),
    ).otherwise(F.array())
    heirs = F.when(
        is_base,
        F.transform(
            F.filter("family", lambda m: (m["seq"] != F.col("base")) & (m["h"] > pos)),
            lambda m: F.struct(m["seq"].alias("seq"), pos.alias("depth"), m["total"].alias("total")),
        ),
    ).otherwise(F.array())
    met = turns.join(members.withColumn("conv_id", own_id), "conv_id")
    found = met.select(F.explode(F.concat(kept, heirs)).alias("to"), "a", "b", "bytes")
    return (
        found.select("to.seq", "to.depth", "a", "b", "bytes", "to.total"),
        members.select("own.seq", "own.total"),
    )


def _segments(turns: DataFrame, sizes: DataFrame, segment: int) -> DataFrame:
    """One row for each segment of a sequence, with the key and the bytes of the prefix above.

    A prefix has as its key the exclusive or of its turns' hashes, each mixed with its depth.
    """
    mixed = turns.select(
        "seq",
        F.expr(f"depth div {segment}L").alias("seg"),
        "depth",
        F.xxhash64("depth", "a", "b").alias("a"),
        F.xxhash64(F.lit("b"), "depth", "b", "a").alias("b"),
        "bytes",
        "total",
    )
    grouped = mixed.groupBy("seq", "seg").agg(
        F.array_sort(F.collect_list(F.struct("depth", "a", "b", "bytes"))).alias("turns"),
        F.bit_xor("a").alias("a"),
        F.bit_xor("b").alias("b"),
        F.sum("bytes").alias("bytes"),
        F.first("total").alias("total"),
    )
    rows = stage(
        grouped.withColumn(
            "turns", F.transform("turns", lambda t: F.struct(t["a"], t["b"], t["bytes"])).cast(f"array<{_TURN}>")
        ),
        "trie-segments",
    )
    earlier = Window.partitionBy("seq").orderBy("seg").rowsBetween(Window.unboundedPreceding, -1)
    none = F.lit(0).cast("bigint")

    def before(aggregate: Callable[[str], Column], name: str) -> Column:
        return F.coalesce(aggregate(name).over(earlier), none)

    more = F.col("total") > (F.col("seg") + 1) * segment
    several = F.col("total") > segment
    long = rows.where(several).select(
        "seq", "seg", before(F.bit_xor, "a").alias("top_a"), before(F.bit_xor, "b").alias("top_b"),
        before(F.sum, "bytes").alias("above"), "turns", more.alias("more"),
    )
    short = rows.where(~several).select(
        "seq", "seg", none.alias("top_a"), none.alias("top_b"), none.alias("above"), "turns",
        F.lit(False).alias("more"),
    )
    empty = sizes.where("total = 0").select(
        "seq", none.alias("seg"), none.alias("top_a"), none.alias("top_b"), none.alias("above"),
        F.array().cast(f"array<{_TURN}>").alias("turns"), F.lit(False).alias("more"),
    )
    return short.unionByName(long).unionByName(empty)


def _deal(block: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Deal the sorted rows of a partition into blocks.

    The last row of a block also goes to the next one, with the place -1, for the common
    prefix across the border; that of the partition gets the block -1.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pid, used, at, last_blk, last = TaskContext.get().partitionId(), 0, 0, 0, None

        def out(rows: pa.RecordBatch, blk: np.ndarray, place: np.ndarray) -> pa.RecordBatch:
            head = [pa.array(np.full(len(blk), pid), pa.int32()), pa.array(blk, pa.int32())]
            columns = [*head, pa.array(place, pa.int64()), *rows.columns]
            return pa.RecordBatch.from_arrays(columns, ["pid", "blk", "at", *rows.schema.names])

        for batch in batches:
            if not batch.num_rows:
                continue
            sizes = pa.compute.list_value_length(batch.column("turns")).to_numpy() + 1
            blk = (used + np.cumsum(sizes) - sizes) // block
            yield out(batch, blk, at + np.arange(len(blk)))
            if last is not None and blk[0] != last_blk:
                yield out(last, blk[:1], np.array([-1]))
            starts = np.flatnonzero(blk[1:] != blk[:-1])
            if len(starts):
                yield out(batch.take(pa.array(starts)), blk[starts + 1], np.full(len(starts), -1))
            used, at, last_blk = used + int(sizes.sum()), at + len(blk), blk[-1]
            last = batch.slice(len(blk) - 1)
        if last is not None:
            yield out(last, np.array([-1]), np.array([-1]))

    return run


def _blocks(segments: DataFrame, block: int) -> DataFrame:
    """All segments in one order, in blocks; each but the first with the row before it."""
    order = [
        F.col("more").desc() if name == "more" else F.col(name).asc() for name in _SEGMENT
    ]
    ordered = segments.repartitionByRange(*order).sortWithinPartitions(*order)
    columns = [c.split()[0] for c in _PLACED.split(", ")][3:]
    placed = stage(ordered.select(*columns).mapInArrow(_deal(block), _PLACED), "trie-sorted")
    ends = placed.where("blk = -1")
    # One number a partition; the last rows themselves stay spread.
    following = ends.select("pid", F.lead("pid").over(Window.orderBy("pid")).alias("next"))
    handed = (
        ends.join(following.where("next IS NOT NULL"), "pid")
        .withColumn("pid", F.col("next"))
        .withColumn("blk", F.lit(0))
        .select(*placed.columns)
    )
    return placed.where("blk >= 0").unionByName(handed)


class _Minima:
    """Range minima in constant time: the minima of all runs of a power of two."""

    def __init__(self, values: np.ndarray) -> None:
        self.levels = [values]
        width = 1
        while 2 * width <= len(values):
            last = self.levels[-1]
            self.levels.append(np.minimum(last[:-width], last[width:]))
            width *= 2

    def between(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """The least value of each closed range."""
        found = np.empty(len(first), np.int64)
        level = np.frexp((last - first + 1).astype(np.float64))[1] - 1
        for k in np.unique(level):
            at = np.flatnonzero(level == k)
            table = self.levels[k]
            found[at] = np.minimum(table[first[at]], table[last[at] - (1 << int(k)) + 1])
        return found


def _reach(common: _Minima, n: int, row: np.ndarray, depth: np.ndarray, step: int) -> np.ndarray:
    """How far each prefix's members extend from its row, searched by halving steps.

    ``common`` holds at each row the length of its prefix in common with the row before.
    """
    at = row.copy()
    for level in reversed(range(len(common.levels))):
        width, table = 1 << level, common.levels[level]
        first = at + 1 if step > 0 else at - width + 1
        inside = (first >= 1) & (first + width <= n)
        least = table[np.where(inside, first, 0)]
        at += np.where(inside & (least >= depth), step * width, 0)
    return at


def _sort_out(segment: int) -> Callable[[pa.Table], pa.Table]:
    """The parts of nodes whose members lie in a block, and the gains of later segments."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("at").combine_chunks()

        def column(name: str) -> np.ndarray:
            return table.column(name).to_numpy()

        lists = table.column("turns").chunk(0)
        size = np.asarray(lists.value_lengths().to_numpy(), np.int64)
        flat = lists.flatten()
        w_a, w_b, size_b = (flat.field(k).to_numpy().astype(np.int64) for k in range(3))
        seg, top_a, top_b, above = map(column, ("seg", "top_a", "top_b", "above"))
        more, seq = column("more").astype(np.int64), column("seq")
        off = np.concatenate(([0], np.cumsum(size)))
        joined_a = np.concatenate(([0], np.bitwise_xor.accumulate(w_a)))
        joined_b = np.concatenate(([0], np.bitwise_xor.accumulate(w_b)))
        bytes_to = np.concatenate(([0], np.cumsum(size_b)))

        def prefix_bytes(row: np.ndarray, depth: np.ndarray) -> np.ndarray:
            return above[row] + bytes_to[off[row] + depth] - bytes_to[off[row]]

        rows = len(size)
        common = np.full(rows, -1, np.int64)
        same = (seg[1:] == seg[:-1]) & (top_a[1:] == top_a[:-1]) & (top_b[1:] == top_b[:-1])
        for row in (np.flatnonzero(same) + 1).tolist():
            n = min(size[row - 1], size[row])
            here, last = off[row], off[row - 1]
            differs = (w_a[here : here + n] != w_a[last : last + n]) | (
                w_b[here : here + n] != w_b[last : last + n]
            )
            k = int(differs.argmax()) if n else 0
            common[row] = k if n and differs[k] else n
        passed = np.where(common >= 0, prefix_bytes(np.arange(rows), np.maximum(common, 0)), 0)
        size_before = np.concatenate(([-1], size[:-1]))
        again = (common == size) & (common == size_before)
        new = (~again).astype(np.int64) * (1 - more)
        extends = ((common >= 0) & (common == size_before) & (size > common)).astype(np.int64)

        first = 1 if column("at")[0] < 0 else 0  # the row of the block before only compares
        if first == rows:
            return pa.Table.from_pylist([], _arrow_schema())
        linked = common.copy()  # within the block
        linked[first] = -1
        depth_from = np.where(linked < 0, 0, linked + 1)
        count = np.maximum(size - depth_from + 1, 0)
        count[:first] = 0
        starts = np.concatenate(([0], np.cumsum(count)))
        row = np.repeat(np.arange(rows), count)
        depth = depth_from[row] + np.arange(len(row)) - starts[row]
        minima, least = _Minima(linked), _Minima(seq)
        right = _reach(minima, rows, row, depth, 1)
        left = _reach(minima, rows, row, depth, -1)
        low = least.between(left, right)

        def total(values: np.ndarray) -> np.ndarray:
            """Sum over the members but the first."""
            to = np.cumsum(values)
            return to[right] - to[left]

        goes_on = (common[left] >= depth) & (left == first)
        before = prefix_bytes(row, np.maximum(depth - 1, 0))
        saved = total(passed) - (right - left) * before
        saved += np.where(goes_on, passed[left] - before, 0)
        leaves = total(new) + new[left] - total(extends) - np.where(goes_on, extends[left], 0)
        # A node's parent in this block is the prefix one shorter at its own left end.
        up_depth = np.maximum(depth - 1, 0)
        up_left = _reach(minima, rows, row, up_depth, -1)
        up = starts[up_left] + up_depth - depth_from[up_left]
        born = (depth > 0) & (depth > common[row])
        children = np.bincount(up[born], minlength=len(row))
        is_open = (
            goes_on | (right == rows - 1) | (total(more) + more[left] > 0) | (depth == 0)
        )
        top = (depth == 0) & (seg[row] > 0)  # counted by the segment above
        key_a = top_a[row] ^ joined_a[off[row] + depth] ^ joined_a[off[row]]
        key_b = top_b[row] ^ joined_b[off[row] + depth] ^ joined_b[off[row]]
        ends: list[str | None] = [None] * len(row)
        digests: list[str | None] = [_NO_ENDS] * len(row)
        run_of = np.cumsum(~(again & (linked >= 0)))
        run_starts = np.flatnonzero(np.diff(run_of, prepend=-1))
        run_ends = np.append(run_starts[1:], rows)
        for start, end in zip(run_starts.tolist(), run_ends.tolist(), strict=True):
            start = max(start, first)
            if start >= end or (seg[start] > 0 and not size[start]):
                continue
            at = starts[start] + size[start] - depth_from[start]
            members = seq[start:end][more[start:end] == 0]
            if len(members):
                ends[at] = ",".join(map(str, members.tolist()))
                digests[at] = None if is_open[at] else sha256(ends[at].encode()).hexdigest()
        n = len(row)
        later = np.flatnonzero((seg > 0) & (np.arange(rows) >= first))
        zero = np.zeros(len(later), np.int64)
        gained = np.where(common[later] >= 0, passed[later] - above[later], 0)
        grown = new[later] - np.where(common[later] >= 0, extends[later], 0)

        def both(nodes: np.ndarray, gains: np.ndarray) -> pa.Array:
            return pa.array(np.concatenate((nodes, gains)))

        pid, blk = int(column("pid")[0]), int(column("blk")[0])
        lost = [None] * len(later)
        closed_ends = [None if not o else e for e, o in zip(ends, is_open.tolist(), strict=True)]
        columns = {
            "pid": np.full(n + len(later), pid, np.int32),
            "blk": np.full(n + len(later), blk, np.int32),
            "gain": both(np.zeros(n, bool), np.ones(len(later), bool)),
            "a": both(key_a, zero),
            "b": both(key_b, zero),
            "depth": both(seg[row] * segment + depth, seg[later]),
            "up_a": both(key_a[up], zero),
            "up_b": both(key_b[up], zero),
            "n": both(np.where(top, 0, right - left + 1), zero),
            "low": both(low, seq[later]),
            "children": both(children, zero),
            "saved": both(np.where(top, 0, saved), gained),
            "leaves": both(np.where(top, 0, leaves), grown),
            "is_open": both(is_open, np.zeros(len(later), bool)),
            "up_open": both(is_open[up], np.zeros(len(later), bool)),
            "up_low": both(low[up], zero),
            "ends": pa.array(closed_ends + lost, pa.string()),
            "ends_sha256": pa.array(digests + lost, pa.string()),
        }
        return pa.table(columns).cast(_arrow_schema())

    return run


def _arrow_schema() -> pa.Schema:
    kinds = {"int": pa.int32(), "bigint": pa.int64(), "boolean": pa.bool_(), "string": pa.string()}
    return pa.schema([(n, kinds[k]) for n, k in (c.split() for c in _PARTS.split(", "))])


def _spread(segment: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A segment's gains as rows of each prefix that ends in it, one segment at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                row = {name: batch.column(name)[at] for name in batch.schema.names}
                turns = row["turns"].values
                first = 0 if row["seg"].as_py() == 0 else 1  # the top belongs to the one above
                keys = [
                    np.bitwise_xor.accumulate(
                        np.append(row[f"top_{k}"].as_py(), turns.field(k).to_numpy())
                    )[first:]
                    for k in ("a", "b")
                ]
                n = len(keys[0])
                depth = row["seg"].as_py() * segment + first + np.arange(n)
                yield pa.RecordBatch.from_arrays(
                    [
                        *map(pa.array, (*keys, depth)),
                        pa.array(np.full(n, row["saved"].as_py(), np.int64)),
                        pa.array(np.full(n, row["leaves"].as_py(), np.int64)),
                    ],
                    [*_NODE, "saved", "leaves"],
                )

    return run


def _digest_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest for each node from its sorted chunks, streamed: only a hash is held."""
    node, state = None, None

    def out() -> pa.RecordBatch:
        values = [pa.array([v], pa.int64()) for v in node]
        return pa.RecordBatch.from_arrays(
            [*values, pa.array([state.hexdigest()])], [*_NODE, "ends_sha256"]
        )

    for batch in batches:
        keys = zip(*(batch.column(c).to_pylist() for c in _NODE), strict=True)
        for key, chunk in zip(keys, batch.column("ends").to_pylist(), strict=True):
            if key != node:
                if node is not None:
                    yield out()
                node, state = key, sha256()
            else:
                state.update(b",")
            state.update(chunk.encode())
    if node is not None:
        yield out()


def _gains(parts: DataFrame, segments: DataFrame, segment: int) -> DataFrame:
    """What later segments of a sequence add to the prefixes that end in its earlier ones."""
    later = Window.partitionBy("seq").orderBy(F.col("seg").desc())
    gains = (
        parts.where("gain")
        .select(F.col("low").alias("seq"), (F.col("depth") - 1).alias("seg"), "saved", "leaves")
        .withColumn("saved", F.sum("saved").over(later))
        .withColumn("leaves", F.sum("leaves").over(later))
    )
    return (
        segments.where("more")
        .join(gains, ["seq", "seg"])
        .select("seg", "top_a", "top_b", "turns", "saved", "leaves")
        .mapInArrow(
            _spread(segment), "a bigint, b bigint, depth bigint, saved bigint, leaves bigint"
        )
    )


def prefix_nodes(
    turns: DataFrame, sizes: DataFrame, segment: int = SEGMENT, block: int = BLOCK
) -> DataFrame:
    """Every node of the prefix trie of some sequences.

    ``turns`` has ``(seq, depth, a, b, bytes, total)``, depths from 0, two hashes of each turn and
    its sequence's size; ``sizes`` has ``(seq, total)`` once for each sequence, of size 0 too. A
    node is a distinct sequence of first turns, from the root at depth 0; its members are the
    sequences that start with it. Result: ``conv_id`` (least member), ``depth``, ``parent_conv_id``
    (the parent's least member, NULL at the root), ``n_convs``, ``n_children``, ``n_leaves``
    (childless nodes in its subtree, itself included), ``saved_tokens`` (over its subtree, bytes of
    a node's last turn times its members but one) and ``ends_sha256`` (digest of the decimal ids
    of the members that end there, ascending, comma-joined). No sequences give no rows.

    Sequences are sorted over all partitions and cut into blocks of bounded size. In a block,
    neighbours' common prefixes go into a sparse table, and each prefix searches its left and
    right end on its own by range minima. Prefixes across block borders leave parts that are
    summed by key; all sums are over members, so parts just add up. A hot first turn, a group
    of copies and a very long sequence spread over many blocks.
    """
    segments = stage(_segments(turns, sizes, segment), "trie-rows")
    parts = stage(
        _blocks(segments, block).groupBy("pid", "blk").applyInArrow(_sort_out(segment), _PARTS),
        "trie-parts",
    )
    nodes = parts.where("NOT gain")
    split = nodes.where("is_open")
    sums = ("n", "children", "saved", "leaves")
    none = F.lit(None).cast("bigint")
    gains = _gains(parts, segments, segment).select(
        *_NODE, F.lit(0).cast("bigint").alias("n"), none.alias("low"),
        F.lit(0).cast("bigint").alias("children"), "saved", "leaves",
    )
    merged = stage(
        split.select(*_NODE, "n", "low", "children", "saved", "leaves")
        .unionByName(gains)
        .groupBy(*_NODE)
        .agg(F.min("low").alias("low"), *[F.sum(c).alias(c) for c in sums]),
        "trie-merged",
    )
    # Where a child asks for its parent, it does so within its block: no parent is hot there.
    seen = split.select("pid", "blk", *_NODE).join(merged.select(*_NODE, "low"), list(_NODE))
    seen = seen.select(
        "pid", "blk", F.col("a").alias("up_a"), F.col("b").alias("up_b"),
        (F.col("depth") + 1).alias("depth"), F.col("low").alias("found"),
    )
    asking = nodes.where("depth > 0 AND (is_open OR up_open)")
    known = ["pid", "blk", "up_a", "up_b", "depth"]
    answered = asking.join(seen, known)
    chunks = split.where("ends IS NOT NULL").select(*_NODE, "pid", "blk", "ends")
    digests = (
        chunks.repartition(*_NODE)
        .sortWithinPartitions(*_NODE, "pid", "blk")
        .mapInArrow(_digest_chunks, "a bigint, b bigint, depth bigint, ends_sha256 string")
    )
    parents = answered.where("is_open").groupBy(*_NODE).agg(F.min("found").alias("parent"))

    def shown(rows: DataFrame, parent: Column) -> DataFrame:
        return rows.select(
            F.col("low").alias("conv_id"),
            "depth",
            parent.alias("parent_conv_id"),
            F.col("n").alias("n_convs"),
            F.col("children").alias("n_children"),
            F.col("leaves").alias("n_leaves"),
            F.col("saved").alias("saved_tokens"),
            F.coalesce("ends_sha256", F.lit(_NO_ENDS)).alias("ends_sha256"),
        )

    across = merged.join(parents, list(_NODE), "left").join(digests, list(_NODE), "left")
    return (
        shown(nodes.where("NOT is_open AND NOT up_open"), F.col("up_low"))
        .unionByName(shown(answered.where("NOT is_open"), F.col("found")))
        .unionByName(shown(across, F.col("parent")))
    )


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """The prefix trie of conversations as they are; see ``prefix_nodes``."""
    turns = numbered_turns(conversations)
    convs = turns.groupBy("conv_id").agg(F.min("id").alias("first"), F.count("*").alias("total"))
    convs = stage(convs, "trie-sizes")
    met = turns.join(convs, "conv_id").withColumn("depth", F.col("id") - F.col("first"))
    seq = F.col("conv_id").alias("seq")
    return prefix_nodes(
        met.select(seq, "depth", "a", "b", "bytes", "total"), convs.select(seq, "total")
    )
