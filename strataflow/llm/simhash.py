"""SimHash fingerprints and a binary trie self-join over them."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataflow.llm.common import stage, whole, without
from strataflow.llm.components import connected_components

BITS = 64
# Fixed value: the seed of Spark's own xxhash64.
SEED = 42
BLOCK_BITS = 16
BLOCKS = BITS // BLOCK_BITS
#: Rows of one trie that a single task joins with themselves; larger ones are dealt out in pairs.
UNIT_ROWS = 20_000
# What names a unit of work: the trie, the prefixes of both nodes, the chunks of both.
_UNIT = ("turn", "low", "high", "one", "two")
#: Depth at which the pairs of nodes become units of work, at least: some hundred units.
LEAST_DEPTH = 4
_LEAF_PAIRS = 64
_FRONTIER = 200_000


def _fingerprint(text: str, size: int) -> int:
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    if len(words) <= size:
        shingles = [line]
    else:
        starts = np.concatenate(([0], ends[:-size] + 1)).tolist()
        shingles = [line[s:e] for s, e in zip(starts, ends[size - 1 :].tolist(), strict=True)]
    digest = xxhash.xxh64_intdigest
    return majority_bits(np.fromiter((digest(s, SEED) for s in shingles), np.uint64, len(shingles)))


def majority_bits(hashes: np.ndarray) -> int:
    """The bits that are set in over half the hashes, as a signed number."""
    set_bits = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 8192):
        octets = hashes[at : at + 8192].astype(">u8").view(np.uint8).reshape(-1, 8)
        set_bits += np.unpackbits(octets, axis=1).sum(axis=0, dtype=np.int64)
    packed = np.packbits(2 * set_bits > len(hashes))
    return int(packed.view(">i8")[0])


def fingerprint(text: str | Column, size: int = 3) -> Column:
    """64-bit SimHash of the word shingles of a whole text, as a signed long.

    ASCII letters are lower-cased; repeated shingles count as often as they occur; a
    text of fewer than ``size`` words is one shingle; one without words, or NULL, has
    fingerprint zero.
    """

    @F.pandas_udf("long")
    def prints(texts: pd.Series) -> pd.Series:
        return pd.Series([_fingerprint(t, size) for t in texts], dtype="int64")

    return prints(whole(text))


def as_hex(value: Column) -> Column:
    return F.lower(F.lpad(F.hex(value), BITS // 4, "0"))


def _expand(lo_a, hi_a, lo_b, hi_b):
    """All index pairs of each node pair."""
    wide = hi_b - lo_b
    counts = (hi_a - lo_a) * wide
    owner = np.repeat(np.arange(len(counts)), counts)
    place = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    return lo_a[owner] + place // wide[owner], lo_b[owner] + place % wide[owner]


def trie_pairs(
    values: np.ndarray,
    roots: tuple[np.ndarray, ...],
    depth: int,
    budget: int,
    block_budget: int = 0,
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of values that differ in at most ``budget`` bits.

    A trie node is a range of sorted values with a common prefix. Pairs of nodes go
    down together, one bit a step: children on the same side keep the differing bits
    so far, children on opposite sides add one, and a pair over the budget is cut with
    all below it; within the first block of bits the budget is ``block_budget``. Ranges
    with few pairs left are compared at once. ``roots`` holds the first pairs: low and
    high end of either range, and the bits that their prefixes of ``depth`` bits differ in.
    """
    ones: dict[int, np.ndarray] = {}
    pending = [(depth, *roots)]
    while pending:
        level, lo_a, hi_a, lo_b, hi_b, spent = pending.pop()
        if len(lo_a) > _FRONTIER:  # depth first beyond this, so that memory stays bounded
            half = len(lo_a) // 2
            for part in (slice(half, None), slice(0, half)):
                pending.append(
                    (level, lo_a[part], hi_a[part], lo_b[part], hi_b[part], spent[part])
                )
            continue
        few = (hi_a - lo_a) * (hi_b - lo_b) <= _LEAF_PAIRS
        if level == BITS:
            few[:] = True
        if few.any():
            i, j = _expand(lo_a[few], hi_a[few], lo_b[few], hi_b[few])
            near = (i != j) & (np.bitwise_count(values[i] ^ values[j]) <= budget)
            if near.any():
                yield i[near], j[near]
        if few.all():
            continue
        lo_a, hi_a, lo_b, hi_b, spent = (x[~few] for x in (lo_a, hi_a, lo_b, hi_b, spent))
        if level not in ones:
            bit = (values >> np.uint64(BITS - 1 - level)) & np.uint64(1)
            ones[level] = np.concatenate(([0], np.cumsum(bit, dtype=np.int64)))
        below = ones[level]
        mid_a, mid_b = hi_a - (below[hi_a] - below[lo_a]), hi_b - (below[hi_b] - below[lo_b])
        twin = lo_a == lo_b
        children = (
            (lo_a, mid_a, lo_b, mid_b, spent, None),
            (mid_a, hi_a, mid_b, hi_b, spent, None),
            (lo_a, mid_a, mid_b, hi_b, spent + 1, None),
            (mid_a, hi_a, lo_b, mid_b, spent + 1, ~twin),
        )
        kept = []
        most = block_budget if level < BLOCK_BITS else budget
        for la, ha, lb, hb, used, also in children:
            keep = (la < ha) & (lb < hb) & (used <= most)
            keep &= ~((la == lb) & (ha - la == 1))
            if also is not None:
                keep &= also
            kept.append(tuple(x[keep] for x in (la, ha, lb, hb, used)))
        pending.append((level + 1, *(np.concatenate(x) for x in zip(*kept, strict=True))))


def _unite(labels: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Merge the label classes of the given pairs; a label is the smallest index of its class."""
    while True:
        a, b = labels[i], labels[j]
        apart = a != b
        if not apart.any():
            return labels
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        np.minimum.at(labels, np.maximum(a, b), np.minimum(a, b))
        while not np.array_equal(shorter := labels[labels], labels):
            labels = shorter


def _units(frames: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """Regroup sorted batches so that no unit is split between two of them."""
    held: list[pd.DataFrame] = []
    for frame in frames:
        if not len(frame):
            continue
        last = (frame[keys] == frame[keys].iloc[-1]).all(axis=1).to_numpy()
        start = len(last) - int(np.argmin(last[::-1])) if not last.all() else 0
        if start == 0 and held and (held[-1][keys].iloc[-1] == frame[keys].iloc[0]).all():
            held.append(frame)
            continue
        if start or held:
            yield pd.concat([*held, frame.iloc[:start]], ignore_index=True)
        held = [frame.iloc[start:]]
    if held:
        yield pd.concat(held, ignore_index=True)


def _forest(depth: int, budget: int, check_budget: int | None):
    keys = list(_UNIT)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for unit in _units(frames, keys):
            values = unit["rotated"].to_numpy().astype(np.int64).view(np.uint64)
            order = np.lexsort((values, unit["side"], *(unit[k] for k in reversed(keys))))
            unit, values = unit.iloc[order], values[order]
            ids = unit[keys].to_numpy()
            fresh = np.ones(len(unit) + 1, bool)
            fresh[1:-1] = (ids[1:] != ids[:-1]).any(axis=1)
            bounds = np.flatnonzero(fresh)
            lo, hi = bounds[:-1], bounds[1:]
            # A unit of two parts has the rows of the first part first (side 0).
            right = np.concatenate(([0], np.cumsum(unit["side"].to_numpy(), dtype=np.int64)))
            mid = hi - (right[hi] - right[lo])
            low, high, one, two = (unit[k].to_numpy()[lo] for k in keys[1:])
            own = (low == high) & (one == two)
            spent = np.bitwise_count(low ^ high).astype(np.int8)
            roots = (lo, np.where(own, hi, mid), np.where(own, lo, mid), hi, spent)
            filled = (roots[0] < roots[1]) & (roots[2] < roots[3])
            roots = tuple(x[filled] for x in roots)
            checks = unit["check"].to_numpy().astype(np.int64).view(np.uint64)
            labels = np.arange(len(unit))
            for i, j in trie_pairs(values, roots, depth, budget, budget // BLOCKS):
                if check_budget is not None:
                    near = np.bitwise_count(checks[i] ^ checks[j]) <= check_budget
                    i, j = i[near], j[near]
                labels = _unite(labels, i, j)
            linked = np.flatnonzero(labels != np.arange(len(unit)))
            if len(linked):
                nodes = unit["node"].to_numpy()
                yield pd.DataFrame({"a": nodes[linked], "b": nodes[labels[linked]]})

    return run


def near_links(
    prints: DataFrame,
    budget: int = 3,
    check_budget: int | None = None,
    unit_rows: int = UNIT_ROWS,
) -> DataFrame:
    """Links ``(a, b)`` that join all ``node`` whose ``fp`` are within ``budget`` bits.

    Two fingerprints within the budget differ in at most ``budget // 4`` bits in one of the
    four blocks of the word. The word is therefore rotated so that each block leads once:
    four tries, with a small budget in their first levels. The pairs of nodes at some
    depth are the units of work. With nothing to spend in a block that depth is the whole
    block; else it is chosen for about ``unit_rows`` values a node, as each node meets
    several. A node with more is dealt into chunks by hash, and each pair of chunks is a
    unit, so that a task holds a bounded number of values. A unit returns a spanning forest
    of its links, so dense groups return one link per value, not one per pair.

    With ``check_budget`` the second fingerprints ``check`` must be within it as well.
    """
    spare = budget // BLOCKS
    depth = BLOCK_BITS
    if spare:
        many = prints.count()
        depth = math.ceil(math.log2(max(many, 1) / unit_rows))
        depth = min(BLOCK_BITS, max(LEAST_DEPTH, depth))
    rotated = F.expr(
        f"shiftleft(fp, turn * {BLOCK_BITS})"
        f" | if(turn = 0, 0L, shiftrightunsigned(fp, {BITS} - turn * {BLOCK_BITS}))"
    )
    head = F.shiftrightunsigned("rotated", BITS - depth)
    check = F.lit(0).cast("bigint") if check_budget is None else F.col("check")
    turned = (
        prints.select(
            "node", "fp", check.alias("check"),
            F.explode(F.array(*[F.lit(t) for t in range(BLOCKS)])).alias("turn"),
        )
        .withColumn("rotated", rotated)
        .withColumn("head", head.cast("int"))
        .drop("fp")
    )
    # At most BLOCKS * 2^BLOCK_BITS heads exist, whatever the input: a bounded broadcast.
    crowded = (
        turned.groupBy("turn", "head")
        .agg(F.ceil(F.count(F.lit(1)) / F.lit(unit_rows)).cast("int").alias("chunks"))
        .where(F.col("chunks") > 1)
    )
    facing = crowded.select("turn", F.col("head").alias("other_head"), F.col("chunks").alias("other_chunks"))
    masks = [m for m in range(1 << depth) if m.bit_count() <= spare]
    met = (
        turned.withColumn("mask", F.explode(F.array(*[F.lit(m) for m in masks])))
        .withColumn("other_head", F.col("head").bitwiseXOR(F.col("mask")))
        .join(F.broadcast(crowded), ["turn", "head"], "left")
        .join(F.broadcast(facing), ["turn", "other_head"], "left")
        .withColumn("chunk", F.pmod(F.xxhash64("node"), F.coalesce("chunks", F.lit(1))).cast("int"))
        .withColumn(
            "other", F.explode(F.sequence(F.lit(0), F.coalesce("other_chunks", F.lit(1)) - 1))
        )
    )
    first = F.when(F.col("head") == F.col("other_head"), F.col("chunk") <= F.col("other")).otherwise(
        F.col("head") < F.col("other_head")
    )
    units = met.select(
        "node",
        "check",
        "rotated",
        "turn",
        F.least("head", "other_head").alias("low"),
        F.greatest("head", "other_head").alias("high"),
        F.when(first, F.col("chunk")).otherwise(F.col("other")).alias("one"),
        F.when(first, F.col("other")).otherwise(F.col("chunk")).alias("two"),
        (~first).cast("int").alias("side"),
    )
    return (
        units.repartition(*_UNIT)
        .sortWithinPartitions(*_UNIT)
        .mapInPandas(_forest(depth, budget, check_budget), "a long, b long")
    )


def near_groups(
    docs: DataFrame,
    size: int = 3,
    budget: int = 3,
    check_size: int | None = None,
    check_budget: int | None = None,
) -> DataFrame:
    """Every row, without its text, with its ``fp``, ``component_id`` and ``root``.

    Fingerprints of ``size`` words at ``budget`` or fewer differing bits are linked; with a
    ``check_size``, only if the fingerprints of that many words are within ``check_budget``
    too. The component is named by the smallest doc_id reachable. Each row of the input
    gives one row; rows that share a doc_id keep their own fingerprints. A NULL doc_id
    names no component that has another. NULL texts count as empty, and all texts
    without words form one component. An empty table gives an empty result. ``root``, a
    number, tells components apart where a doc_id is in several. Input columns with a
    result's name are replaced.
    """
    clear = without(docs, "fp", "check", "node", "root", "component_id")
    marked = clear.withColumn("fp", fingerprint("text", size))
    keys = ["fp"]
    if check_size is not None:
        marked, keys = marked.withColumn("check", fingerprint("text", check_size)), ["fp", "check"]
    rows = stage(marked.drop("text"), "simhash")
    prints = rows.groupBy(*keys).agg(F.min("doc_id").alias("low"))
    prints = stage(prints.withColumn("node", F.monotonically_increasing_id()), "prints")
    links = near_links(prints, budget, check_budget if check_size is not None else None)
    known = prints.join(connected_components(links, "a", "b"), "node", "left").withColumn(
        "root", F.coalesce("root", "node")
    )
    known = stage(known, "roots")
    # Names are joined to fingerprints, not to rows, and from a table of their own, so that
    # neither a hot fingerprint nor a large component is bound to one partition.
    names = stage(known.groupBy("root").agg(F.min("low").alias("component_id")), "components")
    named = known.select(*keys, "root").join(names, "root")
    return rows.join(named, keys).select(
        *[c for c in rows.columns if c != "check"], "component_id", "root"
    )


def drop_near_copies(docs: DataFrame, **options) -> DataFrame:
    """One document of each near-copy group: the one with the smallest doc_id.

    ``options`` are those of ``near_groups``. Of rows that repeat that doc_id one stays; a
    group without any doc_id keeps one row. Columns are those of the input, whatever
    their names; an empty table stays empty.
    """
    # Within a struct the input's columns cannot clash with those of the plan.
    rows = stage(
        docs.select(F.struct("*").alias("doc"), F.monotonically_increasing_id().alias("row")),
        "simhash-docs",
    )
    groups = near_groups(rows.select("doc.doc_id", "doc.text", "row"), **options)
    best = groups.groupBy("root").agg(
        F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("best")
    )
    first = best.select(F.col("best.row").alias("row"))
    return rows.join(first, "row", "left_semi").select(
        *[F.col("doc").getField(c).alias(c) for c in docs.columns]
    )
