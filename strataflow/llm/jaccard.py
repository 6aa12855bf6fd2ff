"""Near copies: candidates by a SimHash trie join and rare lists, links by exact similarity."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataflow.llm.common import Workspace, key_filter, may_have, stage, whole
from strataflow.llm.components import connected_components
from strataflow.llm.simhash import SEED, _unite, _units, majority_bits, near_links

SIZE = 5
SIMILARITY = 0.8
#: Differing bits within which the trie join looks for near copies first.
BUDGET = 7
#: Bits of a set's parity map, at least; two sets differ in at least as many shingles as their maps in bits.
MAP_BITS = 1024
#: Bits of the maps that a task makes itself before it compares shingle by shingle; no map has more.
WIDE_BITS = 16_384
#: Members of a star that a single task compares with its centre.
STAR_ROWS = 200
#: Nodes of one component that a single task compares; larger ones are dealt out in pairs.
UNIT_ROWS = 2_000
#: The same of one list, whose rows have maps instead of texts.
LIST_ROWS = 8_000
_UNIT = ("key", "one", "two")
_PAIRS = 50_000
# Against rounding of products with the similarity.
_SLACK = 1e-9


def _shingles(text: str, size: int) -> np.ndarray:
    """Sorted hashes of the different shingles; a shorter text is one shingle."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    line = b" ".join(words)
    if len(words) <= size:
        found = {line}
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate(([0], ends[:-size] + 1)).tolist()
        found = {line[s:e] for s, e in zip(starts, ends[size - 1 :].tolist(), strict=True)}
    digest = xxhash.xxh64_intdigest
    return np.unique(np.fromiter((digest(s, SEED) for s in found), np.uint64, len(found)))


def _parity(hashes: np.ndarray, bits: int) -> bytes:
    """For each remainder by ``bits``, whether an odd number of the hashes has it."""
    odd = np.bincount((hashes % np.uint64(bits)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def _map_bits(many: int, similarity: float) -> int:
    """Bits, a power of two, in which the maps of unrelated sets of that size differ too much.

    Half the bits of crowded maps differ; that has to be over what the similarity allows.
    """
    least = math.ceil(4.5 * (1 - similarity) / (1 + similarity) * many)
    return min(WIDE_BITS, max(MAP_BITS, 1 << max(least - 1, 0).bit_length()))


def _folded(maps: list[bytes], widths: np.ndarray, bits: int) -> np.ndarray:
    """The maps in that many bits each; those of fewer are left unset.

    A remainder by half as many bits is the same for both halves of a map.
    """
    table = np.empty((len(maps), bits // 64), np.uint64)
    for wide in np.unique(widths[widths >= bits]):
        at = np.flatnonzero(widths == wide)
        words = np.frombuffer(b"".join([maps[k] for k in at]), np.uint64)
        table[at] = np.bitwise_xor.reduce(words.reshape(len(at), -1, bits // 64), axis=1)
    return table


def _sketch(text: str | Column, size: int, similarity: float) -> Column:
    """Digest, size, fingerprint and parity map of a text's shingle set, its smallest hashes.

    Sets of at least that similarity have one of these smallest hashes in common: each holds
    ``similarity`` of the other, so less than the rest of it can be missing.
    """

    @F.pandas_udf("digest long, size int, fp long, bits binary, heads array<long>")
    def sketches(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for text in texts:
            hashes = _shingles(text, size)
            many = len(hashes)
            rows.append(
                (
                    xxhash.xxh64_intdigest(hashes.tobytes(), SEED) - (1 << 63),
                    many,
                    majority_bits(hashes),
                    _parity(hashes, _map_bits(many, similarity)),
                    hashes[: many - math.ceil(similarity * many - _SLACK) + 1].view(np.int64),
                )
            )
        return pd.DataFrame(rows, columns=["digest", "size", "fp", "bits", "heads"])

    return sketches(whole(text))


def _lists(heads: DataFrame) -> DataFrame:
    """``(key, node, many)`` of the different lists of nodes that share one of their ``heads``.

    ``heads`` has (node, root, heads). Lists whose nodes all have one root are left out. All
    heads are shuffled once, with nothing but the node and its root. Texts that share a
    passage meet in one list for each of its shingles: lists of the same nodes are one,
    named by the exclusive or of their nodes' hashes.
    """
    # Dealt out before the nodes are hashed, so that the hashes are not shuffled.
    met = heads.select("node", "root", F.explode("heads").alias("head")).repartition("head")
    own = Window.partitionBy("head")
    return (
        met.select(
            F.bit_xor(F.xxhash64("node")).over(own).alias("key"),
            "node",
            F.count(F.lit(1)).over(own).alias("many"),
            F.min("root").over(own).alias("low"),
            F.max("root").over(own).alias("high"),
        )
        .where("low < high")
        .select("key", "node", "many")
        .distinct()
    )


def _dealt(rows: DataFrame, most: int) -> DataFrame:
    """Rows of (key, node, many, ...) dealt out to units: pairs of chunks of the ``many`` rows of a key."""
    chunks = F.ceil(F.col("many") / F.lit(most)).cast("int")
    met = rows.withColumn("chunk", F.pmod(F.xxhash64("node"), chunks).cast("int")).withColumn(
        "other", F.explode(F.sequence(F.lit(0), chunks - 1))
    )
    return (
        met.withColumn("one", F.least("chunk", "other"))
        .withColumn("two", F.greatest("chunk", "other"))
        .withColumn("side", (F.col("chunk") > F.col("other")).cast("int"))
        .drop("chunk", "other", "many")
        .repartition(*_UNIT)
        .sortWithinPartitions(*_UNIT, "side")
    )


def _candidates(
    unit: pd.DataFrame, maps: list[bytes], similarity: float
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs within units that sizes and parity maps allow the similarity.

    Two maps are compared in the bits of the narrower one.
    """
    sizes = unit["size"].to_numpy().astype(np.int64)
    widths = np.fromiter(map(len, maps), np.int64, len(maps)) * 8
    tables = [(int(bits), _folded(maps, widths, int(bits))) for bits in np.unique(widths)]
    ids = unit[list(_UNIT)].to_numpy()
    fresh = np.ones(len(unit) + 1, bool)
    fresh[1:-1] = (ids[1:] != ids[:-1]).any(axis=1)
    bounds = np.flatnonzero(fresh)
    lo, hi = bounds[:-1], bounds[1:]
    right = np.concatenate(([0], np.cumsum(unit["side"].to_numpy(), dtype=np.int64)))
    mid = hi - (right[hi] - right[lo])
    own = ids[lo, 1] == ids[lo, 2]
    rows = np.where(own, hi, mid) - lo
    owner = np.repeat(np.arange(len(lo)), rows)
    row = np.arange(rows.sum()) - np.repeat(np.cumsum(rows) - rows, rows) + lo[owner]
    start = np.where(own[owner], row + 1, mid[owner])
    counts = hi[owner] - start
    parts = np.cumsum(counts) // _PAIRS
    cuts = [0, *(np.flatnonzero(np.diff(parts)) + 1).tolist(), len(row)]
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        wide = counts[a:b]
        i = np.repeat(row[a:b], wide)
        j = np.arange(wide.sum()) - np.repeat(np.cumsum(wide) - wide - start[a:b], wide)
        near = np.minimum(sizes[i], sizes[j]) >= similarity * np.maximum(sizes[i], sizes[j]) - _SLACK
        i, j = i[near], j[near]
        narrow = np.minimum(widths[i], widths[j])
        for bits, table in tables:
            here = np.flatnonzero(narrow == bits)
            # Wider maps, fewer pairs at a time.
            step = max(_PAIRS * MAP_BITS // bits, 1)
            for at in range(0, len(here), step):
                p, q = i[here[at : at + step]], j[here[at : at + step]]
                apart = np.bitwise_count(table[p] ^ table[q]).sum(axis=1, dtype=np.int64)
                most = (1 - similarity) * (sizes[p] + sizes[q]) + _SLACK
                near = apart * (1 + similarity) <= most
                if near.any():
                    yield p[near], q[near]


def _alike(one: np.ndarray, other: np.ndarray, similarity: float) -> bool:
    """Whether two sets have the similarity."""
    both = np.concatenate((one, other))
    both.sort()
    shared = np.count_nonzero(both[1:] == both[:-1])
    return bool(shared >= similarity * (len(both) - shared) - _SLACK)


def _starred(similarity: float, size: int):
    """Members that are similar to the centre of their star, which comes before them."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        centre = np.array([], np.uint64)
        for frame in frames:
            held = []
            for node, key, text in zip(frame["node"], frame["key"], frame["text"], strict=True):
                hashes = _shingles(text, size)
                if node == key:
                    centre = hashes
                elif _alike(centre, hashes, similarity):
                    held.append((node, key))
            if held:
                yield pd.DataFrame(held, columns=["a", "b"])

    return run


def _texts_of(texts: DataFrame, nodes: DataFrame) -> DataFrame:
    """The texts joined to the rows of ``nodes``, a small part of all.

    Other texts do not meet them in a shuffle, however many the nodes are.
    """
    return may_have(texts, "node", key_filter(nodes, "node")).join(nodes, "node")


def _star_links(work: Workspace, texts: DataFrame, prints: DataFrame, size: int, similarity: float) -> DataFrame:
    """Verified links ``(a, b)`` between nodes that the trie join brings together.

    Each of its components is a star: members are compared with its least node alone, so
    a text is sent once, however many near copies there are; only the centre goes to
    every chunk of its members. A member that is similar to another one but not to the
    centre is left to the lists.
    """
    stars = work.stage(
        connected_components(near_links(prints, BUDGET), "a", "b", keep=work.stage)
        .withColumnRenamed("root", "key")
    )
    many = work.stage(
        stars.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / F.lit(STAR_ROWS)).cast("int").alias("chunks"))
    )
    own = F.array(F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int"))
    every = F.sequence(F.lit(0), F.col("chunks") - 1)
    placed = work.stage(
        stars.join(many, "key").select(
            "key", "node", F.explode(F.when(F.col("node") == F.col("key"), every).otherwise(own)).alias("chunk")
        )
    )
    # A star has its centre first, which has its least node.
    return (
        _texts_of(texts, placed)
        .repartition("key", "chunk")
        .sortWithinPartitions("key", "chunk", "node")
        .mapInPandas(_starred(similarity, size), "a long, b long")
    )


def _linked(similarity: float, size: int | None = None):
    """Spanning forests of the candidates in a unit; with a ``size``, of those that hold.

    Nodes of one ``root`` are linked already and are not compared. A class in which
    roots have met is returned as a whole.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for unit in _units(frames, list(_UNIT)):
            nodes = unit["node"].to_numpy()
            sets = None if size is None else [_shingles(t, size) for t in unit["text"]]
            # A list's classes are its own: a node can be in several lists of these rows.
            ids = unit[[*_UNIT, "root"]]
            number = ids.groupby([*_UNIT, "root"], sort=False).ngroup().to_numpy()
            _, first = np.unique(number, return_index=True)
            start = first[number]
            labels = start.copy()
            maps = list(unit["bits"]) if sets is None else [_parity(x, WIDE_BITS) for x in sets]
            for i, j in _candidates(unit, maps, similarity):
                # A few thousand at a time, so that what is joined already is not compared.
                for at in range(0, len(i), 2048):
                    a, b = i[at : at + 2048], j[at : at + 2048]
                    apart = labels[a] != labels[b]
                    a, b = a[apart], b[apart]
                    if sets is not None:
                        pairs = zip(a.tolist(), b.tolist(), strict=True)
                        holds = np.array([_alike(sets[x], sets[y], similarity) for x, y in pairs], bool)
                        a, b = a[holds], b[holds]
                    labels = _unite(labels, a, b)
            met = np.zeros(len(unit), bool)
            met[labels[start != labels]] = True
            linked = np.flatnonzero(met[labels] & (labels != np.arange(len(unit))))
            if len(linked):
                yield pd.DataFrame({"a": nodes[linked], "b": nodes[labels[linked]]})

    return run


def similar_groups(
    rows: DataFrame, size: int = SIZE, similarity: float = SIMILARITY, work: Workspace | None = None
) -> DataFrame:
    """``row`` and ``root`` of each row of (row, doc_id, text), linked by exact similarity.

    Texts are linked whose sets of shingles of ``size`` words have at least that Jaccard
    similarity; ``root`` names the component. The search misses none and every link is
    checked. Equal sets are one node.

    Fingerprints of the sets meet in the trie join first; what is similar to the centre of
    its star is linked. The rest is complete by prefixes: two similar sets share one
    of their smallest hashes, so nodes meet in the lists of these. Lists whose nodes
    are all linked already go unread, which leaves few of those of near copies, and of lists
    with the same nodes one is read. In these
    sizes and parity maps, which bound the similarity from above, rule out most pairs.
    Components of the rest are small, and only these are compared shingle by shingle. Lists
    and components are dealt out in chunks, and a unit returns a spanning forest, not
    its pairs. With a ``work``, staged tables are its own, and the result has to be used
    before it ends; else they stay.
    """
    if work is None:
        work = Workspace(rows.sparkSession, "similar")
    marked = work.stage(
        rows.select("row", _sketch("text", size, similarity).alias("of")).select("row", "of.*")
    )
    # Equal sets have equal sketches; the rest of a node is that of its least row.
    nodes = work.stage(marked.groupBy("digest", "size").agg(F.min("row").alias("node")))
    first = nodes.select(F.col("node").alias("row"))
    own = marked.join(first, "row", "left_semi").withColumnRenamed("row", "node")
    texts = rows.select(F.col("row").alias("node"), whole("text").alias("text"))
    stars = work.stage(_star_links(work, texts, own.select("node", "fp"), size, similarity))
    # A star's links all lead to its centre, so they name its members' root.
    roots = stars.select(F.col("a").alias("node"), F.col("b").alias("root"))
    rooted = own.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    lists = work.stage(_lists(rooted.select("node", "root", "heads")))
    maps = work.stage(rooted.select("node", "root", "size", "bits"))
    sets = work.stage(marked.select("row", "digest", "size"))
    work.drop(marked)
    maybe = _dealt(lists.join(maps, "node"), LIST_ROWS).mapInPandas(_linked(similarity), "a long, b long")
    groups = work.stage(
        connected_components(maybe, "a", "b", keep=work.stage).withColumnRenamed("root", "key")
    )
    members = work.stage(groups.groupBy("key").agg(F.count(F.lit(1)).alias("many")))
    found = work.stage(groups.join(members, "key").join(maps.drop("bits"), "node"))
    links = _dealt(_texts_of(texts, found), UNIT_ROWS).mapInPandas(
        _linked(similarity, size), "a long, b long"
    )
    ends = connected_components(stars.unionByName(links), "a", "b", keep=work.stage)
    known = work.stage(
        nodes.join(ends, "node", "left").select(
            "digest", "size", F.coalesce("root", "node").alias("root")
        )
    )
    return sets.join(known, ["digest", "size"]).select("row", "root")


def drop_similar(docs: DataFrame, size: int = SIZE, similarity: float = SIMILARITY) -> DataFrame:
    """One document of each group of similar ones: the one with the smallest doc_id.

    Groups are those of ``similar_groups``. Of rows that repeat that doc_id one stays; a
    group without any doc_id keeps one row. NULL texts count as empty, and texts without
    words are alike. Columns are those of the input; an empty table stays empty. Of the
    staged tables only the rows and the list of those that go outlive the call.
    """
    # Within a struct the input's columns cannot clash with those of the plan.
    rows = stage(
        docs.select(F.struct("*").alias("doc"), F.monotonically_increasing_id().alias("row")),
        "similar-docs",
    )
    with Workspace(docs.sparkSession, "similar") as work:
        groups = similar_groups(rows.select("row", "doc.text"), size, similarity, work)
        named = work.stage(groups.join(rows.select("row", "doc.doc_id"), "row"))
        best = named.groupBy("root").agg(
            F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("best")
        )
        kept = best.select(F.col("best.row").alias("row"))
        gone = stage(named.select("row").join(kept, "row", "left_anti"), "similar-gone")
    # Rows that surely stay are not shuffled.
    marks = key_filter(gone, "row")
    stay = may_have(rows, "row", marks, have=False).unionByName(
        may_have(rows, "row", marks).join(gone, "row", "left_anti")
    )
    return stay.select(
        *[F.col("doc").getField(c).alias(c) for c in docs.columns]
    )
