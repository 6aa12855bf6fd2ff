"""Near-duplicate vectors by counting collisions of one-dimensional projections."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataflow.llm.common import stage, without
from strataflow.llm.components import connected_components

COSINE = 0.93
#: Share of the pairs at exactly the least cosine that the collision count lets through.
RECALL = 0.995
#: Collisions that make a pair a candidate.
COLLISIONS = 2
#: Vectors of a label that share a sign cell, about.
CELL_ROWS = 16
#: Half width of a window, in deviations of a projected pair at the least cosine.
WINDOW = 1.5
_MOST_BITS = 24
_SEED = 20_240


def window_width(cosine: float) -> float:
    """Half width of the window around a query's projection."""
    return WINDOW * math.sqrt(2 - 2 * cosine)


def calibrated_tables(bits: int, cosine: float = COSINE, recall: float = RECALL) -> int:
    """Fewest projections that give a pair at ``cosine`` enough collisions, almost surely.

    Such a pair agrees in one sign with 1 - angle / pi, and its projections differ by a
    normal variable, so it collides in a table with p = agree ** bits * P(window). Its
    count is binomial; closer pairs collide more often.
    """
    agree = 1 - math.acos(cosine) / math.pi
    hit = agree**bits * math.erf(WINDOW / math.sqrt(2))
    tables = COLLISIONS
    while True:
        fewer = sum(
            math.comb(tables, k) * hit**k * (1 - hit) ** (tables - k) for k in range(COLLISIONS)
        )
        if 1 - fewer >= recall:
            return tables
        tables += 1


def usable(vector: str, label: str) -> Column:
    """Whether a vector may link: a label, all components finite, not all zero."""
    finite = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    some = F.exists(vector, lambda x: x != 0)
    return F.coalesce(F.col(label).isNotNull() & finite & some, F.lit(False))


def _doubles(vector: str) -> Column:
    return F.transform(vector, lambda x: x.cast("double"))


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def _projections(cosine: float, recall: float):
    width = window_width(cosine)

    def directions(size: int, bits: int) -> np.ndarray:
        tables = calibrated_tables(bits, cosine, recall)
        dice = np.random.default_rng([_SEED, size, bits])
        return dice.standard_normal((tables, bits + 1, size))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict[tuple[int, int], np.ndarray] = {}
        for frame in frames:
            for (size, bits), rows in frame.groupby(["size", "bits"]):
                if (size, bits) not in known:
                    known[size, bits] = directions(size, bits)
                axes = known[size, bits]
                for at in range(0, len(rows), 1024):
                    some = rows.iloc[at : at + 1024]
                    units = np.stack(some["vector"].to_numpy()).astype(np.float64)
                    # Scaled by the largest component first, so that no square overflows.
                    units /= np.abs(units).max(axis=1, keepdims=True)
                    units /= np.linalg.norm(units, axis=1, keepdims=True)
                    shape = (len(some), *axes.shape[:2])
                    lines = (units @ axes.reshape(-1, size).T).reshape(shape)
                    signs = lines[:, :, 1:] > 0
                    cells = signs @ (1 << np.arange(bits, dtype=np.int64))
                    values = lines[:, :, 0]
                    count = len(some) * len(axes)
                    yield pd.DataFrame(
                        {
                            "node": np.repeat(some["node"].to_numpy(), len(axes)),
                            "label": np.repeat(some["label"].to_numpy(), len(axes)),
                            "size": np.full(count, size, np.int32),
                            "list": np.tile(np.arange(len(axes), dtype=np.int32), len(some)),
                            "cell": cells.reshape(-1),
                            "slot": np.floor(values / width).astype(np.int64).reshape(-1),
                            "value": values.reshape(-1),
                        }
                    )

    return run


def near_pairs(
    nodes: DataFrame, cosine: float = COSINE, recall: float = RECALL
) -> DataFrame:
    """Links ``(a, b)`` between different vectors of ``nodes`` (node, label, vector).

    Each vector is projected on many random lines. A list holds the vectors of one
    label, length and line, and within it of one cell of random signs, in order of
    their projections; the number of signs grows with the logarithm of the label's size,
    so that a window holds about as many vectors whatever the input. The window of a
    query reaches ``window_width`` to either side. Windows become equi-joins on slots of
    that width: a pair lies in one slot or in neighbouring ones. Pairs that collide in
    ``COLLISIONS`` lists are verified by their cosine in double precision.
    """
    kinds = nodes.groupBy("label", "size").agg(F.count(F.lit(1)).alias("many"))
    bits = F.least(
        F.greatest(F.ceil(F.log2(F.col("many") / F.lit(CELL_ROWS))), F.lit(0)), F.lit(_MOST_BITS)
    )
    kinds = kinds.select("label", "size", bits.cast("int").alias("bits"))
    lists = nodes.join(kinds, ["label", "size"]).select("node", "label", "size", "vector", "bits")
    label_type = nodes.schema["label"].dataType.simpleString()
    projected = stage(
        lists.mapInPandas(
            _projections(cosine, recall),
            f"node long, label {label_type}, size int, list int, cell long, slot long, value double",
        ),
        "projections",
    )
    key = ["label", "size", "list", "cell"]
    left = projected.select(
        F.xxhash64(*key, "slot").alias("at"), F.col("node").alias("n1"), F.col("value").alias("v1")
    )
    right = projected.select(
        F.explode(F.array(F.col("slot"), F.col("slot") - 1)).alias("to"), *key, "slot", "node", "value"
    ).select(
        F.xxhash64(*key, "to").alias("at"),
        (F.col("to") == F.col("slot")).alias("same"),
        F.col("node").alias("n2"),
        F.col("value").alias("v2"),
    )
    close = F.abs(F.col("v1") - F.col("v2")) <= F.lit(window_width(cosine))
    once = ~F.col("same") | (F.col("n1") < F.col("n2"))
    candidates = (
        left.join(right, "at")
        .where(close & once & (F.col("n1") != F.col("n2")))
        .groupBy(F.least("n1", "n2").alias("a"), F.greatest("n1", "n2").alias("b"))
        .agg(F.count(F.lit(1)).alias("hits"))
        .where(F.col("hits") >= COLLISIONS)
    )
    full = nodes.select("node", "label", "size", _doubles("vector").alias("vector"))
    full = full.withColumn("norm", F.sqrt(_dot(F.col("vector"), F.col("vector"))))
    one, two = (
        full.select(*[F.col(c).alias(f"{c}_{k}") for c in full.columns]) for k in "ab"
    )
    verified = (
        candidates.join(one, F.col("a") == F.col("node_a"))
        .join(two, F.col("b") == F.col("node_b"))
        .where(F.col("label_a") == F.col("label_b"))
        .where(F.col("size_a") == F.col("size_b"))
        .where(
            _dot(F.col("vector_a"), F.col("vector_b")) / (F.col("norm_a") * F.col("norm_b"))
            >= F.lit(cosine)
        )
    )
    return verified.select("a", "b")


def near_vectors(
    rows: DataFrame,
    cosine: float = COSINE,
    recall: float = RECALL,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
) -> DataFrame:
    """Every row, without its vector, with ``n_links``, ``component_id`` and ``kept``.

    Rows link where their labels are equal and their cosine is at least ``cosine``. Equal
    vectors of a label are one node, so a group of copies of any size takes part once
    and counts in full; different vectors are searched by ``near_pairs``, which misses a
    pair at the least cosine with 1 - ``recall`` and finds closer ones more surely.
    ``component_id`` is the smallest id reachable and ``kept`` tells that it is the row's
    own. Rows without a label, and vectors that are NULL, empty, zero or hold a NULL or
    non-finite component, link with nothing and are kept, as are vectors of different
    lengths among each other. A NULL id names no component that has another. Input columns
    with a result's name are replaced. An empty table gives an empty result.
    """
    clear = without(rows, "n_links", "component_id", "kept")
    digest = F.sha2(
        F.concat_ws(",", F.transform(vector, lambda x: (x + F.lit(0.0)).cast("string"))), 256
    )
    known = (
        clear.withColumn("_usable", usable(vector, label))
        .withColumn("_digest", F.when(F.col("_usable"), digest))
    )
    nodes = stage(
        known.where("_usable")
        .groupBy(F.col(label).alias("label"), F.col("_digest").alias("digest"))
        .agg(
            F.first(vector).alias("vector"),
            F.count(F.lit(1)).alias("copies"),
            F.min(vec_id).alias("low"),
        )
        .withColumn("size", F.size("vector"))
        .withColumn("node", F.monotonically_increasing_id()),
        "vectors",
    )
    links = stage(near_pairs(nodes.select("node", "label", "size", "vector"), cosine, recall), "links")
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    copies = nodes.select(F.col("node").alias("b"), "copies")
    others = both.join(copies, "b").groupBy("a").agg(F.sum("copies").alias("others"))
    roots = connected_components(links, "a", "b")
    named = (
        nodes.select("node", "label", "digest", "copies", "low")
        .join(others.withColumnRenamed("a", "node"), "node", "left")
        .join(roots, "node", "left")
        .withColumn("root", F.coalesce("root", "node"))
    )
    names = named.groupBy("root").agg(F.min("low").alias("component"))
    found = named.join(names, "root").select(
        F.col("label").alias("_label"),
        F.col("digest").alias("_of"),
        (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("_links"),
        "component",
    )
    joined = known.drop(vector).join(
        found, (F.col(label) == F.col("_label")) & (F.col("_digest") == F.col("_of")), "left"
    )
    component = F.when(F.col("_usable"), F.col("component")).otherwise(F.col(vec_id))
    return joined.select(
        *[F.col(f"`{c}`") for c in clear.columns if c != vector],
        F.coalesce("_links", F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component_id"),
        F.col(vec_id).eqNullSafe(component).alias("kept"),
    )
