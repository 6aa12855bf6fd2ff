"""Connected components of a distributed edge list."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow.llm.common import cut


def _large_star(edges: DataFrame) -> DataFrame:
    """Hang every larger neighbour of a node on the node's smallest neighbour."""
    both = edges.unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    least = both.groupBy("src").agg(F.min("dst").alias("low"))
    low = F.least("low", "src")
    return (
        both.join(least, "src")
        .where(F.col("dst") > F.col("src"))
        .select(F.col("dst").alias("src"), low.alias("dst"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Hang a node and its smaller neighbours on the smallest of them."""
    least = edges.groupBy("src").agg(F.min("dst").alias("low"))
    moved = (
        edges.join(least, "src")
        .where(F.col("dst") != F.col("low"))
        .select(F.col("dst").alias("src"), F.col("low").alias("dst"))
    )
    return moved.unionByName(least.withColumnRenamed("low", "dst")).distinct()


def _state(edges: DataFrame) -> tuple:
    mixed = F.xxhash64("src", "dst")
    return tuple(
        edges.agg(
            F.count(F.lit(1)),
            F.sum(mixed.bitwiseAND(F.lit(0xFFFFFFFF))),
            F.bit_xor(mixed),
        ).first()
    )


def connected_components(
    edges: DataFrame, a: str, b: str, keep: Callable[[DataFrame], DataFrame] = cut
) -> DataFrame:
    """``(node, root)`` for every node with an edge to another; the root is its smallest node.

    Alternating large and small stars (Kiveris et al., 2014): each round is two
    groupings and two joins over the edges, and the number of rounds grows with the
    logarithm of the size of the largest component. Edges that stay are at most one
    per node once the stars form. Only a count and a checksum reach the driver.
    NULL ends and self links are ignored; an empty list gives an empty result. ``keep`` cuts the
    lineage of a round.
    """
    ends = (F.col(a), F.col(b))
    edges = keep(
        edges.where(ends[0] != ends[1])
        .select(F.greatest(*ends).alias("src"), F.least(*ends).alias("dst"))
        .distinct()
    )
    before = _state(edges)
    while before[0]:
        edges = keep(_small_star(_large_star(edges)))
        after = _state(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("dst").alias("node"), F.col("dst").alias("root")).distinct()
    return edges.select(F.col("src").alias("node"), F.col("dst").alias("root")).unionByName(roots)
