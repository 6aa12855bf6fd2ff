"""Merkle manifest of a dataset: one root over all rows, and a proof for each row."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataflow.llm.common import stage
from strataflow.operators.numbering import number_rows
from strataflow.session import scratch_path

#: Nodes that share a parent.
FANOUT = 8
_PATH = "array<struct<before:string,after:string>>"


def digest(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of the parts, one after the other."""
    return F.sha2(F.concat(*parts), 256)


def leaf_digest(fields: Sequence[Column]) -> Column:
    """Digest of a row: each field as its UTF-8 byte count, a colon and its value, NULL as ``-``."""
    values = [f.cast("string") for f in fields]
    return digest(
        *[
            F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-"))
            for v in values
        ]
    )


def fold(path: str | Column, leaf: Column) -> Column:
    """The root that a leaf and the siblings on its path lead to."""
    path = F.col(path) if isinstance(path, str) else path
    return F.aggregate(path, leaf, lambda at, run: digest(run["before"], at, run["after"]))


def proof_digest(path: str = "path") -> Column:
    """Digest of all siblings on a path, from the leaf's run up, left to right."""
    runs = F.transform(F.col(path), lambda run: F.concat(run["before"], run["after"]))
    return F.sha2(F.array_join(runs, ""), 256)


@dataclass(frozen=True)
class _Forest:
    """Trees over the nodes of each part: the runs of every level, and one top a part."""

    runs: list[DataFrame]
    parents: list[DataFrame]
    tops: DataFrame


@dataclass(frozen=True)
class Manifest:
    """``rows``: each row with ``leaf``, ``subroot``, ``root`` and ``path``; ``nodes``: the trees."""

    rows: DataFrame
    nodes: DataFrame


def _span(level: int) -> Column:
    """Leaves below a full node of a level."""
    return F.lit(FANOUT**level).cast("bigint")


def _bucket(level: int, lo: str = "lo") -> Column:
    """Where the nodes of a level lie: each full node fills one bucket."""
    return F.expr(f"{lo} div {FANOUT**level}L")


def _forest(leaves: DataFrame, most: int, label: str) -> _Forest:
    """Build all trees upwards, a level at a time.

    A node carries the interval ``[lo, hi)`` of leaf ranks below it. The nodes of a level that
    fall in one bucket of the next level are a run; at most ``FANOUT`` rows meet in a group,
    so a hot part spreads over as many tasks as any other. Levels shrink by that factor, and
    each is a table in the shared folder. ``most`` is the size of the largest part; every
    part stops at the level where one node is left of it.
    """
    keys = ("part", "size")
    tops = [leaves.where("size = 1").select(*keys, "lo", "hi", "digest", F.lit(0).alias("level"))]
    runs, parents = [], []
    nodes, level = leaves, 0
    while FANOUT**level < most:
        child = F.struct(*[c for c in nodes.columns if c not in keys])
        grouped = nodes.where(F.col("size") > _span(level)).groupBy(
            *keys, _bucket(level + 1).alias("bucket")
        )
        run = grouped.agg(F.collect_list(child).alias("children")).withColumn(
            "children",
            F.array_sort(
                "children",
                lambda a, b: F.when(a["lo"] < b["lo"], -1).when(a["lo"] > b["lo"], 1).otherwise(0),
            ),
        )
        runs.append(stage(run, f"{label}-{level}"))
        level += 1
        nodes = runs[-1].select(
            *keys,
            F.col("children")[0]["lo"].alias("lo"),
            F.element_at("children", -1)["hi"].alias("hi"),
            F.sha2(F.array_join("children.digest", ""), 256).alias("digest"),
        )
        parents.append(nodes.withColumn("level", F.lit(level)))
        tops.append(parents[-1].where("lo = 0 AND hi = size"))
    return _Forest(runs, parents, reduce(DataFrame.unionByName, tops))


def _siblings(side: Column) -> Column:
    return F.array_join(F.transform(side, lambda c: c["digest"]), "")


def _down(runs: DataFrame, level: int, above: DataFrame) -> DataFrame:
    """The nodes of a level, each with its path: its siblings, then the path of its parent.

    Runs meet their parents in the buckets of the parents' level; a parent is the node whose
    interval contains the run's. What is left of the parent's interval without the child's
    are its siblings: those that end before it starts, and those that start where it ends.
    """
    ancestors = above.where(F.col("level") == level + 1).select(
        "part",
        _bucket(level + 1).alias("bucket"),
        F.col("lo").alias("parent_lo"),
        F.col("hi").alias("parent_hi"),
        "path",
        "subroot",
        "root",
    )
    contained = (F.col("children")[0]["lo"] >= F.col("parent_lo")) & (
        F.element_at("children", -1)["hi"] <= F.col("parent_hi")
    )
    met = runs.join(ancestors, ["part", "bucket"]).where(contained)
    child = met.withColumn("child", F.explode("children"))
    left = F.filter("children", lambda c: c["hi"] <= F.col("child.lo"))
    right = F.filter("children", lambda c: c["lo"] >= F.col("child.hi"))
    step = F.struct(_siblings(left).alias("before"), _siblings(right).alias("after"))
    return child.select(
        "part",
        "child.*",
        F.lit(level).alias("level"),
        F.concat(F.array(step), F.col("path")).alias("path"),
        "subroot",
        "root",
    )


def _with_paths(forest: _Forest, leaves: DataFrame, tops: DataFrame) -> DataFrame:
    """Every leaf with its path, from the tops of the parts down."""
    path = ("path", "subroot", "root")
    above = tops
    for level in reversed(range(len(forest.runs))):
        here = _down(forest.runs[level], level, above)
        if level:
            node = ("part", "lo", "hi", "level", *path)
            ended = tops.where(F.col("level") <= level)
            above = here.select(*node).unionByName(ended.select(*node))
        else:
            found = here.drop("level", "part")
    lone = leaves.where("size = 1").join(tops.where("level = 0").select("part", *path), "part")
    lone = lone.drop("part", "size")
    return found.unionByName(lone) if forest.runs else lone


def manifest(
    docs: DataFrame, leaf: Column, part: str, order: str, keep: Sequence[str | Column]
) -> Manifest:
    """A tree over the rows of each part, and one over the parts' roots.

    Rows ascend by ``order`` (NULL first), ties by their leaf; parts ascend by their name
    (NULL first, by UTF-8 bytes). Runs of ``FANOUT`` nodes are hashed to their parent until
    one node is left, the last run however short. A part of one row has that leaf as its
    subroot, a single part's subroot is the root; an empty table gives no rows.

    The result has the columns ``keep`` and ``leaf``, ``subroot``, ``root`` and ``path``; kept
    columns of those names are replaced. ``nodes`` holds every inner node: ``part`` (the
    number of the part in order, NULL in the tree over the parts), ``level``, its interval
    ``[lo, hi)`` of leaf ranks, or of parts, and ``digest``.
    """
    spark = docs.sparkSession
    flat = docs.select(
        F.col(part).cast("string").alias("name"),
        F.col(order).alias("place"),
        leaf.alias("digest"),
        F.struct(*keep).alias("item"),
    )
    numbered = number_rows(
        flat, ["name", "place", "digest"], scratch_path(spark, "merkle-rows"), start=0
    )
    sizes = numbered.groupBy("name").agg(
        F.min("id").alias("first"), F.count(F.lit(1)).alias("size")
    )
    parts = number_rows(
        sizes, ["name"], scratch_path(spark, "merkle-parts"), start=0, name="part", unique=True
    ).withColumnRenamed("name", "of")
    leaves = stage(
        numbered.join(parts, F.col("name").eqNullSafe(F.col("of"))).select(
            "part",
            "size",
            (F.col("id") - F.col("first")).alias("lo"),
            (F.col("id") - F.col("first") + 1).alias("hi"),
            "digest",
            "item",
        ),
        "merkle-leaves",
    )
    n_parts, most = parts.agg(F.count(F.lit(1)), F.coalesce(F.max("size"), F.lit(0))).first()
    lower = _forest(leaves, most, "merkle-runs")
    subroots = stage(
        lower.tops.select(
            F.lit(0).cast("bigint").alias("part"),
            F.lit(n_parts).cast("bigint").alias("size"),
            F.col("part").alias("lo"),
            (F.col("part") + 1).alias("hi"),
            "digest",
            F.struct("part", "size", "lo", "hi", "level").alias("item"),
        ),
        "merkle-subroots",
    )
    upper = _forest(subroots, n_parts, "merkle-parts-runs")
    roots = upper.tops.select(
        "part",
        "lo",
        "hi",
        "level",
        F.array().cast(_PATH).alias("path"),
        F.lit(None).cast("string").alias("subroot"),
        F.col("digest").alias("root"),
    )
    # A loop of small joins over the parts: written once, all levels below start from it.
    tops = stage(
        _with_paths(upper, subroots, roots).select(
            "item.part", "item.lo", "item.hi", "item.level", "path",
            F.col("digest").alias("subroot"), "root",
        ),
        "merkle-tops",
    )
    found = _with_paths(lower, leaves, tops)
    own = ("leaf", "subroot", "root", "path")
    kept = [n for n in flat.schema["item"].dataType.names if n.lower() not in own]
    rows = found.select(
        *[F.col("item")[name].alias(name) for name in kept],
        F.col("digest").alias("leaf"),
        *own[1:],
    )
    inner = [p.select("part", "level", "lo", "hi", "digest") for p in lower.parents]
    over = [
        p.select(F.lit(None).cast("bigint").alias("part"), "level", "lo", "hi", "digest")
        for p in upper.parents
    ]
    bottom = leaves.select("part", F.lit(0).alias("level"), "lo", "hi", "digest")
    return Manifest(rows, reduce(DataFrame.unionByName, inner + over, bottom))
