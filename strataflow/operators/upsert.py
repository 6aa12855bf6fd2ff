"""Keyed counters."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataflow.functions.clock import AsOf, stamp


HITS = "_hits"


def count_hits(hits: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Number of hits by key, NULL keys among them."""
    return hits.groupBy(*keys).agg(F.count(F.lit(1)).alias(HITS))


def upsert_counter(
    target: DataFrame,
    hits: DataFrame,
    keys: Sequence[str],
    as_of: AsOf = None,
    count: str = "count",
    created: str = "created_at",
    updated: str = "updated_at",
    identity: str = "id",
    hit_count: str | None = None,
) -> DataFrame:
    """The counter table after adding one per row of ``hits``, or its ``hit_count``.

    A known key is raised and touched, a new one inserted, the others left as they
    were. Both inputs go through a single grouping: it sums a hot key's hits inside
    each task first, and the two tables need no join. A NULL key or a key that
    ``target`` holds twice raises, since neither identifies a counter. Where the
    table has an ``identity`` column, a new counter's is that of its hits, else NULL.
    """
    kept = [created, updated, *[c for c in target.columns if c == identity]]
    now = stamp(as_of, target.schema[updated].dataType.simpleString())
    stored = target.select(
        *keys, *kept, F.col(count).cast("bigint").alias("_stored"),
        F.lit(1).alias("_rows"), F.lit(0).cast("bigint").alias(HITS),
    )

    def given(name: str) -> Column:
        known = F.col(name) if name == identity and name in hits.columns else F.lit(None)
        return known.cast(target.schema[name].dataType).alias(name)

    weight = F.lit(1) if hit_count is None else F.col(hit_count)
    added = hits.select(
        *keys, *[given(c) for c in kept],
        F.lit(0).cast("bigint").alias("_stored"),
        F.lit(0).alias("_rows"), weight.cast("bigint").alias(HITS),
    )
    merged = stored.unionByName(added).groupBy(*keys).agg(
        *[F.max(c).alias(c) for c in kept],
        *[F.sum(c).alias(c) for c in ("_stored", "_rows", HITS)],
    )
    bad_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    total = (
        F.when(bad_key, F.raise_error(F.lit("NULL in a counter key")).cast("bigint"))
        .when(
            F.col("_rows") > 1,
            F.raise_error(F.lit("counter key stored more than once")).cast("bigint"),
        )
        .otherwise(F.col("_stored") + F.col(HITS))
    )
    return merged.select(
        *kept[2:],
        *keys,
        total.alias(count),
        F.when(F.col("_rows") == 0, now).otherwise(F.col(created)).alias(created),
        F.when(F.col(HITS) > 0, now).otherwise(F.col(updated)).alias(updated),
    )
