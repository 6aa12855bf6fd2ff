"""Dense surrogate ids without a single-partition window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_AT, _PART, _TIE = "_at", "_part", "_tie"

# monotonically_increasing_id keeps the row's place within its
# partition in the low 33 bits and the partition's number above them.
_PLACE_BITS = 33


def number_rows(
    df: DataFrame,
    order_by: Sequence[str | Column],
    staging: str,
    start: int = 1,
    name: str = "id",
    unique: bool = False,
) -> DataFrame:
    """Ids ``start, start + 1, ...`` in the given order, over any number of rows.

    The rows are range-partitioned by the order and written under ``staging`` with
    their place inside the partition. Reading that fixed copy, an id is the place
    plus the size of the partitions before it. Only those sizes, one row per
    partition, pass through one task and are broadcast.

    Ranges cannot part equal values, so rows that tie would share a task. Unless
    ``unique`` says that the order has no ties, each row first gets a tie-breaker,
    which is written too: it has to stay the same if a task runs again.
    """
    ordering, placed_at = list(order_by), f"{staging}/placed"
    columns = df.columns
    if not unique:
        tied_at = f"{staging}/tied"
        tied = df.withColumn(_TIE, F.monotonically_increasing_id())
        tied.write.mode("overwrite").parquet(tied_at)
        df = df.sparkSession.read.parquet(tied_at)
        ordering.append(_TIE)
    ordered = df.repartitionByRange(*ordering).sortWithinPartitions(*ordering)
    ordered.select(*columns, F.monotonically_increasing_id().alias(_AT)).write.mode(
        "overwrite"
    ).parquet(placed_at)
    part = F.shiftright(F.col(_AT), _PLACE_BITS)
    place = F.col(_AT).bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))
    placed = df.sparkSession.read.parquet(placed_at).withColumn(_PART, part)
    earlier = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy(_PART)
        .agg(F.count(F.lit(1)).alias("_size"))
        .select(_PART, F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_before"))
    )
    numbered = placed.join(F.broadcast(offsets), _PART)
    return numbered.select(
        (F.lit(start).cast("bigint") + F.col("_before") + place).alias(name), *columns
    )
