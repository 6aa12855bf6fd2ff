"""Stream-static enrichment and running averages."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow.functions.clock import AsOf, stamp
from strataflow.operators.averages import group_averages
from strataflow.operators.enrich import drop_shared

_SALT = "_salt"
#: Salts of a hot key for each shuffle partition, so that they spread evenly over them.
SALTS_PER_PARTITION = 4


def hot_keys(fact: DataFrame, key: str, share: float = 0.05) -> list:
    """Keys that hold more than ``share`` of all rows, at most ``1 / share`` of them.

    One grouping over all rows, combined before the shuffle; only those keys reach the
    driver. NULL joins nothing and is not among them.
    """
    counts = fact.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    total = fact.count()
    hot = counts.filter(F.col(key).isNotNull() & (F.col("_n") > F.lit(share * total)))
    return [row[0] for row in hot.select(key).collect()]


def enrich_stream(
    stream: DataFrame,
    dim: DataFrame,
    key: str,
    shared_from: str = "fact",
    hot: Sequence[Any] = (),
    salts: int | None = None,
) -> DataFrame:
    """Inner join of a stream with a static table; keeps no state.

    Spark chooses how to join. A query with state runs without adaptive execution, so
    a skewed key has to be split in the plan: rows of the ``hot`` keys are dealt out over
    ``salts`` copies of those keys' dimension rows, by default a few per shuffle
    partition. All other rows of either side stay as they are.
    """
    stream, dim = drop_shared(stream, dim, key, shared_from)
    if not hot:
        return stream.join(dim, key, "inner")
    if salts is None:
        partitions = int(stream.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        salts = SALTS_PER_PARTITION * partitions
    is_hot = F.col(key).isin(list(hot))
    # Not a hash of the content: equal messages must spread as well. The seed makes
    # a recomputed task deal its rows as before.
    spread = F.floor(F.rand(seed=salts) * salts).cast("int")
    dealt = stream.withColumn(_SALT, F.when(is_hot, spread).otherwise(0))
    every = F.when(is_hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    copies = dim.withColumn(_SALT, F.explode(every))
    return dealt.join(copies, [key, _SALT], "inner").drop(_SALT)


def running_averages(
    enriched: DataFrame,
    groups: Sequence[str],
    measures: Mapping[str, str],
    digits: int | None = None,
    exact_scale: int | None = None,
    stamp_column: str | None = "timestamp",
    as_of: AsOf = None,
    ts_type: str = "timestamp",
) -> DataFrame:
    """Averages over all rows seen so far; the state is one row per group.

    The time stamp is one value per micro-batch.
    """
    stats = group_averages(enriched, groups, measures, digits, exact_scale)
    return stats if stamp_column is None else stats.withColumn(stamp_column, stamp(as_of, ts_type))
