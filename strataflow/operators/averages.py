"""Grouped averages over an enriched fact table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataflow.functions.clock import AsOf, stamp
from strataflow.operators.cleaning import measured_rows
from strataflow.operators.enrich import drop_shared

_WEIGHT = "_fact_rows"


# Digits of an exact measure, and of a number of rows: their product has 38, the most there are.
_DIGITS, _WEIGHT_DIGITS = 24, 13
_MOST_SCALE = 12


def _exact_mean(measure: Column, scale: int, weight: Column | None = None) -> Column:
    """Mean of decimal sums; NaN where a measure of the group is not finite.

    A value with more than ``24 - scale`` digits before the point ends the job.
    """
    if not 0 <= scale <= _MOST_SCALE:
        raise ValueError(f"exact_scale must be from 0 to {_MOST_SCALE}, got {scale}")
    value = measure.cast("double")
    is_odd = F.isnan(value) | (F.abs(value) == float("inf"))
    exact = F.when(~is_odd, measure).cast(f"decimal({_DIGITS},{scale})")
    if weight is None:
        total, rows = F.sum(exact), F.count(exact)
    else:
        total = F.sum(exact * weight.cast(f"decimal({_WEIGHT_DIGITS},0)"))
        rows = F.sum(F.when(exact.isNotNull(), weight))
    mean = F.try_divide(total.cast("double"), rows)
    return F.when(F.max(is_odd), F.lit(float("nan"))).otherwise(mean)


def average(
    measure: Column, digits: int | None = None, exact_scale: int | None = None
) -> Column:
    """Average of a measure.

    ``exact_scale`` sums as decimals of that many places, for a measure known to
    have no more: the result then does not depend on the order of the rows. A NaN or an
    infinity in a group then makes its average NaN. ``digits`` rounds half up.
    """
    mean = F.avg(measure) if exact_scale is None else _exact_mean(measure, exact_scale)
    return mean if digits is None else F.round(mean, digits)


def _weighted_average(
    measure: Column, weight: Column, digits: int | None, exact_scale: int | None
) -> Column:
    if exact_scale is None:
        rows = F.sum(F.when(measure.isNotNull(), weight))
        mean = F.try_divide(F.sum(measure * weight), rows)
    else:
        mean = _exact_mean(measure, exact_scale, weight)
    return mean if digits is None else F.round(mean, digits)


def group_averages(
    df: DataFrame,
    groups: Sequence[str],
    measures: Mapping[str, str],
    digits: int | None = None,
    exact_scale: int | None = None,
) -> DataFrame:
    """``{output: measure}`` averages per group, on a batch or a stream."""
    return df.groupBy(*groups).agg(
        *[average(F.col(m), digits, exact_scale).alias(out) for out, m in measures.items()]
    )


def grouped_averages(
    fact: DataFrame,
    dim: DataFrame,
    key: str,
    groups: Sequence[str],
    measures: Mapping[str, str],
    shared_from: str = "fact",
    measured_only: bool = False,
    digits: int | None = None,
    exact_scale: int | None = None,
    fold_fact: bool = False,
    stamp_column: str | None = "timestamp",
    as_of: AsOf = None,
    ts_type: str = "timestamp",
) -> DataFrame:
    """Averages of the dimension's measures over the fact rows of each group.

    ``groups`` may name columns of either side; one that both have comes from
    ``shared_from``. ``measured_only`` leaves a row that lacks any measure out of
    every average; otherwise each average skips its own NULLs.

    ``fold_fact`` counts the fact rows per key and group before the join. The
    result is the same up to the rounding of double sums. It costs one more
    shuffle when the dimension is broadcast, and pays when facts repeat within a
    key: a key holding a third of all rows then joins as a handful of them.
    """
    wanted = {*groups, *measures.values()} - {key}
    fact = fact.select(key, *[g for g in groups if g in fact.columns and g != key])
    dim = dim.select(key, *[c for c in dim.columns if c in wanted])
    fact, dim = drop_shared(fact, dim, key, shared_from)
    if measured_only:
        dim = measured_rows(dim, *measures.values())
    if fold_fact:
        # A NULL key joins nothing: dropping it here keeps it out of the shuffle.
        folded = (
            fact.filter(F.col(key).isNotNull())
            .groupBy(*fact.columns)
            .agg(F.count(F.lit(1)).alias(_WEIGHT))
        )
        stats = (
            folded.join(dim, key, "inner")
            .groupBy(*groups)
            .agg(
                *[
                    _weighted_average(F.col(m), F.col(_WEIGHT), digits, exact_scale).alias(out)
                    for out, m in measures.items()
                ]
            )
        )
    else:
        joined = fact.join(dim, key, "inner")
        stats = group_averages(joined, groups, measures, digits, exact_scale)
    if stamp_column is None:
        return stats
    return stats.withColumn(stamp_column, stamp(as_of, ts_type))
