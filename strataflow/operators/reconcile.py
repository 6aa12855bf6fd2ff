"""Comparison of a table with its copy, by row counts or by content."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKET = "key_bucket"
#: Row count of a bucket, sums of the halves of its row hashes, and their exclusive or.
DIGEST = ("n_rows", "low_sum", "high_sum", "mixed")


def count_mismatch(original: DataFrame, copy: DataFrame) -> DataFrame:
    """One row: both row counts and whether they differ.

    A change that keeps the number of rows goes unnoticed. Each side is reduced to
    one row before the two meet.
    """
    one, none = F.count(F.lit(1)), F.lit(0).cast("bigint")
    sides = copy.agg(one.alias("nrows_copy"), none.alias("nrows_original")).unionByName(
        original.agg(none.alias("nrows_copy"), one.alias("nrows_original"))
    )
    totals = sides.agg(
        F.sum("nrows_copy").alias("nrows_copy"), F.sum("nrows_original").alias("nrows_original")
    )
    return totals.withColumn("differs", F.col("nrows_copy") != F.col("nrows_original"))


def key_bucket(keys: Sequence[str], buckets: int) -> Column:
    """The bucket of a row, 0 to ``buckets - 1``, by a hash of its keys."""
    return F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in keys]), F.lit(buckets)).cast("int")


def row_hash(columns: Sequence[str]) -> Column:
    """64-bit hash of a row. A NULL leaves Spark's hash as it was, so its place is hashed too."""
    values = [F.col(f"`{c}`") for c in columns]
    return F.xxhash64(*values, *[v.isNull() for v in values])


def bucket_digests(rows: DataFrame, columns: Sequence[str], *also: Column) -> DataFrame:
    """Digests of the rows of each ``key_bucket`` that do not depend on their order.

    The exclusive or notices a change that leaves the sums alone, the sums one of rows that
    occur twice. The sums of 32-bit halves are exact up to 2^31 rows a bucket and raise beyond.
    """
    half = F.lit(0xFFFFFFFF)
    return (
        rows.withColumn("_hash", row_hash(columns))
        .groupBy(BUCKET)
        .agg(
            F.count(F.lit(1)).alias(DIGEST[0]),
            F.sum(F.col("_hash").bitwiseAND(half)).alias(DIGEST[1]),
            F.sum(F.shiftright("_hash", 32)).alias(DIGEST[2]),
            F.bit_xor("_hash").alias(DIGEST[3]),
            *also,
        )
    )


def content_digests(df: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    """One row for each bucket that has rows; only these partial sums are shuffled."""
    return bucket_digests(df.withColumn(BUCKET, key_bucket(keys, buckets)), df.columns)


def unequal_buckets(ours: DataFrame, theirs: DataFrame) -> DataFrame:
    """The ``key_bucket`` whose digests differ; a bucket without a row counts as empty."""
    sides = [
        side.select(BUCKET, *[F.col(c).alias(f"{c}_{k}") for c in DIGEST])
        for k, side in enumerate((ours, theirs))
    ]
    differs = F.lit(False)
    for name in DIGEST:
        one, other = (F.coalesce(F.col(f"{name}_{k}"), F.lit(0)) for k in (0, 1))
        differs = differs | (one != other)
    return sides[0].join(sides[1], BUCKET, "full").where(differs).select(BUCKET)


def changed_keys(
    original: DataFrame, copy: DataFrame, keys: Sequence[str], buckets: int
) -> DataFrame:
    """Each key whose rows differ: its keys, row counts of both sides and the ``change``.

    ``change`` is ``added``, ``removed`` or ``changed``, seen from the copy. Digests by bucket
    come first, so that only rows of unequal buckets, as hashes, are shuffled by
    key. Repeated rows count as often as they occur; NULL keys are keys like others.
    """
    types = [(f.name, f.dataType) for f in original.schema]
    if types != [(f.name, f.dataType) for f in copy.schema]:
        raise ValueError("original and copy have different columns")
    unequal = unequal_buckets(
        content_digests(original, keys, buckets), content_digests(copy, keys, buckets)
    )
    one, none = F.lit(1), F.lit(0)

    def hashed(side: DataFrame, ours: Column, theirs: Column, sign: int) -> DataFrame:
        # At most ``buckets`` rows are broadcast.
        found = side.withColumn(BUCKET, key_bucket(keys, buckets)).join(
            F.broadcast(unequal), BUCKET, "left_semi"
        )
        digest = row_hash(original.columns)
        return found.select(
            *keys, ours.alias("_o"), theirs.alias("_c"), digest.alias("_hash"),
            (digest.bitwiseAND(F.lit(0xFFFFFFFF)) * sign).alias("_low"),
            (F.shiftright(digest, 32) * sign).alias("_high"),
        )

    both = hashed(original, one, none, 1).unionByName(hashed(copy, none, one, -1))
    by_key = both.groupBy(*keys).agg(
        F.sum("_o").alias("nrows_original"), F.sum("_c").alias("nrows_copy"),
        *[F.sum(c).alias(c) for c in ("_low", "_high")], F.bit_xor("_hash").alias("_mixed"),
    )
    same = (
        (F.col("nrows_original") == F.col("nrows_copy"))
        & (F.col("_low") == 0)
        & (F.col("_high") == 0)
        & (F.col("_mixed") == 0)
    )
    change = (
        F.when(F.col("nrows_copy") == 0, "added")
        .when(F.col("nrows_original") == 0, "removed")
        .otherwise("changed")
    )
    return by_key.where(~same).select(
        *keys, "nrows_original", "nrows_copy", change.alias("change")
    )
