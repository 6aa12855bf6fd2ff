"""Copies and counters: replaced as a whole, or by key-hash buckets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strataflow.functions.clock import AsOf
from strataflow.operators.numbering import number_rows
from strataflow.operators.reconcile import (
    BUCKET,
    content_digests,
    count_mismatch,
    key_bucket,
    unequal_buckets,
)
from strataflow.operators.upsert import HITS, count_hits, upsert_counter
from strataflow.session import scratch_path
from strataflow.sinks.buckets import (
    bucket_keys,
    bucket_list,
    current_version,
    has_version,
    read_buckets,
    write_buckets,
)
from strataflow.sinks.snapshots import (
    current_snapshot,
    has_snapshot,
    read_snapshot,
    remove_path,
    write_snapshot,
)


def create_if_absent(spark: SparkSession, root: str, schema: StructType | str) -> None:
    """An empty table with typed columns, unless the table is there."""
    if current_snapshot(spark, root) is None:
        write_snapshot(spark.createDataFrame([], schema), root)


def refresh_copy(original: DataFrame, root: str) -> bool:
    """Reload the copy if its row count differs; True if it was reloaded."""
    spark = original.sparkSession
    create_if_absent(spark, root, original.schema)
    differs = count_mismatch(original, read_snapshot(spark, root)).first()["differs"]
    if differs:
        write_snapshot(original, root)
    return differs


def refresh_buckets(original: DataFrame, root: str) -> list[int]:
    """Reload the buckets of the copy whose content differs; returns their numbers.

    The copy is a table of ``create_buckets``. Its digests lie in its version list, so
    the original is read once for its own digests, and again only if some differ; of the
    copy nothing is read. If the original changes between these two readings, the next
    refresh notices it, since a bucket's digest is that of the rows written.
    """
    spark = original.sparkSession
    version = current_version(spark, root)
    keys, buckets = bucket_keys(spark, root, version)
    schema = read_buckets(spark, root, version, only=()).schema
    rows = original.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema])
    unequal = unequal_buckets(
        content_digests(rows, keys, buckets), bucket_list(spark, root, version)
    )
    numbers = sorted(row[BUCKET] for row in unequal.collect())
    if numbers:
        chosen = rows.where(key_bucket(keys, buckets).isin(numbers))
        write_buckets(chosen, root, numbers, after=version)
    return numbers


def apply_hits(
    hits: DataFrame,
    root: str,
    keys: Sequence[str],
    as_of: AsOf = None,
    batch_id: int | None = None,
) -> None:
    """Raise the counters stored at ``root`` by the hits, as a new version.

    The hits are counted by key once; stored rows and counts then meet in one grouping,
    which is written once. A table with an ``id`` column numbers its new counters in the
    order of the keys: only the keys that it lacks are numbered. If another writer
    replaces the table meanwhile, ``SnapshotConflict`` is raised and no hit is lost.

    A ``batch_id``, 1 or more and rising, makes a batch count once: one that the table
    already has changes nothing. One that a later batch has overtaken is refused with
    ``ValueError``, and of two batches that read the same version one with
    ``SnapshotConflict``: run again, it goes on from the other's. A table takes batches
    either with ids or without.
    """
    spark = hits.sparkSession
    current = current_snapshot(spark, root)
    if batch_id is not None and current is not None and batch_id <= current:
        if not has_snapshot(spark, root, batch_id):
            raise ValueError(f"batch {batch_id} is older than version {current} of {root}")
        return
    stored = read_snapshot(spark, root, number=current)
    staging = scratch_path(spark, "hits")
    try:
        counted = count_hits(hits, keys)
        if "id" in stored.columns:
            counted = _with_new_ids(stored, counted, keys, staging)
        merged = upsert_counter(stored, counted, keys, as_of, hit_count=HITS)
        if batch_id is None:
            write_snapshot(merged, root, after=current)
        else:
            write_snapshot(merged, root, number=batch_id, after=current)
    finally:
        remove_path(spark, staging)


def _with_new_ids(
    stored: DataFrame, counted: DataFrame, keys: Sequence[str], staging: str
) -> DataFrame:
    """Counted hits, those of new keys with ids that go on after the largest one."""
    spark = stored.sparkSession
    counted.write.parquet(f"{staging}/counted")
    counted = spark.read.parquet(f"{staging}/counted")
    last = stored.agg(F.coalesce(F.max("id"), F.lit(0)).alias("last")).first()["last"]
    return _numbered(stored, counted, keys, staging, last)


def _numbered(
    stored: DataFrame, counted: DataFrame, keys: Sequence[str], staging: str, last: int
) -> DataFrame:
    """Counted hits, staged already; keys that ``stored`` lacks get the ids after ``last``."""
    # A NULL key is no new counter: the grouping refuses it.
    new = counted.select(*keys).na.drop().join(stored.select(*keys), list(keys), "left_anti")
    numbered = number_rows(new, keys, f"{staging}/numbering", last + 1, unique=True)
    return counted.join(numbered, list(keys), "left")


def raise_counters(
    hits: DataFrame, root: str, as_of: AsOf = None, batch_id: int | None = None
) -> list[int]:
    """Raise the counters of a table of ``create_buckets``; returns the buckets rewritten.

    Counts as ``apply_hits`` does, but reads and writes only the buckets that have hits:
    ten keys touch ten buckets at most, whatever the size of the table. The largest id
    is taken from the version list. Ids of batches and conflicts between writers are
    treated as there, and a batch without hits is remembered too.
    """
    spark = hits.sparkSession
    version = current_version(spark, root)
    if batch_id is not None and batch_id <= version:
        if not has_version(spark, root, batch_id):
            raise ValueError(f"batch {batch_id} is older than version {version} of {root}")
        return []
    keys, buckets = bucket_keys(spark, root, version)
    staging = scratch_path(spark, "hits")
    try:
        count_hits(hits, keys).write.parquet(f"{staging}/hits")
        counted = spark.read.parquet(f"{staging}/hits")
        found = counted.select(key_bucket(keys, buckets).alias(BUCKET)).distinct().collect()
        touched = sorted(row[BUCKET] for row in found)
        if not touched and batch_id is None:
            return []
        stored = read_buckets(spark, root, version, only=set(touched))
        if "id" in stored.columns:
            last = bucket_list(spark, root, version).agg(F.max("last_id")).first()[0]
            counted = _numbered(stored, counted, keys, staging, last or 0)
        merged = upsert_counter(stored, counted, keys, as_of, hit_count=HITS)
        write_buckets(merged, root, touched, after=version, number=batch_id)
    finally:
        remove_path(spark, staging)
    return touched
