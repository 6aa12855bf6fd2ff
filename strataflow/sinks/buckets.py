"""Tables in key-hash buckets, of which a new version rewrites only those that change.

The rows of a bucket lie in a folder of their own under ``data``. A version is a small
numbered snapshot under ``versions``: one row a bucket with the folder that holds its
rows, their number and an order-free digest of their content. A writer adds folders for
the buckets it changes and then a version that names these and the old folders of the
others. Readers therefore see one version, and a lost writer leaves only folders that
no version names.
"""

from __future__ import annotations

import uuid
from collections.abc import Collection, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from strataflow.operators.reconcile import BUCKET, DIGEST, bucket_digests, key_bucket
from strataflow.sinks.snapshots import (
    RETAIN,
    SnapshotConflict,
    age,
    child_names,
    complete_snapshots,
    current_snapshot,
    read_snapshot,
    remove_path,
    write_snapshot,
)

#: Buckets of a new table. A version has one row for each, which the driver reads.
BUCKETS = 256
IDENTITY = "id"


def _versions(root: str) -> str:
    return f"{root}/versions"


def create_buckets(
    spark: SparkSession,
    root: str,
    schema: StructType | str,
    keys: Sequence[str],
    buckets: int = BUCKETS,
) -> None:
    """An empty table, unless it is there; the keys and the number of buckets stay for good."""
    if current_snapshot(spark, _versions(root)) is not None:
        return
    empty = spark.createDataFrame([], schema)
    missing = set(keys) - set(empty.columns)
    if missing or not keys or BUCKET in empty.columns:
        raise ValueError(f"keys {list(keys)} do not suit the columns {empty.columns}")
    empty.write.mode("overwrite").parquet(f"{root}/layout")
    rows = spark.range(buckets, numPartitions=1).select(
        F.col("id").cast("int").alias(BUCKET),
        F.lit(None).cast("string").alias("folder"),
        *[F.lit(0).cast("bigint").alias(name) for name in DIGEST],
        F.lit(None).cast("bigint").alias("last_id"),
        F.array(*[F.lit(k) for k in keys]).alias("by"),
    )
    try:
        write_snapshot(rows, _versions(root), after=-1)
    except SnapshotConflict:
        # Another writer creates the same table; there is nothing to lose.
        if current_snapshot(spark, _versions(root)) is None:
            raise


def current_version(spark: SparkSession, root: str) -> int:
    version = current_snapshot(spark, _versions(root))
    if version is None:
        raise AnalysisException(f"no table in buckets under {root}")
    return version


def has_version(spark: SparkSession, root: str, version: int) -> bool:
    """Whether that version is complete and still there."""
    return version in complete_snapshots(spark, _versions(root))


def bucket_list(spark: SparkSession, root: str, version: int) -> DataFrame:
    """One row a bucket: its folder, row count, digests and largest id."""
    return read_snapshot(spark, _versions(root), number=version)


def bucket_keys(spark: SparkSession, root: str, version: int) -> tuple[list[str], int]:
    """The keys that choose a row's bucket, and the number of buckets."""
    found = bucket_list(spark, root, version).agg(F.first("by"), F.count(F.lit(1))).first()
    return list(found[0]), found[1]


def read_buckets(
    spark: SparkSession,
    root: str,
    version: int | None = None,
    only: Collection[int] | None = None,
) -> DataFrame:
    """The rows of a version, the newest by default, or of some of its buckets only."""
    if version is None:
        version = current_version(spark, root)
    schema = spark.read.parquet(f"{root}/layout").schema
    listed = bucket_list(spark, root, version).where(F.col("folder").isNotNull())
    paths = [
        f"{root}/data/{row.folder}/{BUCKET}={row[BUCKET]}"
        for row in listed.select("folder", BUCKET).collect()
        if only is None or row[BUCKET] in only
    ]
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*paths)


def write_buckets(
    rows: DataFrame,
    root: str,
    touched: Collection[int],
    after: int,
    number: int | None = None,
    retain: float = RETAIN,
) -> int:
    """A version in which the buckets ``touched`` hold ``rows`` and the others what they held.

    ``after`` is the version that the rows were made from: if another writer has followed it
    meanwhile, ``SnapshotConflict`` is raised and nothing changes. A ``number`` (a
    micro-batch id) is taken as in ``write_snapshot``. Rows outside the buckets ``touched``
    are refused. The digests are those of the files as written. A hot bucket is
    split over tasks by the rebalancing of adaptive execution.
    """
    spark = rows.sparkSession
    schema = spark.read.parquet(f"{root}/layout").schema
    keys, buckets = bucket_keys(spark, root, after)
    folder = uuid.uuid4().hex
    kept = bucket_list(spark, root, after)
    version = kept
    if touched:
        chosen = key_bucket(keys, buckets)
        strange = F.raise_error(F.lit("a row outside the buckets to be written")).cast("int")
        placed = rows.select(
            *[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema]
        ).withColumn(BUCKET, F.when(chosen.isin(list(touched)), chosen).otherwise(strange))
        placed.hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(f"{root}/data/{folder}")
        version = kept.where(~F.col(BUCKET).isin(list(touched))).unionByName(
            _written(spark, root, folder, schema, keys, touched)
        )
    try:
        made = write_snapshot(version.coalesce(1), _versions(root), number, retain=retain, after=after)
    except BaseException:
        remove_path(spark, f"{root}/data/{folder}")
        raise
    drop_unnamed_folders(spark, root, retain)
    return made


def _written(
    spark: SparkSession,
    root: str,
    folder: str,
    schema: StructType,
    keys: Sequence[str],
    touched: Collection[int],
) -> DataFrame:
    """The rows of a version for the buckets just written; one without rows has no folder."""
    every = spark.createDataFrame([(b,) for b in sorted(touched)], f"{BUCKET} int")
    placed = StructType([*schema.fields, StructField(BUCKET, IntegerType())])
    rows = spark.read.schema(placed).parquet(f"{root}/data/{folder}")
    largest = F.max(IDENTITY).cast("bigint") if IDENTITY in schema.names else F.lit(None).cast("bigint")
    found = bucket_digests(rows, schema.names, largest.alias("last_id"))
    return every.join(F.broadcast(found), BUCKET, "left").select(
        BUCKET,
        F.when(F.col(DIGEST[0]) > 0, F.lit(folder)).alias("folder"),
        *[F.coalesce(F.col(name), F.lit(0)).alias(name) for name in DIGEST],
        "last_id",
        F.array(*[F.lit(k) for k in keys]).alias("by"),
    )


def drop_unnamed_folders(spark: SparkSession, root: str, retain: float = RETAIN) -> None:
    """Delete folders that no version names and that were made ``retain`` seconds ago."""
    folders = set(child_names(spark, f"{root}/data"))
    named: set[str] = set()
    for version in complete_snapshots(spark, _versions(root)):
        listed = bucket_list(spark, root, version).select("folder").distinct().collect()
        named |= {row.folder for row in listed}
    for folder in folders - named:
        path = f"{root}/data/{folder}"
        since = age(spark, path)
        if since is not None and since > retain:
            remove_path(spark, path)
