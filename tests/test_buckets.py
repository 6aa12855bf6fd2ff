"""Tables in key-hash buckets: content reconciliation and counters."""

from datetime import datetime
from threading import Barrier, Thread

import pytest
from pyspark.sql import functions as F

from strataflow.operators.reconcile import changed_keys, content_digests, unequal_buckets
from strataflow.plans.copies import raise_counters, refresh_buckets
from strataflow.sinks.buckets import (
    create_buckets,
    current_version,
    drop_unnamed_folders,
    read_buckets,
    write_buckets,
)
from strataflow.sinks.snapshots import SnapshotConflict, child_names

AT = datetime(2024, 1, 1)
COUNTERS = "id long, k string, count long, created_at timestamp, updated_at timestamp"
PAIRS = "k long, v string"


def rows_of(spark, root, *columns):
    return sorted(tuple(r) for r in read_buckets(spark, root).select(*columns).collect())


@pytest.mark.parametrize(
    "one, other",
    [
        ([(1, "a")], [(1, "b")]),
        ([(1, None)], [(1, "")]),
        ([(None, "a")], [(1, "a")]),
        ([(1, "a"), (1, "a")], [(1, "a")]),
        ([(1, "a"), (1, "a")], [(1, "b"), (1, "b")]),  # the exclusive or alone is blind to it
        ([(1, "a")], []),
    ],
)
def test_digests_notice(spark, one, other):
    a, b = (content_digests(spark.createDataFrame(x, PAIRS), ["k"], 8) for x in (one, other))
    assert unequal_buckets(a, b).count() >= 1
    assert unequal_buckets(b, a).count() >= 1
    assert unequal_buckets(a, a).count() == 0


def test_digests_do_not_depend_on_order(spark):
    rows = spark.range(1000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("v"))
    mixed = rows.repartition(7, "v").sort(F.desc("v"))
    found = unequal_buckets(content_digests(rows, ["id"], 16), content_digests(mixed, ["id"], 16))
    assert found.count() == 0


def test_nulls_in_other_columns_differ(spark):
    schema = "k long, a string, b string"
    one = spark.createDataFrame([(1, "x", None)], schema)
    other = spark.createDataFrame([(1, None, "x")], schema)
    digests = [content_digests(df, ["k"], 4) for df in (one, other)]
    assert unequal_buckets(*digests).count() == 1


def test_changed_keys(spark):
    original = spark.createDataFrame(
        [(1, "a"), (2, "b"), (3, "c"), (None, "n"), (5, "x"), (5, "y"), (6, "d"), (6, "d")], PAIRS
    )
    copy = spark.createDataFrame(
        [(1, "a"), (2, "B"), (4, "c"), (None, "m"), (5, "y"), (5, "x"), (6, "d")], PAIRS
    )
    found = sorted(
        (tuple(r) for r in changed_keys(original, copy, ["k"], 2).collect()), key=str
    )
    assert found == [
        (2, 1, 1, "changed"),
        (3, 1, 0, "added"),
        (4, 0, 1, "removed"),
        (6, 2, 1, "changed"),
        (None, 1, 1, "changed"),
    ]
    assert changed_keys(original, original, ["k"], 2).count() == 0
    with pytest.raises(ValueError, match="different columns"):
        changed_keys(original, copy.withColumn("k", F.col("k").cast("int")), ["k"], 2)


def test_one_changed_row_reloads_one_bucket(spark, tmp_path):
    root = str(tmp_path / "copy")
    rows = spark.range(5000).select("id", F.col("id").cast("string").alias("v"))
    create_buckets(spark, root, rows.schema, ["id"], buckets=32)
    assert len(refresh_buckets(rows, root)) == 32
    before = set(child_names(spark, f"{root}/data"))
    assert refresh_buckets(rows, root) == []
    changed = rows.withColumn("v", F.when(F.col("id") == 17, "new").otherwise(F.col("v")))
    assert len(refresh_buckets(changed, root)) == 1
    (new,) = set(child_names(spark, f"{root}/data")) - before
    assert len([n for n in child_names(spark, f"{root}/data/{new}") if "=" in n]) == 1
    assert rows_of(spark, root, "id", "v") == sorted(tuple(r) for r in changed.collect())
    # Rows that go leave an empty bucket or a smaller one; all can go.
    assert len(refresh_buckets(changed.where("id != 17"), root)) == 1
    assert read_buckets(spark, root).count() == 4999
    assert len(refresh_buckets(rows.limit(0), root)) == 32
    assert read_buckets(spark, root).count() == 0


def test_a_hot_key_of_the_copy_is_whole(spark, tmp_path):
    root = str(tmp_path / "copy")
    rows = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("k"), F.col("id").alias("v")
    )
    create_buckets(spark, root, rows.schema, ["k"], buckets=16)
    refresh_buckets(rows, root)
    assert refresh_buckets(rows, root) == []
    assert read_buckets(spark, root).agg(F.countDistinct("v")).first()[0] == 9000


def test_ten_hits_rewrite_ten_buckets_at_most(spark, tmp_path):
    root = str(tmp_path / "c")
    create_buckets(spark, root, COUNTERS, ["k"], buckets=64)
    keys = spark.range(2000).select(F.col("id").cast("string").alias("k"))
    raise_counters(keys, root, AT)
    before = set(child_names(spark, f"{root}/data"))
    hits = spark.createDataFrame([(str(k),) for k in range(5, 15)], "k string")
    touched = raise_counters(hits, root, AT)
    assert 1 <= len(touched) <= 10
    (new,) = set(child_names(spark, f"{root}/data")) - before
    written = [n for n in child_names(spark, f"{root}/data/{new}") if "=" in n]
    assert sorted(written) == sorted(f"key_bucket={b}" for b in touched)
    counts = dict(rows_of(spark, root, "k", "count"))
    assert len(counts) == 2000
    assert {k for k, n in counts.items() if n == 2} == {str(k) for k in range(5, 15)}
    # An old version still reads as it was.
    assert read_buckets(spark, root, version=1).agg(F.sum("count")).first()[0] == 2000


def test_ids_go_on_after_the_largest(spark, tmp_path):
    root = str(tmp_path / "c")
    create_buckets(spark, root, COUNTERS, ["k"], buckets=8)
    for batch in (["b", "a"], ["a", "d", "c"], ["e"]):
        raise_counters(spark.createDataFrame([(k,) for k in batch], "k string"), root, AT)
    assert rows_of(spark, root, "id", "k", "count") == [
        (1, "a", 2), (2, "b", 1), (3, "c", 1), (4, "d", 1), (5, "e", 1),
    ]


def test_batches_count_once(spark, tmp_path):
    root = str(tmp_path / "c")
    create_buckets(spark, root, COUNTERS, ["k"], buckets=8)
    hits = spark.createDataFrame([("a",)], "k string")
    assert raise_counters(hits, root, AT, batch_id=3)
    assert raise_counters(hits, root, AT, batch_id=3) == []
    assert raise_counters(hits.limit(0), root, AT, batch_id=4) == []
    assert current_version(spark, root) == 4
    with pytest.raises(ValueError, match="older"):
        raise_counters(hits, root, AT, batch_id=2)
    assert raise_counters(hits.limit(0), root, AT) == []
    assert current_version(spark, root) == 4
    assert rows_of(spark, root, "k", "count") == [("a", 1)]


def test_a_null_key_changes_nothing(spark, tmp_path):
    root = str(tmp_path / "c")
    create_buckets(spark, root, COUNTERS, ["k"], buckets=8)
    with pytest.raises(Exception, match="NULL in a counter key"):
        raise_counters(spark.createDataFrame([(None,), ("a",)], "k string"), root, AT)
    assert read_buckets(spark, root).count() == 0
    assert current_version(spark, root) == 0


def test_two_writers_lose_no_hit(spark, tmp_path):
    root, start = str(tmp_path / "c"), Barrier(2)
    create_buckets(spark, root, COUNTERS, ["k"], buckets=8)
    failed = []

    def work(batch):
        hits = spark.createDataFrame([("a",), (f"own{batch}",)], "k string")
        start.wait()
        while True:
            try:
                raise_counters(hits, root, AT, batch_id=batch)
                return
            except SnapshotConflict:
                continue
            except ValueError:
                failed.append(batch)
                return

    threads = [Thread(target=work, args=(b,)) for b in (5, 6)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    # Batch 5 is refused, aloud, if 6 came first; what was taken is whole.
    taken = {5, 6} - set(failed)
    expected = [("a", len(taken)), *sorted((f"own{b}", 1) for b in taken)]
    assert rows_of(spark, root, "k", "count") == expected


def test_a_stale_writer_is_refused(spark, tmp_path):
    root = str(tmp_path / "t")
    create_buckets(spark, root, PAIRS, ["k"], buckets=2)
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], PAIRS)
    write_buckets(rows, root, [0, 1], after=0)
    with pytest.raises(SnapshotConflict):
        write_buckets(rows.limit(0), root, [0, 1], after=0)
    assert len(child_names(spark, f"{root}/data")) == 1
    assert rows_of(spark, root, "k") == [(1,), (2,), (3,)]
    with pytest.raises(Exception, match="outside the buckets"):
        write_buckets(rows, root, [0], after=1)


def test_only_unnamed_folders_go(spark, tmp_path):
    root = str(tmp_path / "t")
    create_buckets(spark, root, PAIRS, ["k"], buckets=2)
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], PAIRS)
    refresh_buckets(rows, root)
    rows.write.parquet(f"{root}/data/lost")
    drop_unnamed_folders(spark, root)  # young: its writer may be alive
    assert "lost" in child_names(spark, f"{root}/data")
    drop_unnamed_folders(spark, root, retain=-1)
    assert "lost" not in child_names(spark, f"{root}/data")
    assert read_buckets(spark, root).count() == 3


@pytest.mark.parametrize("keys", [[], ["absent"]])
def test_keys_have_to_be_columns(spark, tmp_path, keys):
    with pytest.raises(ValueError, match="do not suit"):
        create_buckets(spark, str(tmp_path / "t"), PAIRS, keys)
