import threading
import time
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from strataflow.operators import freshness
from strataflow.operators.counts import category_count, category_count_sql, category_counts
from strataflow.operators.numbering import number_rows
from strataflow.operators.reconcile import count_mismatch
from strataflow.operators.upsert import upsert_counter
from strataflow.plans.copies import apply_hits, create_if_absent, refresh_copy
from strataflow.plans.count_log import append_numbered, last_id, log_and_check, log_counts
from strataflow.session import scratch_path, scratch_root
from strataflow.sinks.layers import read_layer, write_layer
from strataflow.sinks.snapshots import (
    SnapshotConflict,
    current_snapshot,
    drop_old_snapshots,
    read_snapshot,
    write_snapshot,
)
from strataflow.sources.tables import CATEGORY_LOG, COUNTER, GAMES

NOW = datetime(2024, 1, 1, 12)
NTZ = "timestamp_ntz"


def log_of(spark, *ages):
    rows = [((NOW - timedelta(seconds=a)).isoformat(sep=" "),) for a in ages]
    df = spark.createDataFrame(rows, "t string") if rows else spark.createDataFrame([], "t string")
    return df.select(F.col("t").cast(NTZ).alias("created_at"))


def answers(spark, *ages):
    log = log_of(spark, *ages)
    args = (log, "created_at", 30, NOW)
    return {
        "max_age": freshness.newest_within(*args).first()[0],
        "flag": freshness.newest_within_flag(*args).first()[0],
        "strict": freshness.newest_strictly_within(*args).first()[0],
        "count": freshness.recent_count(*args).first()[0],
        "exists": freshness.any_recent(*args).count(),
        "whole": freshness.any_recent(*args, whole_seconds=True).count(),
        "latest": freshness.latest_recent_row(*args[:3], "created_at", NOW).count(),
    }


def test_freshness_edges(spark):
    assert answers(spark, 30.0) == {
        "max_age": True, "flag": 1, "strict": 0, "count": 1, "exists": 1, "whole": 1, "latest": 1
    }
    assert answers(spark, 30.9, 100) == {
        "max_age": True, "flag": 1, "strict": 0, "count": 0, "exists": 0, "whole": 1, "latest": 0
    }
    assert answers(spark, 31.0) == {
        "max_age": False, "flag": 0, "strict": 0, "count": 0, "exists": 0, "whole": 0, "latest": 0
    }
    assert answers(spark, 5, 10, 40) == {
        "max_age": True, "flag": 1, "strict": 1, "count": 2, "exists": 1, "whole": 1, "latest": 1
    }
    assert answers(spark) == {
        "max_age": None, "flag": 0, "strict": 0, "count": 0, "exists": 0, "whole": 0, "latest": 0
    }


def test_latest_row_is_the_newest(spark):
    row = freshness.latest_recent_row(
        log_of(spark, 9, 3, 20), "created_at", 30, "created_at", NOW
    ).first()
    assert row.created_at == NOW - timedelta(seconds=3)


def test_freshness_of_a_zoned_log_by_the_clock(spark):
    log = spark.range(1).select(F.current_timestamp().alias("created_at"))
    assert freshness.newest_within(log, "created_at", 30).first()[0] is True


def test_counts(spark):
    df = spark.createDataFrame([("G",), ("G",), ("S",), (None,)], "medal string")
    assert category_count(df, "medal", "G").collect() == [("G", 2)]
    assert category_count(df, "medal", "X").collect() == [("X", 0)]
    assert category_count_sql(df, "medal", "it's").collect() == [("it's", 0)]
    assert category_count_sql(df, "medal", "G", count="medal_count").columns[1] == "medal_count"
    counts = category_counts(df, "medal", ["S", "G", "B", "G"])
    assert sorted(counts.collect()) == [("B", 0), ("G", 2), ("S", 1)]


def test_count_log_and_check(spark, tmp_path):
    df = spark.createDataFrame([("G",), ("S",)], "medal string")
    log = str(tmp_path / "log")
    log_counts(df, "medal", ["G", "B"], log, NOW, NTZ)
    fresh = log_and_check(
        spark, df, "medal", ["S"], log, 30, NOW, NOW + timedelta(seconds=31), NTZ
    )
    assert fresh.first()[0] == 0
    rows = spark.read.parquet(log).collect()
    assert sorted(rows) == [("B", 0, NOW), ("G", 1, NOW), ("S", 1, NOW)]


def test_numbering_is_dense_over_many_partitions(spark, tmp_path):
    df = spark.range(5_000).select(((F.col("id") * 7919) % 5_000).alias("v")).repartition(16)
    rows = number_rows(df, ["v"], str(tmp_path / "s"), start=11).collect()
    assert sorted((r.id, r.v) for r in rows) == [(11 + v, v) for v in range(5_000)]


def test_numbering_of_no_rows(spark, tmp_path):
    df = spark.createDataFrame([], "v long")
    assert number_rows(df, ["v"], str(tmp_path / "s")).count() == 0


def test_numbered_appends_go_on(spark, tmp_path):
    log = str(tmp_path / "log")
    assert last_id(spark, log) == 0
    for part in range(2):
        rows = spark.range(3).select((F.col("id") + 10 * part).alias("v"))
        append_numbered(rows, log, ["v"], str(tmp_path / f"stage{part}"))
    assert sorted(spark.read.parquet(log).collect()) == [
        (1, 0), (2, 1), (3, 2), (4, 10), (5, 11), (6, 12)
    ]


def counters(spark, *rows):
    schema = "k string, count long, created_at timestamp_ntz, updated_at timestamp_ntz"
    return spark.createDataFrame(list(rows), schema)


OLD = datetime(2023, 1, 1)


def test_upsert_raises_inserts_and_spares(spark):
    target = counters(spark, ("a", 2, OLD, OLD), ("b", 5, OLD, OLD), ("z", None, OLD, OLD))
    hits = spark.createDataFrame([("a",), ("a",), ("c",), ("z",)], "k string")
    assert sorted(upsert_counter(target, hits, ["k"], NOW).collect()) == [
        ("a", 4, OLD, NOW), ("b", 5, OLD, OLD), ("c", 1, NOW, NOW), ("z", 1, OLD, NOW)
    ]


def test_upsert_refuses_doubtful_keys(spark):
    hits = spark.createDataFrame([("a",)], "k string")
    twice = counters(spark, ("a", 1, OLD, OLD), ("a", 2, OLD, OLD))
    with pytest.raises(Exception, match="stored more than once"):
        upsert_counter(twice, hits, ["k"], NOW).collect()
    with pytest.raises(Exception, match="NULL in a counter key"):
        upsert_counter(
            counters(spark), spark.createDataFrame([(None,)], "k string"), ["k"], NOW
        ).collect()


def test_apply_hits_writes_a_new_version(spark, tmp_path):
    root = str(tmp_path / "c")
    create_if_absent(spark, root, counters(spark).schema)
    hits = spark.createDataFrame([("a",), ("a",)], "k string")
    apply_hits(hits, root, ["k"], OLD)
    apply_hits(hits, root, ["k"], NOW)
    assert read_snapshot(spark, root).collect() == [("a", 4, OLD, NOW)]


def test_apply_hits_numbers_new_counters(spark, tmp_path):
    root = str(tmp_path / "c")
    create_if_absent(spark, root, COUNTER)
    keys = ["champion_name", "sport", "medal_type"]
    for names in (["b", "a", "a"], ["c", "a"], []):
        hits = spark.createDataFrame(
            [(n, "s", "Gold") for n in names],
            "champion_name string, sport string, medal_type string",
        )
        apply_hits(hits, root, keys)
    rows = read_snapshot(spark, root)
    assert rows.columns == COUNTER.names
    assert sorted((r.id, r.champion_name, r["count"]) for r in rows.collect()) == [
        (1, "a", 3), (2, "b", 1), (3, "c", 1)
    ]


def test_count_mismatch(spark):
    assert count_mismatch(spark.range(3), spark.range(3)).collect() == [(3, 3, False)]
    assert count_mismatch(spark.range(3), spark.range(0)).collect() == [(0, 3, True)]


def test_refresh_copy_only_on_mismatch(spark, tmp_path):
    root = str(tmp_path / "copy")
    first = spark.createDataFrame([(1, 1900)], "edition_id int, year int")
    assert refresh_copy(first, root) is True
    assert refresh_copy(first, root) is False
    changed = spark.createDataFrame([(2, 1904)], "edition_id int, year int")
    assert refresh_copy(changed, root) is False  # equal counts hide the change
    grown = first.union(changed)
    assert refresh_copy(grown, root) is True
    assert sorted(read_snapshot(spark, root).collect()) == [(1, 1900), (2, 1904)]


def test_create_if_absent_keeps_types(spark, tmp_path):
    for name, schema in (("games", GAMES), ("log", CATEGORY_LOG)):
        root = str(tmp_path / name)
        create_if_absent(spark, root, schema)
        create_if_absent(spark, root, schema)
        assert current_snapshot(spark, root) == 0
        assert read_snapshot(spark, root).dtypes == [
            (f.name, f.dataType.simpleString()) for f in schema.fields
        ]


def versions(path):
    return sorted(p.name for p in path.iterdir() if p.name.startswith("snapshot="))


def test_snapshots_can_read_what_they_replace(spark, tmp_path):
    root = str(tmp_path / "t")
    write_snapshot(spark.range(2), root)
    reader = read_snapshot(spark, root)
    write_snapshot(reader.select((F.col("id") + 1).alias("id")), root)
    assert sorted(r.id for r in reader.collect()) == [0, 1]
    assert sorted(r.id for r in read_snapshot(spark, root).collect()) == [1, 2]
    write_snapshot(spark.range(1), root)
    assert versions(tmp_path / "t") == ["snapshot=0", "snapshot=1", "snapshot=2"]
    time.sleep(0.1)
    write_snapshot(spark.range(1), root, retain=0.05)
    assert versions(tmp_path / "t")[-1] == "snapshot=3"
    assert "snapshot=0" not in versions(tmp_path / "t")


def test_unfinished_snapshot_is_not_read(spark, tmp_path):
    root = str(tmp_path / "t")
    write_snapshot(spark.range(2), root)
    (tmp_path / "t" / "snapshot=1").mkdir()
    assert current_snapshot(spark, root) == 0
    assert write_snapshot(spark.range(3), root) == 2
    assert read_snapshot(spark, root).count() == 3
    time.sleep(0.1)
    drop_old_snapshots(spark, root, retain=0.05)
    assert versions(tmp_path / "t") == ["snapshot=2"]


def test_of_two_writers_one_is_refused(spark, tmp_path):
    root = str(tmp_path / "t")
    write_snapshot(spark.range(1), root)

    def write(_):
        try:
            return write_snapshot(spark.range(1000), root, after=0)
        except SnapshotConflict:
            return None

    with ThreadPoolExecutor(2) as pool:
        numbers = list(pool.map(write, range(2)))
    assert sorted(numbers, key=str) == [1, None]
    assert read_snapshot(spark, root).count() == 1000
    with pytest.raises(SnapshotConflict):
        write_snapshot(spark.range(5), root, after=0)
    assert read_snapshot(spark, root).count() == 1000


def test_a_failed_write_leaves_the_old_version(spark, tmp_path):
    root = str(tmp_path / "t")
    write_layer(spark.range(3), root)
    broken = spark.range(1).select(F.raise_error(F.lit("lost")).alias("id"))
    with pytest.raises(Exception, match="lost"):
        write_layer(broken, root)
    assert read_layer(spark, root).count() == 3
    assert write_snapshot(spark.range(4), root, after=0) == 1


def test_a_batch_of_hits_counts_once(spark, tmp_path):
    root = str(tmp_path / "c")
    create_if_absent(spark, root, COUNTER)
    keys = ["champion_name", "sport", "medal_type"]
    schema = "champion_name string, sport string, medal_type string"
    for batch, names in ((1, "aab"), (2, "c"), (2, "c"), (1, "aab")):
        hits = spark.createDataFrame([(n, "s", "Gold") for n in names], schema)
        apply_hits(hits, root, keys, OLD, batch_id=batch)
    rows = {r.champion_name: (r.id, r["count"]) for r in read_snapshot(spark, root).collect()}
    assert rows == {"a": (1, 2), "b": (2, 1), "c": (3, 1)}


def test_staging_is_emptied(spark, tmp_path):
    root, log = str(tmp_path / "c"), str(tmp_path / "log")
    create_if_absent(spark, root, COUNTER)
    schema = "champion_name string, sport string, medal_type string"
    before = set(Path(scratch_root(spark)).glob("strataflow/*"))
    apply_hits(spark.createDataFrame([("a", "s", "Gold")], schema), root, schema.replace(" string", "").split(", "))
    staging = scratch_path(spark, "numbering")
    append_numbered(spark.range(3).withColumnRenamed("id", "v"), log, ["v"], staging)
    assert set(Path(scratch_root(spark)).glob("strataflow/*")) == before


def test_snapshot_numbers_do_not_go_back(spark, tmp_path):
    root = str(tmp_path / "t")
    write_snapshot(spark.range(2), root, number=4)
    write_snapshot(spark.range(3), root, number=4)  # a retry changes nothing
    assert read_snapshot(spark, root).count() == 2
    with pytest.raises(ValueError):
        write_snapshot(spark.range(1), root, number=3)
    with pytest.raises(AnalysisException):
        read_snapshot(spark, str(tmp_path / "absent"))


def _in_threads(spark, root, batches):
    """Apply batches at the same time; those refused, by batch."""
    refused = {}

    def run(batch):
        hits = spark.createDataFrame([("a",)] * batch, "k string")
        try:
            apply_hits(hits, root, ["k"], OLD, batch_id=batch)
        except (SnapshotConflict, ValueError) as error:
            refused[batch] = error

    threads = [threading.Thread(target=run, args=(b,)) for b in batches]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    return refused


def test_batches_at_the_same_time_lose_no_hit(spark, tmp_path):
    root = str(tmp_path / "racing")
    create_if_absent(spark, root, counters(spark).schema)
    refused = _in_threads(spark, root, (5, 6))
    applied = {5, 6} - set(refused)
    assert applied
    assert read_snapshot(spark, root).first()["count"] == sum(applied)
    if isinstance(refused.get(6), SnapshotConflict):
        assert not _in_threads(spark, root, (6,))
        assert read_snapshot(spark, root).first()["count"] == 11


def test_two_batches_from_one_version(spark, tmp_path):
    root, rows = str(tmp_path / "bases"), spark.range(3)
    write_snapshot(rows, root)
    write_snapshot(rows, root, number=4, after=0)
    with pytest.raises(SnapshotConflict):
        write_snapshot(rows, root, number=5, after=0)
    assert write_snapshot(rows, root, number=4, after=0) == 4
    assert write_snapshot(rows, root, number=5, after=4) == 5


def test_an_overtaken_batch_is_refused(spark, tmp_path):
    root = str(tmp_path / "overtaken")
    create_if_absent(spark, root, counters(spark).schema)
    assert not _in_threads(spark, root, (6,))
    assert isinstance(_in_threads(spark, root, (5,))[5], ValueError)
    assert not _in_threads(spark, root, (6,))
    assert read_snapshot(spark, root).first()["count"] == 6
