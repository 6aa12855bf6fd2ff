"""Copies and counters."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow.operators.counts import category_count
from strataflow.operators.reconcile import changed_keys
from strataflow.plans.copies import (
    apply_hits,
    create_if_absent,
    raise_counters,
    refresh_buckets,
    refresh_copy,
)
from strataflow.queries.registry import query, table
from strataflow.session import scratch_path
from strataflow.sinks.buckets import create_buckets, read_buckets
from strataflow.sinks.snapshots import read_snapshot
from strataflow.sources.tables import GAMES

FIRST, SECOND = datetime(2024, 2, 1), datetime(2024, 2, 2)
SPLIT = "1997-01-01"
KEYS = ("champion_name", "sport", "medal_type")
COUNTERS = (
    "id bigint, champion_name string, sport string, medal_type string, count bigint,"
    " created_at timestamp_ntz, updated_at timestamp_ntz"
)


# The games table, filled from the customers.
GAMES_COLUMNS = {
    "edition": "c_name",
    "edition_id": "cast(c_custkey AS int)",
    "edition_url": "concat('/editions/', cast(c_custkey AS varchar(9)))",
    "year": "cast(1896 + 4 * (c_custkey % 33) AS int)",
    "city": "c_mktsegment",
    "country_flag_url": "CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE concat('/flags/', cast(c_nationkey AS varchar(9))) END",
    "country_noc": "concat('NATION_', cast(c_nationkey AS varchar(9)))",
    "start_date": "concat(cast(c_custkey % 28 + 1 AS varchar(9)), ' July')",
    "end_date": "CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE '30 August' END",
    "competition_date": "'1 - 16 August'",
    "isHeld": "CASE WHEN c_custkey % 40 = 0 THEN 'Not held' ELSE NULL END",
}
_GAMES = [f"{expression} AS {name}" for name, expression in GAMES_COLUMNS.items()]


@query("games_copy_refresh", f"SELECT {', '.join(_GAMES)} FROM customer")
def games_copy_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An absent copy is created empty, loaded in two steps as the original grows, then left."""
    games = table(spark, sf_dir, "customer").selectExpr(*_GAMES)
    copy = scratch_path(spark, "copy")
    create_if_absent(spark, copy, GAMES)
    refresh_copy(games.filter("edition_id % 2 = 0"), copy)
    refresh_copy(games, copy)
    refresh_copy(games, copy)
    return read_snapshot(spark, copy)


# The same table after one edition has moved, with as many rows as before.
_MOVED = [
    f"CASE WHEN c_custkey = 7 THEN 'moved' ELSE {e} END AS {name}" if name == "city" else f"{e} AS {name}"
    for name, e in GAMES_COLUMNS.items()
]


@query(
    "games_copy_content_refresh",
    f"SELECT {', '.join(_MOVED)}, 1 AS n_reloaded FROM customer",
)
def games_copy_content_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A change at equal row counts: the bucket of the changed row is reloaded, no other."""
    customers, copy = table(spark, sf_dir, "customer"), scratch_path(spark, "copy")
    create_buckets(spark, copy, GAMES, ["edition_id"])
    refresh_buckets(customers.selectExpr(*_GAMES), copy)
    reloaded = refresh_buckets(customers.selectExpr(*_MOVED), copy)
    return read_buckets(spark, copy).withColumn("n_reloaded", F.lit(len(reloaded)))


# A copy of the orders that lacks some, has some of its own and differs in others.
_COPY = """
    SELECT CASE WHEN o_orderkey % 101 = 0 THEN -o_orderkey ELSE o_orderkey END AS o_orderkey,
           CASE WHEN o_orderkey % 103 = 0 THEN NULL ELSE o_orderstatus END AS o_orderstatus,
           o_orderpriority FROM orders"""


@query("copy_changed_keys", f"""
    SELECT coalesce(o.o_orderkey, c.o_orderkey) AS o_orderkey,
           CASE WHEN o.o_orderkey IS NULL THEN 0 ELSE 1 END AS nrows_original,
           CASE WHEN c.o_orderkey IS NULL THEN 0 ELSE 1 END AS nrows_copy,
           CASE WHEN c.o_orderkey IS NULL THEN 'added' WHEN o.o_orderkey IS NULL THEN 'removed'
                ELSE 'changed' END AS change
    FROM (SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders) o
    FULL JOIN ({_COPY}) c ON o.o_orderkey = c.o_orderkey
    WHERE o.o_orderkey IS NULL OR c.o_orderkey IS NULL
          OR o.o_orderstatus IS DISTINCT FROM c.o_orderstatus""")
def copy_changed_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which orders a copy lacks, has beyond the original, or holds with other content."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    copy = orders.selectExpr(
        "CASE WHEN o_orderkey % 101 = 0 THEN -o_orderkey ELSE o_orderkey END AS o_orderkey",
        "CASE WHEN o_orderkey % 103 = 0 THEN NULL ELSE o_orderstatus END AS o_orderstatus",
        "o_orderpriority",
    )
    return changed_keys(orders, copy, ["o_orderkey"], 4096)


_COUNTERS_SQL = f"""
    SELECT row_number() OVER (PARTITION BY early ORDER BY champion_name, sport, medal_type)
               + CASE WHEN early THEN 0 ELSE sum(CASE WHEN early THEN 1 ELSE 0 END) OVER () END
               AS id,
           champion_name, sport, medal_type, count,
           CASE WHEN early THEN TIMESTAMP '{FIRST}' ELSE TIMESTAMP '{SECOND}' END AS created_at,
           CASE WHEN late THEN TIMESTAMP '{SECOND}' ELSE TIMESTAMP '{FIRST}' END AS updated_at
    FROM (SELECT cast(o_custkey AS varchar) AS champion_name, o_orderpriority AS sport,
                 o_orderstatus AS medal_type, count(*) AS count,
                 bool_or(o_orderdate < DATE '{SPLIT}') AS early,
                 bool_or(o_orderdate >= DATE '{SPLIT}') AS late
          FROM orders GROUP BY o_custkey, o_orderpriority, o_orderstatus)"""


def _hits(orders: DataFrame) -> DataFrame:
    return orders.select(
        F.col("o_custkey").cast("string").alias("champion_name"),
        F.col("o_orderpriority").alias("sport"),
        F.col("o_orderstatus").alias("medal_type"),
    )


def _counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders as counter hits, in two rounds split by date."""
    orders, root = table(spark, sf_dir, "orders"), scratch_path(spark, "counters")
    create_if_absent(spark, root, COUNTERS)
    early = F.col("o_orderdate") < F.lit(SPLIT).cast("timestamp_ntz")
    for part, as_of in ((early, FIRST), (~early, SECOND)):
        apply_hits(_hits(orders.filter(part)), root, KEYS, as_of)
    return read_snapshot(spark, root)


@query("counter_upsert", f"SELECT * REPLACE (cast(id AS bigint) AS id) FROM ({_COUNTERS_SQL})")
def counter_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _counters(spark, sf_dir)


@query("counter_upsert_buckets", f"SELECT * REPLACE (cast(id AS bigint) AS id) FROM ({_COUNTERS_SQL})")
def counter_upsert_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same counters in key-hash buckets; a batch rewrites only those it hits."""
    orders, root = table(spark, sf_dir, "orders"), scratch_path(spark, "counters")
    create_buckets(spark, root, COUNTERS, KEYS, buckets=64)
    early = F.col("o_orderdate") < F.lit(SPLIT).cast("timestamp_ntz")
    for batch, (part, as_of) in enumerate(((early, FIRST), (~early, SECOND)), 1):
        raise_counters(_hits(orders.filter(part)), root, as_of, batch_id=batch)
    return read_buckets(spark, root)


@query(
    "counter_rows_of_category",
    f"SELECT 'O' AS medal_type, count(*) AS count FROM ({_COUNTERS_SQL}) WHERE medal_type = 'O'",
)
def counter_rows_of_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many counters a category has."""
    return category_count(_counters(spark, sf_dir), "medal_type", "O")
