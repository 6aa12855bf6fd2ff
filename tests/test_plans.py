"""The plans that matter at scale: pushdown, pruning, few shuffles, no Python."""

from datetime import datetime

import pytest

import __spark_entry__ as contract
from strataflow.operators import freshness
from tests.plans import initial, physical

SF_DIR = "/root/testdata/sf0.001"

# Built without running anything, so a plan is cheap to look at.
LAZY = [
    n
    for n in contract.queries()
    if n.startswith(("avg_", "clean_", "category_count_one", "category_count_all",
                     "category_count_cte", "enrich_", "freshness_", "json_", "label_",
                     "measure", "normalise", "parity", "parquet_scan", "stamp", "event_age",
                     "copy_count", "log_listing", "layer_preview"))
]


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_join_and_no_python(spark, name):
    plan = physical(contract.queries()[name](spark, SF_DIR))
    assert "CartesianProduct" not in plan
    assert "NestedLoopJoin" not in plan
    if name != "clean_text_udf":
        assert "Python" not in plan


@pytest.mark.parametrize(
    "name, shuffles",
    [("avg_stats_results_country", 1), ("avg_stats_measured", 1), ("avg_stats_folded", 2),
     ("clean_then_dedup", 1), ("clean_text_strict", 0), ("measured_only", 0),
     ("json_encode_keyed", 0), ("label_missing_sentinels", 0), ("freshness_exists", 0)],
)
def test_shuffles_with_a_small_dimension(spark, name, shuffles):
    plan = initial(contract.queries()[name](spark, SF_DIR))
    # A final global limit or count takes one single-partition exchange at most.
    assert plan.count("Exchange hashpartitioning") == shuffles


def test_scan_reads_only_what_is_needed(spark):
    plan = physical(contract.queries()["avg_stats_measured"](spark, SF_DIR))
    assert "o_totalprice" not in plan and "c_name" not in plan and "c_acctbal" not in plan
    plan = physical(contract.queries()["parquet_scan_pruned"](spark, SF_DIR))
    assert "EqualTo(o_orderstatus,F)" in plan
    assert "o_custkey" in plan and "o_orderpriority" not in plan


def test_recency_filters_reach_the_scan(spark):
    events = spark.read.parquet(f"{SF_DIR}/events.parquet")
    now = datetime(2024, 1, 31)
    for df in (
        freshness.newest_within_flag(events, "ts", 30, now),
        freshness.newest_strictly_within(events, "ts", 30, now),
        freshness.recent_count(events, "ts", 30, now),
        freshness.any_recent(events, "ts", 30, now),
        freshness.any_recent(events, "ts", 30, now, whole_seconds=True),
        freshness.latest_recent_row(events, "ts", 30, "event_id", now),
    ):
        assert "PushedFilters: [IsNotNull(ts), GreaterThan" in physical(df)


def test_dedup_collapses_copies_before_the_shuffle(spark):
    plan = initial(contract.queries()["clean_then_dedup"](spark, SF_DIR))
    below = plan.split("Exchange hashpartitioning")[1]
    assert "HashAggregate" in below


def test_measured_filter_sits_below_the_join(spark):
    df = contract.queries()["avg_stats_measured"](spark, SF_DIR)
    plan = initial(df)
    assert plan.index("Join") < plan.index("isnotnull(try_cast")


def test_latest_row_needs_no_full_sort(spark):
    df = contract.queries()["freshness_latest_row"](spark, SF_DIR)
    assert "TakeOrderedAndProject" in physical(df)


def test_messages_are_parsed_once(spark):
    plan = initial(contract.queries()["json_decode_rows"](spark, SF_DIR))
    assert plan.count("from_json(StructField(event_id") == 1
