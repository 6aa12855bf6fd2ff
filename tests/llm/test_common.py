"""Filters of keys that are broadcast."""

from pyspark.sql import functions as F

from strataflow.llm.common import FILTER_BITS, key_filter, may_have


def test_a_key_filter_misses_none_and_is_of_one_size(spark):
    rows = spark.range(-50_000, 50_000).select((F.col("id") * (1 << 33) + F.col("id") % 7).alias("row"))
    for share in (0, 3, 1):
        keys = rows.where(f"pmod(row, 100) < {share}") if share != 1 else rows
        found = key_filter(keys, "row")
        (words,) = found.collect()[0]
        assert len(words) == FILTER_BITS // 64
        hits, rest = may_have(rows, "row", found), may_have(rows, "row", found, have=False)
        assert keys.join(hits, "row", "left_anti").count() == 0
        assert hits.count() + rest.count() == rows.count()
        assert keys.count() <= hits.count() <= keys.count() + 2_500
        assert "BroadcastNestedLoopJoin" in hits._jdf.queryExecution().executedPlan().toString()
