"""Properties over generated rows."""

from collections import Counter
from datetime import datetime, timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strataflow.functions.clock import at_most_whole_seconds_old, stamp, whole_seconds_between
from strataflow.functions.measures import to_measure
from strataflow.operators.cleaning import drop_copies
from strataflow.operators.counts import category_counts
from strataflow.operators.upsert import upsert_counter

quick = settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
NOW = datetime(2024, 1, 1, 12)
OLD = datetime(2023, 1, 1)


@quick
@given(st.lists(st.one_of(st.none(), st.decimals(-9999, 9999, places=2)), min_size=1))
def test_decimal_texts_convert(spark, numbers):
    texts = [None if n is None else str(n).replace(".", ",") for n in numbers]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    rows = df.select(
        "i",
        to_measure(F.col("t"), decimal_comma=True).alias("d"),
        to_measure(F.col("t"), "int", decimal_comma=True).alias("n"),
        to_measure(F.col("t")).alias("raw"),
    ).collect()
    for row in rows:
        number = numbers[row.i]
        assert row.d == (None if number is None else float(number))
        assert row.n == (None if number is None else int(number))
        assert row.raw is None  # a comma is no decimal point unless it is made one


@quick
@given(st.lists(st.integers(-90_000_000, 90_000_000), min_size=1))
def test_pushable_recency_equals_the_whole_second_rule(spark, micros):
    times = [(str(NOW - timedelta(microseconds=m)),) for m in micros]
    df = spark.createDataFrame(times, "t string").withColumn("t", F.col("t").cast("timestamp_ntz"))
    now = stamp(NOW, "timestamp_ntz")
    same = at_most_whole_seconds_old(F.col("t"), now, 30) == (
        whole_seconds_between(F.col("t"), now) <= 30
    )
    assert df.filter(~same).count() == 0


@quick
@given(st.lists(st.sampled_from(["a", "b", "c", "", None])))
def test_counts_and_dedup(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "m string")
    tally = Counter(values)
    counts = {r.medal_type: r["count"] for r in category_counts(df, "m", ["a", "b", "z"]).collect()}
    assert counts == {"a": tally["a"], "b": tally["b"], "z": 0}
    assert Counter(r.m for r in drop_copies(df).collect()) == Counter(set(values))


@quick
@given(
    st.dictionaries(st.sampled_from("abcdef"), st.integers(0, 9)),
    st.lists(st.sampled_from("abcdefgh")),
)
def test_upsert_equals_a_dictionary(spark, stored, hits):
    target = spark.createDataFrame(
        [(k, n, OLD, OLD) for k, n in stored.items()],
        "k string, count long, created_at timestamp_ntz, updated_at timestamp_ntz",
    )
    rows = upsert_counter(
        target, spark.createDataFrame([(h,) for h in hits], "k string"), ["k"], NOW
    ).collect()
    expected = {
        k: (
            stored.get(k, 0) + hits.count(k),
            OLD if k in stored else NOW,
            NOW if k in hits else OLD,
        )
        for k in {*stored, *hits}
    }
    assert {r.k: tuple(r)[1:] for r in rows} == expected
