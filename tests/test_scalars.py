import math
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from strataflow.functions.clock import at_most_whole_seconds_old, stamp, whole_seconds_between
from strataflow.functions.jsonrows import decode_rows, encode_rows
from strataflow.functions.labels import MISSING_WORDS, fill_label
from strataflow.functions.measures import to_measure
from strataflow.functions.parity import parity_power
from strataflow.sources.tables import RESULT_MESSAGE_TEXT, RESULT_MESSAGE_TYPED


def measure(spark, text, **options):
    df = spark.createDataFrame([(text,)], "t string")
    return df.select(to_measure(F.col("t"), **options)).first()[0]


@pytest.mark.parametrize(
    "text, expected",
    [("75.5", 75.5), (" 70 ", 70.0), ("63-65", None), ("63,65", None), ("", None),
     ("None", None), (None, None), ("6365", 6365.0)],
)
def test_double(spark, text, expected):
    assert measure(spark, text) == expected


def test_decimal_comma(spark):
    assert measure(spark, "63,65", decimal_comma=True) == 63.65


def test_nan_is_a_number_unless_rejected(spark):
    assert math.isnan(measure(spark, "nan"))
    assert measure(spark, "nan", reject_nan=True) is None
    assert measure(spark, "nan", kind="int") is None


def test_int_truncates_through_double(spark):
    assert measure(spark, "75.5", kind="int") == 75
    assert measure(spark, "-75.9", kind="int") == -75
    assert measure(spark, "3000000000", kind="int") is None


def test_float_is_single_precision(spark):
    assert measure(spark, "63.65", kind="float") != 63.65
    assert abs(measure(spark, "63.65", kind="float") - 63.65) < 1e-5


def test_numeric_column_passes_through(spark):
    df = spark.createDataFrame([(1.5,), (None,)], "d double")
    assert df.select(to_measure(F.col("d"), decimal_comma=True)).collect() == [(1.5,), (None,)]


def test_unknown_kind_raises():
    with pytest.raises(ValueError):
        to_measure(F, kind="decimal")


def test_labels(spark):
    values = [None, "", "None", " NaN ", "none", "NULL", "Gold"]
    df = spark.createDataFrame([(v,) for v in values], "m string")
    basic = [r[0] for r in df.select(fill_label(F.col("m"))).collect()]
    assert basic == ["No medal", "No medal", "None", " NaN ", "none", "NULL", "Gold"]
    full = df.select(fill_label(F.col("m"), sentinels=MISSING_WORDS))
    assert [r[0] for r in full.collect()] == ["No medal"] * 6 + ["Gold"]


@pytest.mark.parametrize("ts_type", ["timestamp", "timestamp_ntz"])
def test_whole_seconds_cut_towards_zero(spark, ts_type):
    now = stamp(datetime(2024, 3, 10, 12), ts_type)
    df = spark.createDataFrame(
        [("2024-03-10 11:59:29.1", 30), ("2024-03-10 11:59:29", 31), ("2024-03-10 12:00:30.9", -30)],
        "t string, age long",
    ).withColumn("t", F.col("t").cast(ts_type))
    rows = df.select(
        "age",
        whole_seconds_between(F.col("t"), now).alias("got"),
        at_most_whole_seconds_old(F.col("t"), now, 30).alias("within"),
    ).collect()
    for row in rows:
        assert row.got == row.age
        assert row.within == (row.age <= 30)


def test_zone_less_age_ignores_clock_changes(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame([("2024-03-10 01:00:00",)], "t string")
        age = whole_seconds_between(
            F.col("t").cast("timestamp_ntz"), stamp(datetime(2024, 3, 10, 4), "timestamp_ntz")
        )
        assert df.select(age).first()[0] == 3 * 3600
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_stamp_defaults_to_the_query_time(spark):
    rows = spark.range(3).select(stamp().alias("now")).distinct()
    assert rows.count() == 1
    assert rows.schema["now"].dataType.simpleString() == "timestamp"


def test_parity_keeps_big_integers(spark):
    df = spark.createDataFrame([(4,), (-3,), (2_000_001,)], "n long")
    got = [r[0] for r in df.select(parity_power(F.col("n"))).collect()]
    assert got == [16, -27, 2_000_001**3]


def test_json_round_trip_and_defects(spark):
    df = spark.createDataFrame([(5, None, "x"), (6, "G", "y")],
                               "athlete_id int, medal string, sport string")
    messages = encode_rows(df, key="athlete_id")
    assert messages.collect()[0] == ("5", '{"athlete_id":5,"sport":"x"}')
    broken = messages.select("value").union(
        spark.createDataFrame([("not json",), ('{"athlete_id": "many", "sport": "z"}',)], "v string")
    )
    text = decode_rows(broken, RESULT_MESSAGE_TEXT).select("athlete_id", "medal", "sport")
    assert text.collect() == [
        ("5", None, "x"), ("6", "G", "y"), (None, None, None), ("many", None, "z")
    ]
    typed = decode_rows(broken, RESULT_MESSAGE_TYPED, required="athlete_id")
    assert typed.select("athlete_id", "medal", "sport").collect() == [
        (5, None, "x"), (6, "G", "y")
    ]


def test_absent_field_and_null_message(spark):
    df = spark.createDataFrame([('{"a": 1}',), (None,), ("[]",)], "value string")
    assert decode_rows(df, "a int, b int").collect()[:2] == [(1, None), (None, None)]
    assert decode_rows(df, "a int, b int", required="a").collect() == [(1, None)]


def test_binary_messages_decode(spark):
    df = spark.createDataFrame([(bytearray(b'{"a": 5}'),)], "value binary")
    assert decode_rows(df, "a string").collect() == [("5",)]
