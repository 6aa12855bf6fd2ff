import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strataflow.functions.text import clean_text_arrow, clean_text_column
from strataflow.operators.cleaning import clean_text, drop_copies, normalise_text, text_columns

PROBE = "Zoë O'Neil \\ \"a\" 1-2"


def one(spark, value, **options):
    df = spark.createDataFrame([(value,)], "t string")
    return df.select(clean_text_column(F.col("t"), **options)).first()[0]


@pytest.mark.parametrize(
    "options, expected",
    [
        ({}, "ZoO'Neil\\\"a\"12"),
        ({"keep_backslash": False}, "ZoO'Neil\"a\"12"),
        ({"keep_space": True}, "Zo O'Neil \\ \"a\" 12"),
    ],
)
def test_kept_characters(spark, options, expected):
    assert one(spark, PROBE, **options) == expected


@pytest.mark.parametrize(
    "policy, null, empty, dashes",
    [("keep", None, "", ""), ("literal", "None", "", ""), ("empty_to_null", None, None, "")],
)
def test_null_policies(spark, policy, null, empty, dashes):
    assert one(spark, None, null_policy=policy) == null
    assert one(spark, "", null_policy=policy) == empty
    assert one(spark, "---", null_policy=policy) == dashes


def test_long_runs_need_no_stack(spark):
    for unit in ("a", "-", "a-"):
        text = unit * 1_000_000
        assert one(spark, text) == text.replace("-", "")


def test_trim_follows_cleaning(spark):
    assert one(spark, " -a b- ", keep_space=True, trim=True) == "a b"
    assert one(spark, " -a b- ", keep_space=True) == " a b "


def test_unknown_policy_raises():
    with pytest.raises(ValueError):
        clean_text_column(F, null_policy="drop")


def test_range_loses_its_dash(spark):
    assert one(spark, "63-65") == "6365"


def test_only_string_columns_are_cleaned(spark):
    df = spark.createDataFrame([(1, "a-b", -2.5)], "i int, t string, d double")
    assert text_columns(df) == ["t"]
    assert clean_text(df).collect() == [(1, "ab", -2.5)]


def test_named_columns_and_unknown_names(spark):
    df = spark.createDataFrame([("a-b", "c-d")], "x string, y string")
    assert clean_text(df, ["y"]).collect() == [("a-b", "cd")]
    assert clean_text(df, []).collect() == [("a-b", "c-d")]
    with pytest.raises(ValueError):
        clean_text(df, ["z"])


def test_column_names_with_dots(spark):
    df = spark.createDataFrame([("a-b",)], "`x.y` string")
    assert clean_text(df).collect() == [("ab",)]


def test_normalise(spark):
    df = spark.createDataFrame([("  Ab C ", None)], "x string, y string")
    assert normalise_text(df).collect() == [("ab c", None)]


def test_rows_equal_after_cleaning_merge(spark):
    df = spark.createDataFrame([("a-b", 1), ("ab", 1), ("ab", 2), (None, 1), (None, 1)],
                               "t string, n int")
    rows = drop_copies(clean_text(df)).collect()
    assert sorted(rows, key=str) == sorted([("ab", 1), ("ab", 2), (None, 1)], key=str)


@settings(max_examples=25, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.one_of(st.none(), st.text(max_size=30)), min_size=1, max_size=20),
       st.booleans(), st.booleans(), st.sampled_from(["keep", "literal", "empty_to_null"]))
def test_native_arrow_and_plain_regex_agree(spark, texts, space, backslash, policy):
    options = {"keep_space": space, "keep_backslash": backslash, "null_policy": policy}
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    rows = df.select(
        "i",
        clean_text_column(F.col("t"), **options).alias("native"),
        clean_text_arrow(**options)(F.col("t")).alias("arrow"),
    ).collect()
    kept = "a-zA-Z0-9,.\"'" + (r"\\" if backslash else "") + (" " if space else "")
    for row in rows:
        text = texts[row.i]
        if text is None:
            expected = "None" if policy == "literal" else None
        elif text == "" and policy == "empty_to_null":
            expected = None
        else:
            expected = re.sub(f"[^{kept}]", "", text)
        assert row.native == row.arrow == expected
