import pytest

from strataflow.sinks.layers import read_layer
from strataflow.plans.medallion import (
    DIMENSION,
    FACT,
    RECIPES,
    Recipe,
    aggregate,
    averaged,
    refined,
    run_medallion,
    run_table,
)
from strataflow.sources.tables import UnknownTable


@pytest.fixture
def landing(tmp_path):
    bio = "athlete_id,name,sex,height,weight,country_noc\n1,Zoë A,F,170,63-65,U-K\n2,Bo,M,,80.5,UA\n"
    fact = (
        "athlete_id,sport,event,medal,country_noc\n"
        "1,Rowing,a b,Gold,GB\n1,Rowing,a-b,Gold,G-B\n2,Judo,x,,UA\n3,Judo,x,,UA\n"
    )
    for name, text in ((DIMENSION, bio), (FACT, fact)):
        (tmp_path / "landing" / name).mkdir(parents=True)
        (tmp_path / "landing" / name / "part.csv").write_text(text, encoding="utf-8")
    return str(tmp_path / "landing")


def gold(spark, landing, tmp_path, recipe):
    path = run_medallion(spark, landing, str(tmp_path / "lake"), recipe)
    rows = read_layer(spark, path)
    return rows, sorted(tuple(r)[:6] for r in rows.collect())


def test_plain(spark, landing, tmp_path):
    rows, values = gold(spark, landing, tmp_path, RECIPES["plain"])
    # The two rowing rows differ only in removed characters, and so does the range.
    assert values == [
        ("Judo", None, "M", "UA", 80.5, None), ("Rowing", "Gold", "F", "GB", 6365.0, 170.0)
    ]
    assert rows.dtypes[-1] == ("timestamp", "timestamp")
    silver = read_layer(spark, str(tmp_path / "lake" / "silver" / FACT))
    assert silver.count() == 3


def test_measured_rows_only_with_labels(spark, landing, tmp_path):
    _, values = gold(spark, landing, tmp_path, RECIPES["measured_rounded"])
    assert values == [("Rowing", "Gold", "F", "UK", 6365.0, 170.0)]


def test_silver_may_hold_numbers(spark, landing, tmp_path):
    gold(spark, landing, tmp_path, RECIPES["measured_rounded"])
    silver = read_layer(spark, str(tmp_path / "lake" / "silver" / DIMENSION))
    assert dict(silver.dtypes)["height"] == "double"
    assert [r.name for r in silver.collect()] == ["Zo A"]


def test_whole_numbers_and_other_stamp(spark, landing, tmp_path):
    rows, values = gold(spark, landing, tmp_path, RECIPES["whole_numbers"])
    assert rows.columns[-1] == "processing_timestamp"
    assert ("Judo", "None", "M", "UA", 80.0, None) in values


def test_schema_instead_of_inference(spark, landing, tmp_path):
    typed = {
        FACT: "athlete_id int, sport string, event string, medal string, country_noc string",
        DIMENSION: "athlete_id int, name string, sex string, height int, weight string,"
        " country_noc string",
    }
    schemas = {t: spark.createDataFrame([], ddl).schema for t, ddl in typed.items()}
    _, given = gold(spark, landing, tmp_path, Recipe(types=schemas))
    _, inferred = gold(spark, landing, tmp_path, RECIPES["typed"])
    assert given == inferred


def test_tables_as_separate_jobs(spark, landing, tmp_path):
    lake, recipe = str(tmp_path / "lake"), RECIPES["plain"]
    for table in (FACT, DIMENSION):
        run_table(spark, landing, lake, table, recipe)
    out = f"{lake}/gold/one"
    aggregate(spark, f"{lake}/silver/{FACT}", f"{lake}/silver/{DIMENSION}", out, recipe)
    assert read_layer(spark, out).count() == 2
    with pytest.raises(UnknownTable):
        run_table(spark, landing, lake, "medals", recipe)


def test_filled_rule_comes_before_conversion(spark):
    fact = spark.createDataFrame([(1, "s", "m", "c"), (2, "s", "m", "c")],
                                 "athlete_id int, sport string, medal string, country_noc string")
    dim = spark.createDataFrame(
        [(1, "F", "x", "60,5"), (2, "F", None, "70")],
        "athlete_id int, sex string, height string, weight string",
    )
    rows = averaged(fact, dim, RECIPES["comma_fixed"]).collect()
    assert [(r.avg_weight, r.avg_height) for r in rows] == [(60.5, None)]


def test_named_columns_only(spark):
    df = spark.createDataFrame([(None, "a-b")], "event string, sport string")
    assert refined(df, FACT, RECIPES["named_columns"]).collect() == [("None", "a-b")]
