"""Components of chains, stars and odd edges."""

from strataflow.llm.components import connected_components


def found(spark, edges):
    table = spark.createDataFrame(edges, "x long, y long")
    return dict(connected_components(table, "x", "y").collect())


def test_chain_star_and_repeats(spark):
    chain = [(k, k + 1) for k in range(100, 140)]
    star = [(500, k) for k in range(501, 520)] + [(510, 500), (510, 511)]
    got = found(spark, [*chain, *star, (7, 7), (None, 3), (1, 2), (2, 1)])
    assert {got[k] for k in range(100, 141)} == {100}
    assert {got[k] for k in range(500, 520)} == {500}
    assert got[1] == got[2] == 1
    assert 7 not in got and 3 not in got


def test_no_edges(spark):
    assert found(spark, []) == {}
