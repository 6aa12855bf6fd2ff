"""Linked vectors against brute force, recall at the threshold, odd vectors."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from strataflow.llm import vectors

SCHEMA = "vec_id long, embedding array<float>, label int"


def slow(rows, cosine=0.93):
    good = []
    for i, v, label in rows:
        usable = label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)
        good.append(np.array(v, np.float32).astype(np.float64) if usable else None)
    links = [set() for _ in rows]
    for a, x in enumerate(good):
        for b, y in enumerate(good):
            if a < b and x is not None and y is not None and len(x) == len(y) and rows[a][2] == rows[b][2]:
                if x @ y / np.sqrt((x @ x) * (y @ y)) >= cosine:
                    links[a].add(b)
                    links[b].add(a)
    result = []
    for a in range(len(rows)):
        seen, todo = {a}, [a]
        while todo:
            for b in links[todo.pop()] - seen:
                seen.add(b)
                todo.append(b)
        ids = [rows[b][0] for b in seen if rows[b][0] is not None]
        result.append((rows[a][0], len(links[a]), min(ids, default=None)))
    return sorted(result, key=str)


def got(spark, rows, **options):
    table = spark.createDataFrame(rows, SCHEMA)
    found = vectors.near_vectors(table, **options).collect()
    assert all(r.kept == (r.vec_id == r.component_id) for r in found)
    return sorted(((r.vec_id, r.n_links, r.component_id) for r in found), key=str)


def planted(count, size=24, seed=5):
    dice = np.random.default_rng(seed)
    rows = []
    for k in range(count):
        base = dice.standard_normal(size)
        for _ in range(1 + 3 * (k % 4 == 0)):
            near = base / np.linalg.norm(base) + dice.standard_normal(size) * 0.05
            rows.append((len(rows), near.tolist(), k % 3))
    rows += [(len(rows) + k, rows[0][1], 0) for k in range(40)]
    return rows


def test_matches_brute_force(spark):
    rows = planted(240)
    assert got(spark, rows) == slow(rows)


def test_recall_at_the_threshold(spark):
    dice, rows, pairs = np.random.default_rng(1), [], 0
    for k in range(600):
        x = dice.standard_normal(64)
        x /= np.linalg.norm(x)
        y = dice.standard_normal(64)
        y -= (y @ x) * x
        y /= np.linalg.norm(y)
        cosine = 0.9301 + 0.01 * dice.random()
        rows += [(2 * k, x.tolist(), 1), (2 * k + 1, (cosine * x + np.sqrt(1 - cosine**2) * y).tolist(), 1)]
    found = got(spark, rows)
    expected = slow(rows)
    assert sum(r[1] for r in found) >= 0.97 * sum(r[1] for r in expected)
    assert all(f[1] <= e[1] for f, e in zip(found, expected, strict=True))


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], None), (4, None, 1), (5, [], 1),
        (6, [0.0, 0.0], 1), (7, [nan, 1.0], 1), (8, [inf, 1.0], 1), (9, [None, 1.0], 1),
        (10, [1.0, 0.0, 0.0], 1), (11, [1.0, 0.0], 2), (None, [1.0, 0.0], 1), (2, [2.0, 0.0], 1),
        (12, [-0.0, 1.0], 3), (13, [0.0, 1.0], 3), (14, [1e-38, 0.0], 4), (15, [3e38, 0.0], 4),
    ]
    found = got(spark, rows)
    assert found == slow(rows)


def test_calibration_and_columns(spark):
    assert vectors.calibrated_tables(0) < vectors.calibrated_tables(8) < vectors.calibrated_tables(16)
    table = spark.createDataFrame([(1, [1.0], 1)], SCHEMA).withColumn("Kept", F.lit(9)).withColumn("size", F.lit(3))
    assert vectors.near_vectors(table).columns == ["vec_id", "label", "size", "n_links", "component_id", "kept"]
    assert vectors.near_vectors(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("sf_dir", ["/root/testdata/sf0.001"])
def test_table(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    assert got(spark, rows) == slow(rows)
