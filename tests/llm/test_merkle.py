"""Merkle manifest: against a plain construction, tampering, and odd rows."""

import zlib
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from strataflow.llm import merkle
from strataflow.llm.queries import QUERIES
from tests.llm.conftest import ODD_TEXTS

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def _hash(text):
    return sha256(text.encode()).hexdigest()


def _leaf(row):
    values = [None if row[f] is None else str(row[f]) for f in FIELDS]
    return _hash("".join("-" if v is None else f"{len(v.encode())}:{v}" for v in values))


def _tree(digests):
    """The root and each node's list of (before, after)."""
    paths = [[] for _ in digests]
    below = [[k] for k in range(len(digests))]
    while len(digests) > 1:
        up, up_below = [], []
        for at in range(0, len(digests), 8):
            run = digests[at : at + 8]
            for k in range(len(run)):
                for leaf in below[at + k]:
                    paths[leaf].append(("".join(run[:k]), "".join(run[k + 1 :])))
            up.append(_hash("".join(run)))
            up_below.append(sum(below[at : at + 8], []))
        digests, below = up, up_below
    return digests[0], paths


def _expected(rows):
    """Each row's (doc_id, leaf, subroot, root, path), in order."""
    parts = {}
    for row in rows:
        parts.setdefault(row["lang"], []).append((row["doc_id"], _leaf(row)))
    names = sorted(parts, key=lambda n: (n is not None, (n or "").encode()))
    for name in names:
        parts[name].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    trees = [_tree([leaf for _, leaf in parts[name]]) for name in names]
    root, over = _tree([subroot for subroot, _ in trees])
    return [
        (doc_id, leaf, subroot, root, path + over[k])
        for k, (name, (subroot, paths)) in enumerate(zip(names, trees, strict=True))
        for (doc_id, leaf), path in zip(parts[name], paths, strict=True)
    ]


def _got(docs):
    leaf = merkle.leaf_digest([F.col(f) for f in FIELDS])
    made = merkle.manifest(docs, leaf, "lang", "doc_id", ["doc_id"])
    return [
        (r["doc_id"], r["leaf"], r["subroot"], r["root"], [tuple(s) for s in r["path"]])
        for r in made.rows.collect()
    ], made


def _sorted(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))


@pytest.mark.parametrize("n", [1, 2, 8, 9, 65, 130])
def test_trees_as_built_plainly(spark, n):
    """Parts that stop at different levels, one of a single row, and a NULL part."""
    rows = [
        (k, f"Text {k} Äß", None if k % 5 == 4 else "en" if k else "solo", "web", k)
        for k in range(n)
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got, made = _got(docs)
    want = _expected([r.asDict() for r in docs.collect()])
    assert _sorted(got) == _sorted(want)
    inner = made.nodes.where("level > 0 OR part IS NULL")
    assert inner.where("hi <= lo").count() == 0
    assert made.nodes.where("part IS NOT NULL AND level = 0").count() == n


def test_many_parts(spark):
    rows = [(k, "t", f"l{k % 70}", "web", 1) for k in range(150)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got, _ = _got(docs)
    assert _sorted(got) == _sorted(_expected([r.asDict() for r in docs.collect()]))


def test_odd_rows_repeats_and_clashing_columns(spark, docs):
    rows = docs([*ODD_TEXTS, *ODD_TEXTS]).withColumn("n_chars", F.when(F.col("doc_id") > 4, 7))
    for name in ("path", "root", "id", "digest", "part", "size", "lo", "hi", "item", "_at", "_tie"):
        rows = rows.withColumn(name, F.lit("mine"))
    leaf = merkle.leaf_digest([F.col(f) for f in FIELDS])
    made = merkle.manifest(rows, leaf, "lang", "doc_id", rows.columns).rows
    got = made.collect()
    want = _expected([r.asDict() for r in rows.collect()])
    assert sorted((r["leaf"], r["root"]) for r in got) == sorted((w[1], w[3]) for w in want)
    assert {r["digest"] for r in got} == {"mine"} and {r["_tie"] for r in got} == {"mine"}
    assert made.where(merkle.fold("path", F.col("leaf")) != F.col("root")).count() == 0


def test_no_rows(docs):
    got, made = _got(docs([]))
    assert got == [] and made.nodes.count() == 0


@pytest.mark.parametrize("sf_dir", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_query_as_built_plainly(spark, sf_dir):
    rows = [r.asDict() for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    want = {w[0]: w for w in _expected(rows)}
    texts = {r["doc_id"]: r for r in rows}
    upper = {c: c + 32 for c in range(65, 91)}
    for got in QUERIES["op13_merkle"](spark, sf_dir).collect():
        _, leaf, subroot, root, path = want.pop(got["doc_id"])
        assert (got["leaf"], got["subroot"], got["root"]) == (leaf, subroot, root)
        assert got["proof_sha256"] == _hash("".join(a + b for a, b in path))
        row = dict(texts[got["doc_id"]])
        if zlib.crc32(str(got["doc_id"]).encode()) % 3 == 0 and row["text"] is not None:
            row["text"] = row["text"].translate(upper)
        at = _leaf(row)
        for before, after in path:
            at = _hash(before + at + after)
        assert got["folded_root"] == at
        assert got["verified"] == (at == root)
    assert not want
