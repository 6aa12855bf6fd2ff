"""Fingerprints, the trie join and near-copy groups against brute force."""

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from strataflow.llm import simhash
from tests.llm.conftest import ODD_TEXTS

MASK = (1 << 64) - 1


def slow_fingerprint(text, size=3):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        lower = lower.replace(c, " ")
    words = [w for w in lower.split(" ") if w]
    if not words:
        return 0
    shingles = [words[k : k + size] for k in range(len(words) - size + 1)] or [words]
    hashes = [xxhash.xxh64_intdigest(" ".join(s).encode(), 42) for s in shingles]
    value = 0
    for bit in range(64):
        if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes):
            value |= 1 << bit
    return value


def slow_components(prints, budget):
    root = {p: p for p in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in prints:
        for b in prints:
            if a < b and (a ^ b).bit_count() <= budget:
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return {p: find(p) for p in prints}


def classes(of):
    groups = {}
    for key, root in of.items():
        groups.setdefault(root, set()).add(key)
    return {frozenset(g) for g in groups.values()}


def test_fingerprints_match_the_definition(docs):
    rows = docs(ODD_TEXTS).select("text", simhash.fingerprint("text").alias("fp")).collect()
    for row in rows:
        assert row.fp & MASK == slow_fingerprint(row.text)


def test_hash_is_that_of_spark(spark):
    row = spark.range(1).select(F.xxhash64(F.lit("a b c")).alias("h")).first()
    assert row.h & MASK == xxhash.xxh64_intdigest("a b c", 42)


def clustered(count, seed):
    dice, found = random.Random(seed), set()
    while len(found) < count:
        base = dice.getrandbits(64)
        for _ in range(dice.choice((1, 1, 5, 30))):
            found.add(base ^ sum(1 << b for b in dice.sample(range(64), dice.choice((0, 1, 2, 3, 4)))))
    return sorted(found)


@pytest.mark.parametrize("budget", [3, 5, 11])
@pytest.mark.parametrize("unit_rows", [16, 20_000])
def test_links_join_all_values_within_the_budget(spark, budget, unit_rows):
    values = clustered(400, budget)
    signed = np.array(values, np.uint64).view(np.int64).tolist()
    prints = spark.createDataFrame([(v, v) for v in signed], "node long, fp long")
    links = simhash.near_links(prints, budget, unit_rows=unit_rows).collect()
    root = {v: v for v in values}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        assert ((a ^ b) & MASK).bit_count() <= 64
        low, high = sorted((find(a & MASK), find(b & MASK)))
        root[high] = low
    assert classes({v: find(v) for v in values}) == classes(slow_components(values, budget))


def test_a_second_fingerprint_confirms(spark):
    rows = [(1, 0b0, 0), (2, 0b1, 1), (3, 0b10, -1)]
    prints = spark.createDataFrame(rows, "node long, fp long, check long")
    links = simhash.near_links(prints, 3, check_budget=2).collect()
    assert {frozenset(r) for r in links} == {frozenset((1, 2))}


def test_groups_match_brute_force(spark, docs):
    rows = docs(ODD_TEXTS).withColumn("FP", F.lit("clash")).withColumn("root", F.lit(1))
    got = simhash.near_groups(rows).select("doc_id", "fp", "component_id").collect()
    assert len(got) == len(ODD_TEXTS)
    prints = [(i, slow_fingerprint(t)) for i, t in ODD_TEXTS]
    roots = slow_components({p for _, p in prints}, 3)
    names = {}
    for i, p in prints:
        if i is not None:
            names[roots[p]] = min(i, names.get(roots[p], i))
    expected = sorted((str(i), p, names.get(roots[p])) for i, p in prints)
    assert sorted((str(r.doc_id), r.fp & MASK, r.component_id) for r in got) == expected


def test_one_document_of_a_group_stays(docs):
    base = " ".join(f"w{k}" for k in range(300))
    rows = docs([(3, base), (2, base), (9, base + " extra"), (4, "else " * 9), (2, base), (None, "x y z")]).withColumn("row", F.lit(1))
    kept = simhash.drop_near_copies(rows, size=3, budget=11, check_size=5, check_budget=14)
    assert kept.columns == rows.columns
    assert sorted((r.doc_id or 0, r.text[:4]) for r in kept.collect()) == [
        (0, "x y "), (2, "w0 w"), (4, "else"),
    ]


def test_empty_table(docs):
    assert simhash.near_groups(docs([])).count() == 0
    assert simhash.drop_near_copies(docs([])).count() == 0
