"""Near copies by exact similarity against brute force."""

import random
import re

import numpy as np
import pandas as pd
import pytest

from strataflow.llm import jaccard
from strataflow.sinks.snapshots import child_names
from tests.llm.conftest import ODD_TEXTS


def shingles(text, size=5):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        lower = lower.replace(c, " ")
    words = [w for w in lower.split(" ") if w]
    return {tuple(words[k : k + size]) for k in range(len(words) - size + 1)} or {tuple(words)}


def slow_kept(rows, similarity=0.8):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if len(sets[a] & sets[b]) >= similarity * len(sets[a] | sets[b]) - 1e-9:
                root[find(a)] = find(b)
    best = {}
    for k, (i, _) in enumerate(rows):
        best[find(k)] = min(best.get(find(k), (True, 0)), (i is None, i or 0))
    return sorted(best.values())


def kept(frame):
    return sorted((r.doc_id is None, r.doc_id or 0) for r in frame.select("doc_id").collect())


def pages(dice, count):
    return [f"w{dice.randrange(10**9)}" for _ in range(count)]


def with_tail(dice, base, similarity):
    """The base and a tail of its own that leave exactly this similarity, or just more."""
    many = len(base) - 4
    return base + pages(dice, int(many / similarity) - many)


def test_pairs_below_the_similarity_stay(docs):
    dice, rows = random.Random(1), []
    for k, similarity in enumerate((0.5, 0.55, 0.6, 0.65, 0.7, 0.75, 0.78, 0.79)):
        base = pages(dice, 300)
        rows += [(2 * k, " ".join(base)), (2 * k + 1, " ".join(with_tail(dice, base, similarity)))]
    # Two texts that each repeat a word share no shingle.
    rows += [(50, "so " * 40), (51, "so " * 20 + "la " * 20)]
    assert len(kept(jaccard.drop_similar(docs(rows)))) == len(rows)


@pytest.mark.parametrize("similarity", [0.8, 0.85])
def test_contiguous_edits_go(docs, similarity):
    dice, rows = random.Random(2), []
    for k in range(100):
        base = pages(dice, 304)
        rows += [(2 * k, " ".join(base)), (2 * k + 1, " ".join(with_tail(dice, base, similarity)))]
    for k in range(100, 200):
        base = pages(dice, 304)
        # A block of b words takes b + 4 shingles from either text.
        block = int(300 * (1 - similarity) / (1 + similarity)) - 4
        rows += [(2 * k, " ".join(base)), (2 * k + 1, " ".join(base[:90] + pages(dice, block) + base[90 + block :]))]
    assert kept(jaccard.drop_similar(docs(rows))) == [(False, 2 * k) for k in range(200)]


@pytest.mark.parametrize("unit_rows", [3, 2_000])
def test_matches_brute_force(docs, monkeypatch, unit_rows):
    monkeypatch.setattr(jaccard, "UNIT_ROWS", unit_rows)
    dice, rows = random.Random(3), []
    for k in range(6):
        base = pages(dice, 60)
        for n in range(9):
            text = base.copy()
            for _ in range(dice.randrange(4)):
                text[dice.randrange(60)] = f"e{dice.randrange(10**6)}"
            rows.append((20 * k + n, " ".join(text)))
    rows += ODD_TEXTS
    assert kept(jaccard.drop_similar(docs(rows))) == slow_kept(rows)


def test_matches_brute_force_on_documents(spark):
    frame = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    assert kept(jaccard.drop_similar(frame)) == slow_kept([tuple(r) for r in frame.collect()])


def test_empty_table(docs):
    assert jaccard.drop_similar(docs([])).count() == 0


@pytest.mark.parametrize("unit_rows", [4, 2_000])
def test_a_star_whose_members_miss_its_centre(docs, monkeypatch, unit_rows):
    """A chain of near copies: each is similar to the next, the ends are not."""
    monkeypatch.setattr(jaccard, "UNIT_ROWS", unit_rows)
    monkeypatch.setattr(jaccard, "STAR_ROWS", unit_rows)
    dice, rows = random.Random(4), []
    text = pages(dice, 300)
    for k in range(30):
        rows.append((k, " ".join(text)))
        text = text.copy()
        text[10 * k : 10 * k + 6] = pages(dice, 6)
    rows += [(100 + k, " ".join(pages(dice, 300))) for k in range(5)]
    found = kept(jaccard.drop_similar(docs(rows)))
    assert found == slow_kept(rows) == [(False, 0), *((False, 100 + k) for k in range(5))]


def test_wide_maps_bound_the_similarity():
    dice = random.Random(5)
    for many in (1, 50, 4_000, 20_000):
        base = pages(dice, many)
        for edits in (0, many // 100, many // 20, many):
            other = base.copy()
            for k in dice.sample(range(many), edits):
                other[k] = f"e{k}"
            one, two = (jaccard._shingles(" ".join(t), 5) for t in (base, other))
            for bits in (jaccard.MAP_BITS, jaccard.WIDE_BITS):
                maps = [int.from_bytes(jaccard._parity(x, bits)) for x in (one, two)]
                apart = len(one) + len(two) - 2 * len(set(one.tolist()) & set(two.tolist()))
                assert (maps[0] ^ maps[1]).bit_count() <= apart


def test_only_what_the_result_reads_stays(spark, docs):
    place = spark.conf.get("spark.checkpoint.dir") + "/strataflow"
    before = set(child_names(spark, place))
    result = jaccard.drop_similar(docs(ODD_TEXTS))
    left = {n.rsplit("-", 1)[0] for n in set(child_names(spark, place)) - before}
    assert left == {"similar-docs", "similar-gone"}
    assert kept(result) == slow_kept(ODD_TEXTS)


def unit_of(texts):
    """One unit of the lists, as their rows come with maps."""
    sets = [jaccard._shingles(t, 5) for t in texts]
    rows = {"key": 0, "one": 0, "two": 0, "side": 0, "node": range(len(sets)), "root": range(len(sets))}
    maps = [jaccard._parity(x, jaccard._map_bits(len(x), 0.8)) for x in sets]
    return pd.DataFrame(rows | {"size": [len(x) for x in sets], "bits": maps})


def test_large_unrelated_texts_of_a_list_are_ruled_out():
    """Maps of 1,024 bits are full from some 2,300 shingles on and rule nothing out."""
    dice = random.Random(6)
    passage = pages(dice, 50)
    unit = unit_of([" ".join(passage + pages(dice, many)) for many in (300, 2_500, 2_900, 6_000, 6_100, 15_000)])
    assert list(jaccard._linked(0.8)(iter([unit]))) == []


def test_maps_of_different_widths_keep_what_is_similar():
    dice = random.Random(7)
    for many in (1_900, 3_800, 7_500):
        base = pages(dice, many)
        texts = [" ".join(base), " ".join(pages(dice, many)), " ".join(with_tail(dice, base, 0.8))]
        unit = unit_of(texts)
        assert unit["bits"].map(len).nunique() == 2
        (found,) = jaccard._linked(0.8)(iter([unit]))
        assert found[["a", "b"]].to_numpy().tolist() == [[2, 0]]
    # A map of more bits, folded, is the one of fewer.
    hashes = jaccard._shingles(" ".join(pages(dice, 500)), 5)
    maps = [jaccard._parity(hashes, bits) for bits in (1_024, 2_048, 16_384)]
    table = jaccard._folded(maps, np.array([1_024, 2_048, 16_384]), 1_024)
    assert [row.tobytes() for row in table] == [maps[0]] * 3


def test_lists_of_the_same_nodes_are_one(spark):
    """Texts with a passage share a head for each of its shingles and meet once for all of them."""
    rows = [(1, 1, [10, 11, 12, 20]), (2, 2, [10, 11, 12, 21]), (3, 3, [20, 21, 30]), (4, 1, [20, 31]),
            (5, 5, [40, 41]), (6, 5, [40, 41])]
    found = jaccard._lists(spark.createDataFrame(rows, "node long, root long, heads array<long>"))
    lists = {}
    for r in found.collect():
        lists.setdefault((r.key, r.many), []).append(r.node)
    assert sorted(sorted(x) for x in lists.values()) == [[1, 2], [1, 3, 4], [2, 3]]
    assert all(many == len(nodes) for (_, many), nodes in lists.items())


def test_heads_are_shuffled_once_and_without_maps(spark, docs, monkeypatch):
    """The most rows of the near-copy search: 20 million on 0.5 GB of documents."""
    plans = []
    stage = jaccard.Workspace.stage

    def spy(work, frame):
        plans.append(frame._jdf.queryExecution().executedPlan().toString())
        return stage(work, frame)

    monkeypatch.setattr(jaccard.Workspace, "stage", spy)
    jaccard.drop_similar(docs(ODD_TEXTS))
    exploded = [p for p in plans if "Generate explode(heads" in p]
    assert len(exploded) == 1
    dealt = re.findall(r"Exchange hashpartitioning\(head#", exploded[0])
    assert len(dealt) == 1 and "bits#" not in exploded[0].split("Generate explode(heads")[0]


@pytest.mark.parametrize("list_rows", [3, 8_000])
def test_shared_passages_match_brute_force(docs, monkeypatch, list_rows):
    """Lists with many dissimilar texts, few near copies among them, dealt out in chunks."""
    monkeypatch.setattr(jaccard, "LIST_ROWS", list_rows)
    dice, rows = random.Random(8), []
    passages = [pages(dice, 40) for _ in range(3)]
    for k in range(60):
        text = passages[k % 3] + pages(dice, 150 + k) + passages[k // 30]
        rows.append((2 * k, " ".join(text)))
        if k % 7 == 0:
            rows.append((2 * k + 1, " ".join(with_tail(dice, text, 0.82))))
    found = kept(jaccard.drop_similar(docs(rows)))
    assert found == slow_kept(rows) and len(found) < len(rows)


def test_texts_that_nothing_is_asked_of_are_not_shuffled(spark, docs, monkeypatch):
    """Also where the lists of nodes and of dropped rows are too long to be broadcast."""
    dice, rows = random.Random(9), []
    for k in range(80):
        text = pages(dice, 60)
        rows.append((2 * k, " ".join(text)))
        if k % 8 == 0:
            rows.append((2 * k + 1, " ".join(with_tail(dice, text, 0.85))))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        result = jaccard.drop_similar(docs(rows))
        assert kept(result) == slow_kept(rows)
        plan = result._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    anti = re.findall(r"(BroadcastNestedLoopJoin|SortMergeJoin)[^\n]* (LeftAnti|LeftSemi)", plan)
    assert ("BroadcastNestedLoopJoin", "LeftAnti") in anti and ("BroadcastNestedLoopJoin", "LeftSemi") in anti
