"""Targets and the sampled mix against a brute-force version."""

import hashlib
import math
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from strataflow.llm import mixing
from tests.llm.conftest import ODD_TEXTS


def slow_targets(sizes, weights=mixing.WEIGHTS, most=3.0):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    total, capped = sum(sizes.values()), {s for s in sizes if sizes[s] == 0}
    while True:
        rest = [s for s in order if s not in capped]
        spent = sum(most * sizes[s] for s in capped)
        rate = (total - spent) / sum(weight[s] for s in rest) if rest else 0
        over = {s for s in rest if weight[s] * rate > most * sizes[s]}
        if not over:
            return {s: most * sizes[s] if s in capped else weight[s] * rate for s in order}
        capped |= over


def slow_mix(rows):
    size = [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, t, _ in rows]
    sizes = defaultdict(int)
    for (_, _, source), n in zip(rows, size, strict=True):
        sizes[source] += n
    targets = slow_targets(sizes)
    taken = [0] * len(rows)
    for source in sizes:
        mine = [k for k, r in enumerate(rows) if r[2] == source]
        keys = {}
        for k in mine:
            text = rows[k][1] or ""
            label = "|".join(("mix", "" if rows[k][0] is None else str(rows[k][0]), text))
            draw = (int(hashlib.md5(label.encode()).hexdigest()[:13], 16) + 0.5) / 2**52
            noisy = len(re.findall(r"[#*$%&|<>{}=_~^\\]", text))
            worth = max(0.25, 1 - noisy / max(len(text), 1) * 4)
            keys[k] = -math.log(draw) / worth
        epochs = math.floor(targets[source] / max(sizes[source], 1))
        left, passed = targets[source] - epochs * sizes[source], 0
        for k in sorted(mine, key=lambda k: (keys[k], rows[k][0] or 0, size[k])):
            extra = size[k] > 0 and left > 0 and passed + size[k] / 2 <= left
            taken[k] = (epochs + extra) * size[k]
            passed += size[k]
    return sorted((str(r[0]), n, sizes[r[2]], t) for r, n, t in zip(rows, size, taken, strict=True)), targets


def corpus():
    rows = [(i, t, None) for i, t in ODD_TEXTS if len(t or "") < 1000]
    rows += [(100 + k, f"text {k} " * (k % 7 + 1), "big") for k in range(120)]
    rows += [(300 + k, "small one here $$$", "aside") for k in range(3)]
    return rows + [(400, "", "void"), (500, "é " * 40, "Zoo"), (500, "é " * 40, "Zoo")]


@pytest.mark.parametrize("bucket_rows", [7, 1_000])
def test_matches_brute_force(docs, bucket_rows):
    rows = corpus()
    got = mixing.mix_sources(docs(rows), bucket_rows=bucket_rows).collect()
    expected, targets = slow_mix(rows)
    assert sorted((str(r.doc_id), r.size, r.source_size, r.taken) for r in got) == expected
    for row in got:
        assert row.target == pytest.approx(targets[row.source])
        assert row.taken <= 3 * row.size


def test_documents_are_repeated_as_often_as_taken(docs):
    rows = corpus()
    table = docs(rows).withColumn("copies", F.lit("clash"))
    mixed = mixing.mixed_documents(table)
    assert mixed.columns == table.columns
    expected, _ = slow_mix(rows)
    words = sum(len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) for r in mixed.collect())
    assert words == sum(t for *_, t in expected)


def test_empty_table_and_empty_texts(docs):
    assert mixing.mix_sources(docs([])).count() == 0
    assert mixing.mixed_documents(docs([])).count() == 0
    got = mixing.mix_sources(docs([(1, None), (2, "")])).collect()
    assert [(r.size, r.target, r.taken) for r in got] == [(0, 0.0, 0)] * 2
