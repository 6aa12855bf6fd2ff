"""Prefix trie: against a plain trie, over block and segment borders, and odd rows."""

import zlib
from hashlib import sha256

import pytest

from strataflow.llm import prefix_trie
from strataflow.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string"


def _original(rows):
    """Each conversation's (role, text) in order."""
    convs = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            key = (turn is not None, turn or 0, role or "")
            convs.setdefault(conv, []).append((key, (role or "", text or "")))
    return {c: [t for _, t in sorted(turns, key=lambda t: t[0])] for c, turns in convs.items()}


def _rebuilt(convs):
    made = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        made[c] = convs.get(c - c % 5, [])[:h] + own[h:]
    return made


def _trie(convs):
    """Result rows by walking each prefix of each conversation."""
    members, children = {}, {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            node = tuple(turns[:d])
            members.setdefault(node, set()).add(c)
            if d:
                children.setdefault(node[:-1], set()).add(node)
    saved, leaves = {}, {}
    for node in sorted(members, key=len, reverse=True):
        below = children.get(node, ())
        last = len(node[-1][1].encode()) if node else 0
        saved[node] = (len(members[node]) - 1) * last + sum(saved[k] for k in below)
        leaves[node] = sum(leaves[k] for k in below) if below else 1
    rows = []
    for node, inside in members.items():
        ends = ",".join(str(c) for c in sorted(inside) if len(convs[c]) == len(node))
        parent = min(members[node[:-1]]) if node else None
        rows.append(
            (min(inside), len(node), parent, len(inside), len(children.get(node, ())),
             leaves[node], saved[node], sha256(ends.encode()).hexdigest())
        )
    return sorted(rows, key=str)


def _got(frame):
    return sorted(map(tuple, frame.collect()), key=str)


def test_query_matches_a_plain_trie(spark):
    table = spark.read.parquet(f"{SF_DIR}/conversations.parquet")
    rows = table.select("conv_id", "turn", "role", "text").collect()
    assert _got(QUERIES["op12_prefix_trie"](spark, SF_DIR)) == _trie(_rebuilt(_original(rows)))


def _tree_rows(n, depth, words=2):
    """Conversations over few words: many share long prefixes, some are equal."""
    rows = []
    for c in range(n):
        state = c * 2654435761 % 2**32
        for turn in range(state % (depth + 1)):
            state = (state * 1103515245 + 12345) % 2**31
            word = "same" if turn < depth // 2 else "abcdef"[(state >> 16) % words]
            rows.append((c, turn, "user" if turn % 2 else None, word * (turn % 3 + 1)))
    return rows


@pytest.mark.parametrize(("segment", "block"), [(1024, 65_536), (4, 7), (1, 5), (3, 1), (1024, 2)])
def test_blocks_and_segments_change_nothing(spark, segment, block):
    rows = _tree_rows(120, 14)
    convs = _original(rows)
    turns, sizes = prefix_trie.rebuilt(spark.createDataFrame(rows, SCHEMA))
    got = prefix_trie.prefix_nodes(turns, sizes, segment=segment, block=block)
    assert _got(got) == _trie(_rebuilt(convs))


def test_conversations_as_they_are(spark):
    rows = _tree_rows(60, 9, words=3)
    got = prefix_trie.conversation_trie(spark.createDataFrame(rows, SCHEMA))
    assert _got(got) == _trie(_original(rows))


def test_long_and_copied_conversations(spark):
    long = [(c, t, "user", f"turn {t}") for c in (5, 6, 10) for t in range(2_500 + c)]
    copies = [(c, 0, "user", "hello") for c in range(20, 320)]
    rows = long + copies
    turns, sizes = prefix_trie.rebuilt(spark.createDataFrame(rows, SCHEMA))
    got = prefix_trie.prefix_nodes(turns, sizes, segment=100, block=300)
    assert _got(got) == _trie(_rebuilt(_original(rows)))


def test_nulls_odd_texts_and_extra_columns(spark):
    rows = [
        (None, 0, "user", "no conversation"),
        (1, None, "user", "first of all"),
        (1, 0, None, None),
        (1, 0, None, None),
        (2, 3, "user", "\U0001f600 \u65e5\u672c"),
        (2, 1, "", ""),
        (-3, 0, "user", "negative"),
        (7, 0, "user", "x" * 100_000),
        (11, 0, "user", "alone, without a base"),
    ]
    table = spark.createDataFrame(
        [(*r, 1, "x", True) for r in rows], SCHEMA + ", depth int, seq string, pid boolean"
    )
    got = prefix_trie.conversation_trie(table)
    assert _got(got) == _trie(_original(rows))


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert _got(prefix_trie.conversation_trie(empty)) == []
    assert _got(prefix_trie.prefix_nodes(*prefix_trie.rebuilt(empty))) == []
