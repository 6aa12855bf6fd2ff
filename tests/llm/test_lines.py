"""Line templates against a brute-force version."""

import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from strataflow.llm import lines
from strataflow.sinks.snapshots import child_names
from tests.llm.conftest import ODD_TEXTS

WORD = r"[^\x20\x09-\x0D]+"


def slow_templates(line, depth=3, windows=5):
    tokens = [lines.FIELD if re.search("[0-9]", w) else w for w in re.findall(WORD, line)]
    size = len(tokens)
    leaf = (size, *tokens[:depth])
    found = [(leaf, -1, *tokens)]
    if size >= windows:
        for k in range(windows):
            low, high = size * k // windows, size * (k + 1) // windows
            found.append((leaf, k, "head", *tokens[:low], "tail", *tokens[high:]))
    return found


def slow_dedup(rows, least=5, share=0.8):
    texts = defaultdict(set)
    first = {}
    for i, text in rows:
        for line in (text or "").split("\n"):
            if re.search(WORD, line):
                for template in slow_templates(line):
                    texts[template].add(text or "")
                    key = (i is None, i or 0, text)
                    if template not in first or (key[:2] < first[template][:2]):
                        first[template] = key
    result = []
    for i, text in rows:
        kept, dropped = [], 0
        all_lines = (text or "").split("\n")
        for line in all_lines:
            repeated = re.search(WORD, line) and any(
                len(texts[t]) >= least and first[t] != (i is None, i or 0, text)
                for t in slow_templates(line)
            )
            dropped += bool(repeated)
            if not repeated:
                kept.append(line)
        if len("\n".join(kept)) < len(text or "") * (1 - share):
            kept, dropped = all_lines, 0
        result.append((str(i), None if text is None else "\n".join(kept), dropped))
    return sorted(result, key=str)


def corpus():
    own = [f"own text {'abcdefgh'[k]} with words that no other document has in it" for k in range(8)]
    footer = "All rights reserved by the company of the year {} in the land"
    named = "Posted on Monday by {} in the forum of cats and dogs"
    rows = []
    for k in range(8):
        rows.append((k + 10, f"{own[k]}\n{footer.format(1990 + k)}\n{named.format('abcdefgh'[k] * 3)}\n\nshort"))
    rows += [(40, "whole copy of a page\nsecond line of it"), (41, "whole copy of a page\nsecond line of it")]
    rows += [(50 + k, "a page of one line that is the same but for its end " + "z" * k) for k in range(6)]
    return rows + ODD_TEXTS


def test_matches_brute_force(docs):
    rows = corpus()
    got = lines.drop_recurring_lines(docs(rows)).collect()
    assert sorted(((str(r.doc_id), r.text, r.n_dropped) for r in got), key=str) == slow_dedup(rows)
    by_id = {r.doc_id: r for r in got}
    assert by_id[10].n_dropped == 0 and by_id[11].n_dropped == 3
    assert "own text b" in by_id[11].text and "rights" not in by_id[11].text
    assert by_id[11].n_chars == len(by_id[11].text)


@pytest.mark.parametrize("name", ["documents"])
def test_matches_brute_force_on_documents(spark, docs, name):
    rows = [tuple(r) for r in spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet").select("doc_id", "text").collect()]
    got = lines.drop_recurring_lines(docs(rows), min_documents=3).collect()
    assert sorted(((str(r.doc_id), r.text, r.n_dropped) for r in got), key=str) == slow_dedup(rows, least=3)


def test_columns_pass_through(docs):
    rows = docs([(1, "a b"), (None, None)]).withColumn("places", F.lit(7)).withColumn("N_lines", F.lit(0))
    got = lines.drop_recurring_lines(rows)
    assert got.columns == [*rows.columns[:-1], "n_lines", "n_dropped"]
    assert sorted((r.places, r.n_lines) for r in got.collect()) == [(7, 0), (7, 1)]


def test_empty_table(docs):
    assert lines.drop_recurring_lines(docs([])).count() == 0


def test_a_passage_of_two_texts_recurs(docs):
    passage = " ".join(f"{a}{b}" for a in "abcdef" for b in "qrstuvwxyz")
    more = "more words of its own " * 9
    numbers = " ".join(["row"] + ["{}"] * 30)
    rows = [(1, f"one of its own\n{passage}"), (2, f"{passage}\nanother with {more}\nshort line")]
    rows += [(3, "third text\nshort line"), (4, numbers.format(*range(30)) + "\nfour"), (5, numbers.format(*range(9, 39)) + "\nfive")]
    got = {r.doc_id: (r.text, r.n_dropped) for r in lines.drop_recurring_lines(docs(rows)).collect()}
    assert got == {i: (t, 0) for i, t in rows} | {2: (f"another with {more}\nshort line", 1)}


def test_a_text_of_mostly_boilerplate_is_cut_to_its_own_lines(docs):
    shared = [f"boilerplate of the kind {c * 4} that {c * 3} pages show" for c in "abcdefgh"]
    rows = [(k, "\n".join([*shared, "own " + "xyzuvw"[k] * 9])) for k in range(6)]
    rows.append((9, "\n".join(shared)))
    got = {r.doc_id: (r.text, r.n_dropped) for r in lines.drop_recurring_lines(docs(rows)).collect()}
    assert got[0] == (rows[0][1], 0) and got[9] == (rows[-1][1], 0)
    assert all(got[k] == ("own " + "xyzuvw"[k] * 9, 8) for k in range(1, 6))


@pytest.mark.parametrize(
    "form",
    [
        "Posted on this day by {0} in the {1} forum of the board of all our members",
        "Here is what our {0} {1} wrote to us about the last days",
    ],
)
def test_fields_may_be_several_and_anywhere(docs, form):
    names = ["anna", "bert", "carl", "dora", "emil", "fritz", "gerd"]
    rows = [
        (k, f"own {n}\n{form.format(n, names[k - 3] + 'ish')}")
        for k, n in enumerate(names)
    ]
    got = {r.doc_id: r.n_dropped for r in lines.drop_recurring_lines(docs(rows)).collect()}
    assert got == {0: 0} | dict.fromkeys(range(1, 7), 1)


def test_texts_of_many_lines_take_time_in_proportion(docs):
    shared = [f"shared line {'abcdefghij'[k % 10]} {'x' * (k % 97)} {'y' * (k // 97)}" for k in range(20_000)]
    rows = [(k, "\n".join(["own " + "xyzuvw"[k] * 9, *shared])) for k in range(6)]
    got = {r.doc_id: (r.text, r.n_dropped) for r in lines.drop_recurring_lines(docs(rows)).collect()}
    assert got[0] == (rows[0][1], 0)
    assert all(got[k] == ("own " + "xyzuvw"[k] * 9, 20_000) for k in range(1, 6))


def test_a_line_of_very_many_words(docs):
    line = " ".join("abcdefghij"[k % 10] * (k % 13 + 1) for k in range(100_000))
    got = {r.doc_id: r.n_dropped for r in lines.drop_recurring_lines(docs([(1, f"one\n{line}"), (2, f"two\n{line}")])).collect()}
    assert got == {1: 0, 2: 1}


def test_only_the_places_of_dropped_lines_stay(spark, docs):
    """The staged lines of all texts are as large as the texts."""
    place = spark.conf.get("spark.checkpoint.dir") + "/strataflow"
    before = set(child_names(spark, place))
    result = lines.drop_recurring_lines(docs([*ODD_TEXTS, *((100 + k, f"own {'abcdefg'[k]}\nthe same line") for k in range(7))]))
    left = {n.rsplit("-", 1)[0] for n in set(child_names(spark, place)) - before}
    assert left == {"line-places"}
    assert result.agg(F.sum("n_dropped")).first()[0] == 6
