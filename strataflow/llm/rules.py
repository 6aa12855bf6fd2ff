"""Quality rules as weak supervision. DataFrame functions only."""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataflow.llm.common import stage, whole, without, words

WINDOW = 3
ROUNDS = 25
#: Posterior probability of good quality from which a document is kept.
THRESHOLD = 0.5
GOOD, ABSTAIN, BAD = 1, 0, -1
_SPACE_CLASS = r"[\x20\x09-\x0D]"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once per row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _repeat_words(found: Column) -> Column:
    """Number of words in windows that occur at least twice, from the words of a text."""

    def keys(hashes: Column) -> Column:
        return F.transform(
            F.slice(hashes, F.lit(1), F.greatest(F.size(hashes) - (WINDOW - 1), F.lit(0))),
            lambda h, at: F.xxhash64(h, F.get(hashes, at + 1), F.get(hashes, at + 2)),
        )

    def covered(starts: Column) -> Column:
        # Windows that follow each other closely share words.
        gaps = F.transform(
            starts, lambda s, at: F.coalesce(F.least(F.get(starts, at + 1) - s, F.lit(WINDOW)), F.lit(WINDOW))
        )
        return F.aggregate(gaps, F.lit(0), lambda total, gap: total + gap)

    def repeated(ordered: Column) -> Column:
        twins = F.filter(
            ordered,
            lambda w, at: (w["key"] == F.get(ordered, at + 1)["key"])
            | ((at > 0) & (w["key"] == F.get(ordered, F.greatest(at - 1, F.lit(0)))["key"])),
        )
        return _let(F.sort_array(F.transform(twins, lambda w: w["at"])), covered)

    def count(windows: Column) -> Column:
        placed = F.transform(windows, lambda k, at: F.struct(k.alias("key"), at.alias("at")))
        return F.when(
            F.size(F.array_distinct(windows)) < F.size(windows),
            _let(F.sort_array(placed), repeated),
        ).otherwise(F.lit(0))

    hashed = F.transform(found, lambda w: F.xxhash64(w))
    return _let(hashed, lambda hashes: _let(keys(hashes), count))


def measures(docs: DataFrame) -> DataFrame:
    """Every row, without its text, with counts over the whole text (NULL: none)."""
    text = whole("text")
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))

    def of_lines(found: Column) -> Column:
        return F.struct(
            F.size(found).alias("n"), (F.size(found) - F.size(F.array_distinct(found))).alias("dup")
        )

    def of_words(found: Column) -> Column:
        return F.struct(
            F.size(found).alias("n"),
            F.size(F.array_distinct(found)).alias("distinct"),
            _repeat_words(found).alias("repeat"),
        )

    counted = docs.withColumns({"_w": _let(words(text), of_words), "_l": _let(lines, of_lines)})

    def long(value: Column) -> Column:
        return value.cast("bigint")

    return counted.withColumns(
        {
            "n_words": long(F.col("_w.n")),
            "word_chars": long(F.length(text) - F.regexp_count(text, F.lit(_SPACE_CLASS))),
            "n_symbols": long(F.regexp_count(text, F.lit("[#*$%&|<>]"))),
            "n_dup_lines": long(F.col("_l.dup")),
            "n_repeat_words": long(F.col("_w.repeat")),
            "_n_lines": long(F.col("_l.n")),
            "_n_distinct": long(F.col("_w.distinct")),
            "_n_capitals": long(F.regexp_count(text, F.lit(r"\p{Lu}"))),
            "_n_cries": long(F.regexp_count(text, F.lit("[!?]"))),
            "_n_bars": long(F.regexp_count(text, F.lit(r"\|"))),
            "_n_odd": long(F.regexp_count(text, F.lit(r"[^\p{L}\p{N}\s.,;:'-]"))),
        }
    ).drop("text", "_w", "_l")


MEASURES = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "_n_lines",
    "_n_distinct",
    "_n_capitals",
    "_n_cries",
    "_n_bars",
    "_n_odd",
)


@dataclass(frozen=True)
class Rule:
    """A share of two measures; it votes good or bad beyond its bounds and else abstains."""

    part: str
    of: str
    good_to: float
    bad_from: float

    def vote(self) -> Column:
        share = F.col(self.part) / F.col(self.of)
        if self.good_to < self.bad_from:
            bad, good = share >= self.bad_from, share <= self.good_to
        else:
            bad, good = share <= self.bad_from, share >= self.good_to
        known = F.when(bad, F.lit(BAD)).when(good, F.lit(GOOD)).otherwise(F.lit(ABSTAIN))
        return F.when(F.col(self.of) > 0, known).otherwise(F.lit(ABSTAIN))


RULES = (
    Rule("n_symbols", "word_chars", good_to=0.01, bad_from=0.05),
    Rule("n_repeat_words", "n_words", good_to=0.1, bad_from=0.35),
    Rule("n_dup_lines", "_n_lines", good_to=0.05, bad_from=0.4),
    Rule("_n_capitals", "word_chars", good_to=0.12, bad_from=0.4),
    Rule("_n_cries", "n_words", good_to=0.05, bad_from=0.25),
    Rule("_n_bars", "n_words", good_to=0.01, bad_from=0.15),
    Rule("_n_odd", "n_words", good_to=0.15, bad_from=0.4),
    Rule("_n_distinct", "n_words", good_to=0.35, bad_from=0.15),
)


@dataclass(frozen=True)
class VoteModel:
    """Prior of good quality and, by rule, the probability of each vote in either class."""

    prior: float
    given_good: tuple[dict[int, float], ...]
    given_bad: tuple[dict[int, float], ...]

    def posterior(self, votes: list[Column]) -> Column:
        odds = F.lit(math.log(self.prior / (1 - self.prior)))
        for vote, good, bad in zip(votes, self.given_good, self.given_bad, strict=True):
            ratio = {v: math.log(good[v] / bad[v]) for v in (BAD, ABSTAIN, GOOD)}
            odds += (
                F.when(vote == BAD, ratio[BAD])
                .when(vote == GOOD, ratio[GOOD])
                .otherwise(ratio[ABSTAIN])
            )
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-odds))


def fit_votes(votes: DataFrame, names: list[str], rounds: int = ROUNDS) -> VoteModel:
    """Accuracies of the rules by expectation-maximisation over all rows of votes.

    Rows with the same votes count as one pattern with a number, so a round reads at most
    ``3 ** len(names)`` rows, whatever the input. It starts from the number of bad votes,
    where one alone is a doubt and two agree, which also decides which class is the good
    one. One row of sums a round reaches the driver.
    """
    patterns = stage(votes.groupBy(*names).agg(F.count(F.lit(1)).alias("n")), "votes").coalesce(1)
    columns = [F.col(n) for n in names]
    against = F.size(F.filter(F.array(*columns), lambda v: v == BAD))
    posterior = F.when(against == 0, 0.95).when(against == 1, 0.4).otherwise(0.02)
    model = None
    for _ in range(rounds):
        weighed = patterns.withColumn("good", F.col("n") * posterior)
        sums = [F.sum("n").alias("all"), F.sum("good").alias("all_good")]
        for at, column in enumerate(columns):
            for vote in (BAD, ABSTAIN, GOOD):
                sums.append(F.sum(F.when(column == vote, F.col("n")).otherwise(0)).alias(f"n{at}_{vote}"))
                sums.append(F.sum(F.when(column == vote, F.col("good")).otherwise(0.0)).alias(f"g{at}_{vote}"))
        row = weighed.agg(*sums).first()
        total, good = float(row["all"] or 0), float(row["all_good"] or 0.0)
        given_good, given_bad = [], []
        for at in range(len(columns)):
            in_good = {v: float(row[f"g{at}_{v}"] or 0.0) for v in (BAD, ABSTAIN, GOOD)}
            in_all = {v: float(row[f"n{at}_{v}"] or 0.0) for v in (BAD, ABSTAIN, GOOD)}
            given_good.append({v: (in_good[v] + 1) / (good + 3) for v in in_good})
            given_bad.append(
                {v: (in_all[v] - in_good[v] + 1) / (total - good + 3) for v in in_all}
            )
        fresh = VoteModel((good + 1) / (total + 2), tuple(given_good), tuple(given_bad))
        settled = model is not None and abs(fresh.prior - model.prior) < 1e-9
        model = fresh
        posterior = model.posterior(columns)
        if settled:
            break
    return model


def judge_documents(
    docs: DataFrame,
    rules: tuple[Rule, ...] = RULES,
    rounds: int = ROUNDS,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """Every row, without its text, with its measures, ``base_failed``, ``posterior`` and ``kept``.

    Each rule votes for good or bad quality or abstains; none has a veto. Their accuracies
    are estimated from how they agree over all rows, and a document's posterior
    probability weighs its votes by them. It is kept if that reaches ``threshold`` and the
    base does not fail: fewer than 50 words, or more than half of them in windows of three
    that repeat. NULL and empty texts have no words and fail. Without rows the result is
    empty. Input columns named as a result are replaced.
    """
    results = ("base_failed", "posterior", "kept")
    rows = stage(measures(without(docs, *MEASURES, *results)), "rules")
    names = [f"_vote{k}" for k in range(len(rules))]
    voted = rows.withColumns({n: r.vote() for n, r in zip(names, rules, strict=True)})
    # Texts without a word have nothing to vote on.
    model = fit_votes(voted.where(F.col("n_words") > 0).select(*names), names, rounds)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    judged = voted.withColumn("base_failed", failed).withColumn(
        "posterior", model.posterior([F.col(n) for n in names])
    )
    hidden = [m for m in MEASURES if m.startswith("_")]
    return judged.withColumn(
        "kept", ~F.col("base_failed") & (F.col("posterior") >= threshold)
    ).drop(*names, *hidden)
