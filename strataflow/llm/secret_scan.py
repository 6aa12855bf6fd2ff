"""Secret scans with a ledger of blobs that were scanned before. DataFrame functions only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow.llm.common import whole, without


@dataclass(frozen=True)
class SecretRule:
    """A pattern, and the group and number of characters that a match has to have.

    A changed pattern needs a new version: the ledger then scans every blob for it again.
    """

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    version: int = 1

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


# The first three patterns and their lengths are the base scan's.
BASE_KINDS = ("assign", "access", "hex")
RULES = (
    SecretRule(
        "assign",
        r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?"
        r"([A-Za-z0-9+/_.=-]+)",
        group=2,
        least=6,
    ),
    # A run of the class is matched whole, so its length can be part of the pattern.
    SecretRule("access", r"AKIA[A-Z0-9]{16,}"),
    SecretRule("hex", r"[0-9a-f]{24,}"),
    SecretRule("pem", r"-----BEGIN (?:[A-Z0-9]+ )*PRIVATE KEY-----"),
    SecretRule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"),
)
_SPAN = "struct<at: int, until: int, rule: string>"
_LEDGER = f"blob string, scanned array<string>, findings array<{_SPAN}>"


def _spans(text: Column, rule: SecretRule) -> Column:
    """Matches of a rule, leftmost and apart from each other, in code points.

    The text between matches and the matches themselves take turns, so a match starts
    after the lengths of all before it.
    """
    pattern = F.lit(rule.pattern)
    gaps = F.transform(F.split(text, rule.pattern, -1), lambda s: F.length(s))

    def lengths(group: int) -> Column:
        matches = F.regexp_extract_all(text, pattern, F.lit(group))
        return F.transform(matches, lambda s: F.length(s))

    found = F.arrays_zip(
        lengths(0).alias("long"), lengths(rule.group).alias("part"), gaps.alias("gap")
    )

    def add(state: Column, step: Column) -> Column:
        start = state["end"] + step["gap"]
        end = start + F.coalesce(step["long"], F.lit(0))
        span = F.struct(start.alias("at"), end.alias("until"), F.lit(rule.key).alias("rule"))
        more = F.when(step["part"] >= rule.least, F.array(span)).otherwise(F.array().cast(f"array<{_SPAN}>"))
        return F.struct(end.alias("end"), F.concat(state["spans"], more).alias("spans"))

    empty = F.array().cast(f"array<{_SPAN}>")
    state = F.aggregate(
        found, F.struct(F.lit(0).alias("end"), empty.alias("spans")), add, lambda s: s["spans"]
    )
    return F.when(text.rlike(rule.pattern), state).otherwise(empty)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """One row per blob: the rules it was scanned for and what they found; empty if absent."""
    try:
        rows = spark.read.schema(_LEDGER).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _LEDGER)
    # Two runs at the same time may both have scanned a blob; both found the same.
    return rows.groupBy("blob").agg(
        F.array_distinct(F.flatten(F.collect_list("scanned"))).alias("scanned"),
        F.array_distinct(F.flatten(F.collect_list("findings"))).alias("findings"),
    )


def scan_unseen(
    docs: DataFrame, ledger: str, rules: tuple[SecretRule, ...] = RULES
) -> None:
    """Scan the blobs of ``docs.text`` that the ledger lacks, and append what was found.

    A blob is the SHA-256 of a whole text. Each pair of a blob and a rule's version is
    scanned once: equal texts, and texts of earlier runs, are not scanned again, and a
    new rule scans old blobs for itself alone. A run that is lost adds nothing.
    """
    text = whole("text")
    blobs = docs.select(F.sha2(text, 256).alias("blob"), text.alias("text")).dropDuplicates(["blob"])
    every = F.array(*[F.lit(r.key) for r in rules])
    seen = read_ledger(docs.sparkSession, ledger).select("blob", "scanned")
    todo = (
        blobs.join(seen, "blob", "left")
        .withColumn(
            "todo", F.array_except(every, F.coalesce("scanned", F.array().cast("array<string>")))
        )
        .where(F.size("todo") > 0)
    )
    spans = [
        F.when(F.array_contains("todo", r.key), _spans(F.col("text"), r)).otherwise(
            F.array().cast(f"array<{_SPAN}>")
        )
        for r in rules
    ]
    todo.select("blob", F.col("todo").alias("scanned"), F.concat(*spans).alias("findings")).write.mode(
        "append"
    ).parquet(ledger)


def scan_secrets(
    docs: DataFrame, ledger: str, rules: tuple[SecretRule, ...] = RULES
) -> DataFrame:
    """Every row, without its text, with ``blob`` and ``findings``: kind, start and end.

    Findings are ordered by start, then by the order of the rules; positions are code
    points with the end exclusive. The ledger under ``ledger`` grows by what is new in
    ``docs`` and is joined back to every row whose text is a blob with findings. NULL texts
    count as empty; an empty table gives an empty result. Input columns named ``blob`` or
    ``findings`` are replaced.
    """
    rows = without(docs, "blob", "findings")
    scan_unseen(rows.select("text"), ledger, rules)
    order = F.create_map(*[x for k, r in enumerate(rules) for x in (F.lit(r.key), F.lit(k))])
    kinds = F.create_map(*[x for r in rules for x in (F.lit(r.key), F.lit(r.kind))])
    placed = F.transform(
        F.filter("findings", lambda f: F.array_contains(F.array(*[F.lit(r.key) for r in rules]), f["rule"])),
        lambda f: F.struct(
            f["at"].alias("start"),
            F.try_element_at(order, f["rule"]).alias("order"),
            f["until"].alias("end"),
            F.try_element_at(kinds, f["rule"]).alias("kind"),
        ),
    )
    found = (
        read_ledger(docs.sparkSession, ledger)
        .where(F.size("findings") > 0)
        .select("blob", F.sort_array(placed).alias("findings"))
    )
    paths = rows.withColumn("blob", F.sha2(whole("text"), 256)).drop("text")
    return paths.join(found, "blob", "left").select(
        *[F.col(f"`{c}`") for c in paths.columns],
        F.coalesce(
            "findings",
            F.array().cast("array<struct<start: int, order: int, end: int, kind: string>>"),
        ).alias("findings"),
    )


def count_kind(kind: str) -> Column:
    return F.size(F.filter("findings", lambda f: f["kind"] == kind)).cast("bigint")


def span_list(kinds: tuple[str, ...] | None = None) -> Column:
    """``kind:start:end`` of the findings, of some kinds or all, joined by commas."""
    chosen = F.col("findings")
    if kinds is not None:
        chosen = F.filter(chosen, lambda f: f["kind"].isin(*kinds))
    return F.array_join(F.transform(chosen, lambda f: F.concat_ws(":", f["kind"], f["start"], f["end"])), ",")
