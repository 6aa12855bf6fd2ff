"""Line dedup by a fixed-depth tree of line templates. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataflow.llm.common import WORD_PATTERN, Workspace, stage, whole, without, words

#: Different texts that a template has to occur in to count as recurring.
MIN_DOCUMENTS = 5
#: From so many tokens a line is a passage: it recurs, word for word, from so many texts.
LONG_TOKENS = 20
LONG_DOCUMENTS = 2
#: Leading tokens that choose the branch below the token count.
DEPTH = 3
#: A line may differ from its template in one field if that leaves this share of its tokens.
SIMILARITY = 0.8
FIELD = "<*>"


def _masked(token: Column) -> Column:
    return F.when(token.rlike("[0-9]"), F.lit(FIELD)).otherwise(token)


def _templates(similarity: float) -> Column:
    """Hashes of the line's templates: all tokens, then all but one window of them.

    The windows tile the line, each with as many tokens as ``similarity`` leaves free.
    """
    size, windows = F.size("hashes"), round(1 / (1 - similarity))
    loose = []
    for k in range(windows):
        low = F.floor(size * k / windows).cast("int")
        high = F.floor(size * (k + 1) / windows).cast("int")
        head, tail = F.slice("hashes", F.lit(1), low), F.slice("hashes", high + 1, size - high)
        loose.append(F.xxhash64("leaf", F.lit(k), head, tail))
    return F.when(size >= windows, F.array("exact", *loose)).otherwise(F.array("exact"))


def _lines(docs: DataFrame, depth: int) -> DataFrame:
    """Every line with a word: the key of its text, its place, its leaf and its tokens' hashes.

    Each step is a select of its own, so that Spark hashes a text below the explode, once
    and not for each line, and builds a line's tokens once.
    """
    text, tokens = whole("text"), F.col("tokens")
    texts = docs.select(
        "doc_id", F.xxhash64(text).alias("digest"), F.split(text, "\n").alias("lines")
    )
    placed = texts.select("doc_id", "digest", F.posexplode("lines").alias("pos", "line"))
    plain = placed.where(F.col("line").rlike(WORD_PATTERN)).select(
        "doc_id", "digest", "pos", words(F.col("line")).alias("plain"),
        F.col("line").rlike("[0-9]").alias("masks"),
    )
    parsed = plain.select(
        "doc_id", "digest", "pos",
        F.when(F.col("masks"), F.transform("plain", _masked)).otherwise(F.col("plain")).alias("tokens"),
        F.when(F.size("plain") >= LONG_TOKENS, F.xxhash64("plain")).alias("passage"),
    )
    return parsed.select(
        "doc_id", "digest", "pos", "passage",
        F.xxhash64(F.size(tokens), F.slice(tokens, 1, depth)).alias("leaf"),
        F.xxhash64(tokens).alias("exact"),
        F.transform(tokens, lambda token: F.hash(token)).alias("hashes"),
    )


def _with_fields(work: Workspace, lines: DataFrame, similarity: float) -> DataFrame:
    """The lines with a template in which their rarest tokens are variable fields.

    A token is as rare as its leaf has it at its position, counted over different texts'
    lines. As many of a line become fields as ``similarity`` leaves free, wherever they
    are; ties go to the earlier position.
    """
    once = lines.where(F.size("hashes") >= round(1 / (1 - similarity))).select(
        "leaf", "digest", "hashes"
    ).distinct()
    counts = work.stage(
        once.select("leaf", F.posexplode("hashes").alias("at", "hash"))
        .groupBy("leaf", "at", "hash")
        .agg(F.count(F.lit(1)).alias("many"))
    )
    kinds = work.stage(once.select("leaf", "hashes").distinct())
    free = F.floor(F.size("by_rarity") * F.lit(1 - similarity) + F.lit(1e-9)).cast("int")
    rest = F.slice("by_rarity", free + 1, F.size("by_rarity") - free)
    masked = (
        kinds.withColumn("kind", F.xxhash64("leaf", "hashes"))
        .select("kind", "leaf", F.posexplode("hashes").alias("at", "hash"))
        .join(counts, ["leaf", "at", "hash"])
        .groupBy("kind", "leaf")
        .agg(F.array_sort(F.collect_list(F.struct("many", "at", "hash"))).alias("by_rarity"))
        .withColumn("kept", F.array_sort(F.transform(rest, lambda token: F.struct(token["at"], token["hash"]))))
        .select("kind", F.xxhash64("leaf", F.lit(-3), "kept").alias("template"))
    )
    masked = work.stage(masked)
    return lines.select(
        "doc_id", "digest", "pos", F.xxhash64("leaf", "hashes").alias("kind")
    ).join(masked, "kind").drop("kind")


def _recurring(found: DataFrame, key: str, min_documents: int) -> DataFrame:
    """Keys that occur in enough different texts, with the first document that has each.

    Copies of a text have one digest and count once. Both groupings combine before the
    shuffle, so the rows of a line that is in every document are spread by their texts.
    """
    in_texts = found.groupBy(key, "digest").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id")).alias("id")
    )
    return (
        in_texts.groupBy(key)
        .agg(
            F.count(F.lit(1)).alias("texts"),
            F.min(F.struct("id.none", "id.doc_id", "digest")).alias("first"),
        )
        .where(F.col("texts") >= min_documents)
    )


def _after_first(work: Workspace, lines: DataFrame, min_documents: int) -> DataFrame:
    """The lines of recurring templates outside the first document of each."""
    recurring = work.stage(_recurring(lines, "template", min_documents).select("template", "first"))
    is_first = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (
        F.col("digest") == F.col("first.digest")
    )
    return lines.join(recurring, "template").where(~is_first).select("doc_id", "digest", "pos")


def _repeats(
    docs: DataFrame, min_documents: int | None, depth: int, similarity: float
) -> DataFrame:
    """For each text with lines to drop, their places: all that stays of the staged tables."""
    least = MIN_DOCUMENTS if min_documents is None else min_documents
    with Workspace(docs.sparkSession, "lines") as work:
        found = work.stage(_lines(docs, depth))
        # A template lies in one leaf, so only leaves of enough texts can hold a recurring one.
        # Both lists of keys are written out: a join with them as they come would be bound to
        # their partitioning, and Spark could not split a hot line.
        crowded = work.stage(_recurring(found, "leaf", least).select("leaf"))
        inside = work.stage(
            found.drop("passage").join(crowded, "leaf").withColumn("templates", _templates(similarity))
        )
        lines = inside.select("doc_id", "digest", "pos", F.explode("templates").alias("template"))
        lines = lines.unionByName(_with_fields(work, inside, similarity))
        dropped = _after_first(work, lines, least)
        if min_documents is None:
            passages = found.where(F.col("passage").isNotNull()).select(
                "doc_id", "digest", "pos", F.col("passage").alias("template")
            )
            dropped = dropped.unionByName(_after_first(work, passages, LONG_DOCUMENTS))
        places = dropped.groupBy("doc_id", "digest").agg(F.collect_set("pos").alias("places"))
        return stage(places, "line-places")


def drop_recurring_lines(
    docs: DataFrame,
    min_documents: int | None = None,
    depth: int = DEPTH,
    similarity: float = SIMILARITY,
) -> DataFrame:
    """Every row with recurring lines cut from ``text``, and ``n_lines`` and ``n_dropped``.

    Lines go down a tree of fixed depth: by the number of tokens, then by the leading
    ``depth`` tokens, where a token with a digit is a variable field. Lines of a leaf that
    agree in all tokens share a template; so do longer lines that agree outside one
    window of tokens, which is then a variable field, where the windows tile the line and
    leave ``similarity`` of it; and so do those that agree outside their rarest tokens,
    as many as that leaves, which may be several fields anywhere. A template in at least MIN_DOCUMENTS different texts
    recurs, and so does a passage, a line of LONG_TOKENS or more, whose words are the same
    in LONG_DOCUMENTS; ``min_documents``, if given, holds for lines of any length instead.
    Such lines are dropped everywhere but in the first document (smallest doc_id,
    NULL last) that has the template. A text of which no
    word would remain repeats others rather than hosts boilerplate; it is left whole, for
    the near-dedup of documents to judge.

    Lines end at a line feed; those without a word stay. A NULL text stays NULL with no
    line, an empty text has one. Rows that repeat a doc_id and its text are treated
    alike. ``n_chars``, where present, is counted anew for changed texts. Other columns
    pass through; input columns named ``n_lines`` or ``n_dropped`` are replaced.
    """
    places = _repeats(docs.select("doc_id", "text"), min_documents, depth, similarity)
    kept_rows = without(docs, "n_lines", "n_dropped")
    # Within a struct the input's columns cannot clash with those of the plan.
    rows = kept_rows.select(
        F.struct("*").alias("doc"),
        F.col("doc_id").alias("id"),
        F.xxhash64(whole("text")).alias("text_digest"),
    )
    joined = rows.join(
        places,
        F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("text_digest") == F.col("digest")),
        "left",
    )
    text, found = F.col("doc.text"), F.col("lines")
    # Looking up each line among the places would take lines times places.
    stay = F.array_except(F.sequence(F.lit(0), F.size(found) - 1), "places")
    rest = F.transform(stay, lambda at: F.get(found, at))
    cut = joined.withColumn("lines", F.split(text, "\n")).withColumn(
        "cut", F.when(F.col("places").isNotNull(), F.array_join(rest, "\n"))
    ).withColumn(
        "hosts",
        F.coalesce(F.col("cut").rlike(WORD_PATTERN), F.lit(False)),
    )
    changed = {"text": F.when(F.col("hosts"), F.col("cut")).otherwise(text)}
    if "n_chars" in kept_rows.columns:
        changed["n_chars"] = F.when(F.col("hosts"), F.length("cut").cast("bigint")).otherwise(
            F.col("doc.n_chars").cast("bigint")
        )
    return cut.select(
        *[changed.get(c, F.col("doc").getField(c)).alias(c) for c in kept_rows.columns],
        F.coalesce(F.size(found), F.lit(0)).alias("n_lines"),
        F.when(F.col("hosts"), F.size("places")).otherwise(F.lit(0)).alias("n_dropped"),
    )
