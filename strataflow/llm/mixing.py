"""Mixing sources to target weights by weighted sampling. DataFrame functions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataflow.llm.common import stage, whole, without, word_count

#: Weights dealt to the sources in code point order, NULL last, again and again.
WEIGHTS = (5.0, 2.0, 1.0)
#: A source is repeated at most this often.
MOST_EPOCHS = 3.0
#: Rows that one task sorts together, about.
BUCKET_ROWS = 1_000
_NOISE = "[#*$%&|<>{}=_~^\\\\]"


def text_quality(text: str = "text") -> Column:
    """Quality weight from 0.25 to 1: less where symbols crowd out ordinary characters."""
    noisy = F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(_NOISE))
    share = noisy / F.greatest(F.length(F.coalesce(F.col(text), F.lit(""))), F.lit(1))
    return F.greatest(F.lit(0.25), F.lit(1.0) - share * 4)


def _source_targets(sizes: DataFrame, weights: Sequence[float], most: float) -> DataFrame:
    """``target`` of each source: its share of all words, at most ``most`` times its own.

    What a capped source cannot take is shared again by weight among the others, until
    none is above its cap. Each round is one grouping over the sources; two sums
    reach the driver. With every source capped the rest of the budget stays unused.
    """
    ranked = Window.orderBy(F.col("source").asc_nulls_last())
    place = (F.row_number().over(ranked) - 1) % len(weights)
    dealt = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place + 1).cast("int"))
    known = stage(
        sizes.select("source", "source_size", dealt.alias("weight")), "mixing-sources"
    ).withColumn("cap", F.col("source_size") * F.lit(float(most)))
    total = known.agg(F.sum("source_size")).first()[0] or 0
    rate, capped_before = 0.0, -1
    while True:
        # Once capped, a source stays so: the rate only grows.
        is_capped = (F.col("weight") * F.lit(rate) > F.col("cap")) | (F.col("cap") == 0)
        row = known.agg(
            F.count_if(is_capped).alias("n"),
            F.sum(F.when(is_capped, F.col("cap")).otherwise(0.0)).alias("spent"),
            F.sum(F.when(is_capped, 0.0).otherwise(F.col("weight"))).alias("open"),
        ).first()
        if row.n == capped_before or not row.open:
            break
        capped_before = row.n
        rate = (total - row.spent) / row.open
    target = F.when(is_capped, F.col("cap")).otherwise(F.col("weight") * F.lit(rate))
    return known.select("source", "source_size", target.alias("target"))


def mix_sources(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    most_epochs: float = MOST_EPOCHS,
    quality: Column | None = None,
    seed: str = "mix",
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """Every row without its text, with ``size``, ``source_size``, ``target`` and ``taken``.

    A size is a number of words. The sources share all words by their weights, each up
    to ``most_epochs`` times its own (see ``_source_targets``). A source whose target is
    several times its size takes every document that often, and of the next epoch a
    sample: document i gets the key ``-ln(u) / quality`` with u uniform by its hash, and
    in order of their keys (Efraimidis and Spirakis, 2006) documents are taken whole while
    their prefix sum is nearer to the target with them than without. ``taken`` is the
    number of words taken, repeats counted.

    Prefix sums are built in two steps: keys fall into buckets of about
    ``bucket_rows`` rows, the buckets' sums are added up, and rows are sorted within
    their bucket only. A source with a third of all rows is thus many buckets.
    Keys depend on doc_id and text only, so reruns agree; rows that repeat both have equal
    keys and are taken in turn. NULL sources are one source, NULL texts have size 0, and
    a document of size 0 takes 0 words. A quality that is not positive counts as 0.001.
    An empty table gives an empty result.
    """
    worth = F.greatest(
        F.coalesce((text_quality() if quality is None else quality).cast("double"), F.lit(1.0)),
        F.lit(0.001),
    )
    # 52 bits of a digest, moved off zero: uniform in (0, 1).
    digest = F.md5(
        F.concat_ws("|", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")),
                    whole("text"))
    )
    draw = (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / F.lit(2.0**52)
    rows = stage(
        without(docs, "size", "source_size", "target", "taken", "copies")
        .withColumn("size", word_count(whole("text")))
        .withColumn("_key", -F.log(draw) / worth)
        .drop("text"),
        "mixing",
    )
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = _source_targets(sizes, weights, most_epochs)
    buckets = rows.agg(F.ceil(F.count(F.lit(1)) / F.lit(bucket_rows))).first()[0] or 1
    # 1 - e^-key is uniform for quality 1 and keeps the order of the keys.
    bucket = F.least(
        F.floor((F.lit(1.0) - F.exp(-F.col("_key"))) * F.lit(float(buckets))), F.lit(buckets - 1)
    )
    keyed = rows.withColumn("_bucket", bucket.cast("bigint"))
    before = (
        Window.partitionBy("source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    )
    summed = (
        keyed.groupBy("source", "_bucket")
        .agg(F.sum("size").alias("_words"))
        .select("source", "_bucket", F.coalesce(F.sum("_words").over(before), F.lit(0)).alias("_from"))
    )
    plan = summed.join(targets, summed["source"].eqNullSafe(targets["source"])).select(
        summed["source"].alias("_source"), F.col("_bucket").alias("_of"), "_from", "source_size", "target"
    )
    within = (
        Window.partitionBy("source", "_bucket")
        .orderBy("_key", "doc_id", "size")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    placed = keyed.withColumn("_inside", F.coalesce(F.sum("size").over(within), F.lit(0))).join(
        plan,
        F.col("source").eqNullSafe(F.col("_source")) & (F.col("_bucket") == F.col("_of")),
    )
    size = F.col("size")
    epochs = F.floor(F.col("target") / F.greatest("source_size", F.lit(1)))
    left = F.col("target") - epochs * F.col("source_size")
    extra = (F.col("_from") + F.col("_inside") + size / 2 <= left) & (left > 0) & (size > 0)
    copies = (epochs + extra.cast("bigint")).cast("bigint")
    kept = [c for c in rows.columns if c not in ("_key", "size")]
    return placed.select(
        *[F.col(f"`{c}`") for c in kept],
        "size",
        "source_size",
        "target",
        (copies * size).alias("taken"),
        copies.alias("copies"),
    )


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each row as often as the mix takes it, with the input's columns.

    ``options`` are those of ``mix_sources``; a quality may use doc_id, text and source.
    """
    # Within a struct the input's columns cannot clash with those of the plan.
    rows = stage(
        docs.select(F.struct("*").alias("doc"), F.monotonically_increasing_id().alias("row")),
        "mixing-docs",
    )
    taken = mix_sources(rows.select("doc.doc_id", "doc.text", "doc.source", "row"), **options)
    return (
        rows.join(taken.where(F.col("copies") > 0).select("row", "copies"), "row")
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
        .select(*[F.col("doc").getField(c).alias(c) for c in docs.columns])
    )
