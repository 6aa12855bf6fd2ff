"""What several operators of this subpackage share."""

from __future__ import annotations

from types import TracebackType

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow.session import scratch_path, scratch_root
from strataflow.sinks.snapshots import remove_path

# White space between words is a space or U+0009 to U+000D.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
_OTHER_SPACE = "\t\n\x0b\x0c\r"
#: Bits of a key filter: 1 MB, an eighth of them set by a million keys.
FILTER_BITS = 1 << 23


def whole(text: str | Column) -> Column:
    """The text, empty where it is NULL."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def words(text: Column) -> Column:
    """The words of a text in order, without empty ones."""
    spaced = F.translate(text, _OTHER_SPACE, " " * len(_OTHER_SPACE))
    return F.array_remove(F.split(spaced, " "), "")


def word_count(text: Column) -> Column:
    """Number of words, counted without building them."""
    return F.regexp_count(text, F.lit(WORD_PATTERN)).cast("bigint")


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write the rows to the shared scratch folder and read them back.

    The copy outlives a lost executor and is computed once however often it is read.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Workspace:
    """Staged tables that are deleted when the work is done, or earlier, one by one.

    What a result still reads when it is handed out has to be staged elsewhere.
    """

    def __init__(self, spark: SparkSession, label: str) -> None:
        self._spark = spark
        self._root = scratch_path(spark, label)
        self._many = 0
        self._tables: list[tuple[DataFrame, str]] = []

    def __enter__(self) -> Workspace:
        return self

    def __exit__(
        self,
        kind: type[BaseException] | None,
        error: BaseException | None,
        trace: TracebackType | None,
    ) -> None:
        remove_path(self._spark, self._root)

    def stage(self, df: DataFrame) -> DataFrame:
        """The rows, written and read back."""
        self._many += 1
        path = f"{self._root}/{self._many}"
        df.write.parquet(path)
        table = self._spark.read.schema(df.schema).parquet(path)
        self._tables.append((table, path))
        return table

    def drop(self, table: DataFrame) -> None:
        """Delete a table of this work that nothing reads any more."""
        remove_path(self._spark, next(path for t, path in self._tables if t is table))


def _slot(key: str) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(FILTER_BITS))


def key_filter(keys: DataFrame, key: str) -> DataFrame:
    """One row with ``words``: FILTER_BITS bits, of which those of the keys' hashes are set.

    Its size is the same for any number of keys, so it can be broadcast. ``may_have``
    looks a key up: a row whose bit is not set has none of the keys, one whose bit is set
    may have. What is left for an exact join is small as long as the keys are few.
    """
    slot = _slot(key)
    bits = keys.select(
        F.shiftright(slot, 6).alias("word"), F.expr("1L").alias("one"), (slot % 64).cast("int").alias("at")
    ).select("word", F.expr("shiftleft(one, at)").alias("bits"))
    every = keys.sparkSession.range(FILTER_BITS // 64).select(F.col("id").alias("word"), F.lit(0).cast("long").alias("bits"))
    words = bits.unionByName(every).groupBy("word").agg(F.bit_or("bits").alias("bits"))
    # One row for the whole filter, in order of the words.
    return words.agg(F.array_sort(F.collect_list(F.struct("word", "bits"))).alias("words")).select(
        F.transform("words", lambda w: w["bits"]).alias("words")
    )


def may_have(rows: DataFrame, key: str, found: DataFrame, have: bool = True) -> DataFrame:
    """Rows that may have one of the keys of a ``key_filter``; else those that have none.

    Nothing is shuffled.
    """
    slot = _slot(key)
    word = F.get("words", F.shiftright(slot, 6).cast("int"))
    # Of the bits from the key's on, the first one.
    is_set = F.pmod(F.call_function("shiftrightunsigned", word, (slot % 64).cast("int")), F.lit(2)) == 1
    return rows.join(F.broadcast(found), is_set, "left_semi" if have else "left_anti")


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage of a loop with a reliable checkpoint in the shared folder."""
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(scratch_root(df.sparkSession))
    return df.checkpoint()


def without(df: DataFrame, *names: str) -> DataFrame:
    """Drop columns of the input that would clash with result columns."""
    clashing = {n.lower() for n in names}
    return df.drop(*[c for c in df.columns if c.lower() in clashing])
