"""Text cleaning expressions."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# The characters a cleaned text may keep.
KEPT_ALWAYS = r"a-zA-Z0-9,.\"'"
KEPT_BACKSLASH = r"\\"
KEPT_SPACE = " "
NULL_WORD = "None"

NULL_POLICIES = ("keep", "literal", "empty_to_null")


def kept_class(keep_space: bool = False, keep_backslash: bool = True) -> str:
    """The kept characters as the inside of a regex class."""
    kept = KEPT_ALWAYS
    if keep_backslash:
        kept += KEPT_BACKSLASH
    if keep_space:
        kept += KEPT_SPACE
    return kept


def check_null_policy(null_policy: str) -> None:
    if null_policy not in NULL_POLICIES:
        raise ValueError(f"null_policy must be one of {NULL_POLICIES}, got {null_policy!r}")


def clean_text_column(
    text: Column,
    keep_space: bool = False,
    keep_backslash: bool = True,
    trim: bool = False,
    null_policy: str = "keep",
) -> Column:
    """Delete every character outside the kept class.

    ``null_policy``: ``keep`` leaves NULL alone, ``literal`` turns it into the word
    ``None``, ``empty_to_null`` also maps an empty input to NULL. An input that
    only becomes empty by cleaning stays an empty text.
    """
    check_null_policy(null_policy)
    source = F.coalesce(text, F.lit(NULL_WORD)) if null_policy == "literal" else text
    if not keep_space:
        # Most deletions are spaces, and a plain search finds those far faster.
        source = F.replace(source, F.lit(" "), F.lit(""))
    # Each match takes a whole kept run and what follows it, up to the end of the
    # text, which halves the time of searching for the deleted characters alone.
    kept = kept_class(keep_space, keep_backslash)
    cleaned = F.regexp_replace(source, rf"([{kept}]*)(?:[^{kept}]+|\z)", "$1")
    if trim:
        cleaned = F.trim(cleaned)
    if null_policy == "empty_to_null":
        cleaned = F.when(text != "", cleaned)
    return cleaned


def normalise_text_column(text: Column) -> Column:
    """Lower case without surrounding spaces."""
    return F.trim(F.lower(text))


def clean_text_arrow(
    keep_space: bool = False,
    keep_backslash: bool = True,
    null_policy: str = "keep",
) -> Callable[[Column], Column]:
    """The cleaning rule as an Arrow UDF, for callers that must stay in Python.

    Prefer ``clean_text_column``: a UDF is opaque to Catalyst and leaves codegen.
    """
    check_null_policy(null_policy)
    pattern = f"[^{kept_class(keep_space, keep_backslash)}]+"
    null_word = NULL_WORD

    # Nested, so that it reaches the executors by value without the package.
    def clean(texts: pa.Array) -> pa.Array:
        if null_policy == "literal":
            texts = pc.fill_null(texts, null_word)
        cleaned = pc.replace_substring_regex(texts, pattern=pattern, replacement="")
        if null_policy == "empty_to_null":
            cleaned = pc.if_else(pc.equal(texts, ""), None, cleaned)
        return cleaned

    clean.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    return F.arrow_udf(clean, StringType())
