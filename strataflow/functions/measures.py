"""Dirty text to numbers, never failing on a bad value."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

KINDS = ("double", "float", "int")


def to_measure(
    raw: Column, kind: str = "double", decimal_comma: bool = False, reject_nan: bool = False
) -> Column:
    """Number held by ``raw``, NULL where there is none.

    ``int`` truncates through double, so ``75.5`` gives 75. The text ``nan`` is a
    NaN, which passes a not-null test and turns its group's average into NaN;
    ``reject_nan`` makes it NULL. ``float`` loses precision before averaging.
    """
    if kind not in KINDS:
        raise ValueError(f"kind must be one of {KINDS}, got {kind!r}")
    text = raw.cast("string")
    if decimal_comma:
        text = F.replace(text, F.lit(","), F.lit("."))
    number = text.try_cast("float" if kind == "float" else "double")
    if kind == "int":
        return number.try_cast("int")
    if reject_nan:
        return F.when(~F.isnan(number), number)
    return number
