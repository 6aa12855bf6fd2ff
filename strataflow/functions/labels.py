"""Replacement of missing category labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
MISSING_LABEL = "No medal"
MISSING_WORDS = ("nan", "none", "null", "")


def fill_label(
    category: Column, label: str = MISSING_LABEL, sentinels: Sequence[str] = ()
) -> Column:
    """``label`` where the category is missing, else the category as it is.

    Without ``sentinels`` only NULL and the empty text are missing. With them, the
    lower-cased and trimmed category is also looked up among them.
    """
    if sentinels:
        absent = F.lower(F.trim(category.cast("string"))).isin(*sentinels)
    else:
        absent = category == ""
    return F.when(category.isNull() | absent, F.lit(label)).otherwise(category)
