"""Parity branch."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parity_power(number: Column) -> Column:
    """Square of an even number, cube of an odd one, in the number's own type.

    Products keep integers exact where ``pow`` would go through double. A product
    beyond the type raises under ANSI; cast to ``decimal(38,0)`` first for more room.
    """
    return F.when(number % 2 == 0, number * number).otherwise(number * number * number)
