"""JDBC tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class JdbcTarget:
    """Connection of one table. Credentials are arguments, never constants."""

    url: str
    driver: str
    table: str
    user: str | None = None
    password: str | None = None

    def options(self) -> dict[str, str]:
        found = {
            "url": self.url,
            "driver": self.driver,
            "dbtable": self.table,
            "user": self.user,
            "password": self.password,
        }
        return {name: value for name, value in found.items() if value is not None}


@dataclass(frozen=True)
class JdbcSplit:
    """Ranges of a numeric or time column, each read by its own connection."""

    column: str
    lower: str
    upper: str
    partitions: int

    def options(self) -> dict[str, str]:
        return {
            "partitionColumn": self.column,
            "lowerBound": self.lower,
            "upperBound": self.upper,
            "numPartitions": str(self.partitions),
        }


def text_ranges(column: str, bounds: Sequence[str]) -> list[str]:
    """Predicates that part a table at the given values of a text column, NULL included."""
    if list(bounds) != sorted(set(bounds)) or not bounds:
        raise ValueError("bounds must be different values in ascending order, one at least")
    quoted = ["'" + b.replace("'", "''") + "'" for b in bounds]
    between = [
        f"{column} >= {low} AND {column} < {high}"
        for low, high in zip(quoted[:-1], quoted[1:], strict=True)
    ]
    return [
        f"{column} < {quoted[0]} OR {column} IS NULL", *between, f"{column} >= {quoted[-1]}"
    ]


def jdbc_read_options(
    target: JdbcTarget,
    split: JdbcSplit | None = None,
    single_connection: bool = False,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    """Options of a scan by ranges, or of a small table through one connection."""
    if (split is None) != single_connection:
        raise ValueError("give a split, or single_connection=True for a small table")
    options = {**target.options(), "fetchsize": str(fetch_size)}
    return {**options, **split.options()} if split else options


def scan_jdbc(
    spark: SparkSession,
    target: JdbcTarget,
    split: JdbcSplit | Sequence[str] | None = None,
    single_connection: bool = False,
    fetch_size: int = 10_000,
) -> DataFrame:
    """JDBC table, read by ranges of a column or by predicates that part it.

    The bounds of a ``JdbcSplit`` only place the splits, no row is left out. Predicates,
    such as those of ``text_ranges``, have to cover the table and not overlap. A whole
    table through one task has to be asked for.
    """
    if split is None or isinstance(split, JdbcSplit):
        options = jdbc_read_options(target, split, single_connection, fetch_size)
        return spark.read.format("jdbc").options(**options).load()
    if single_connection or isinstance(split, str) or not split:
        raise ValueError("predicates are a list of conditions and need no single connection")
    rest = target.options()
    url, name = rest.pop("url"), rest.pop("dbtable")
    return spark.read.jdbc(
        url, name, predicates=list(split), properties={**rest, "fetchsize": str(fetch_size)}
    )
