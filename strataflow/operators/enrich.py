"""Fact and dimension joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame

SIDES = ("fact", "dim")


def drop_shared(
    fact: DataFrame, dim: DataFrame, key: str, shared_from: str = "fact"
) -> tuple[DataFrame, DataFrame]:
    """Both sides with each column that both have left only on ``shared_from``."""
    if shared_from not in SIDES:
        raise ValueError(f"shared_from must be one of {SIDES}, got {shared_from!r}")
    shared = [c for c in fact.columns if c in dim.columns and c != key]
    return (fact, dim.drop(*shared)) if shared_from == "fact" else (fact.drop(*shared), dim)


def enrich(fact: DataFrame, dim: DataFrame, key: str, shared_from: str = "fact") -> DataFrame:
    """Inner join on a shared key, which appears once in the result.

    No hint: Spark broadcasts a dimension below its size threshold and otherwise
    sorts and merges, where adaptive execution splits a fact key that is skewed.
    """
    fact, dim = drop_shared(fact, dim, key, shared_from)
    return fact.join(dim, key, "inner")


def enrich_on(
    fact: DataFrame,
    dim: DataFrame,
    condition: Column,
    columns: Sequence[str | Column],
    fact_alias: str = "f",
    dim_alias: str = "d",
) -> DataFrame:
    """Inner join by an equality over aliased sides, projected to ``columns``."""
    joined = fact.alias(fact_alias).join(dim.alias(dim_alias), condition, "inner")
    return joined.select(*columns)
