"""Dimension lookups: code names in several roles, hierarchies, region levels."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def lookup(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, take: Mapping[str, str],
           how: str = "left") -> DataFrame:
    """Add dimension columns (``take``: output -> dim column). No hint: the optimizer broadcasts a dim only after
    checking its size, and splits skewed partitions of the fact when the dim is too large for that."""
    side = dim.select(F.col(dim_key).alias("_dk"), *[F.col(c).alias(o) for o, c in take.items()])
    return fact.join(side, F.col(fact_key) == F.col("_dk"), how).drop("_dk")


def codes_to_names(df: DataFrame, dic: DataFrame, roles: Mapping[str, tuple[str, str | None]],
                   how: str = "left", default: str | None = None, code: str = "dic_code",
                   name: str = "dic_name") -> DataFrame:
    """The same dictionary under several roles.

    ``roles`` maps a code column -> (output name column, parent code or None for the whole dictionary).
    """
    for col, (out, parent) in roles.items():
        entries = dic if parent is None else dic.where(F.col("parent_code") == parent)
        df = lookup(df, entries, col, code, {out: name}, how)
        if default is not None:
            df = df.withColumn(out, F.coalesce(out, F.lit(default)))
    return df


def chain(df: DataFrame, steps: Sequence[tuple[DataFrame, str, str, Mapping[str, str]]]) -> DataFrame:
    """Snowflake of left joins: each step is (dim, key column so far, dim key, columns to take)."""
    for dim, key, dim_key, take in steps:
        df = lookup(df, dim, key, dim_key, take)
    return df


def by_level(level: Column, first: str, second: str) -> Column:
    """Level-1 organisations sit one step higher in the region tree than level-2 ones."""
    return F.when(level == 1, F.col(first)).otherwise(F.col(second))


def region_parents(df: DataFrame, region: DataFrame, key: str, levels: int) -> DataFrame:
    """Walk up the region tree from ``key``: adds ``r0_id, r0_name, r0_parent``, ``r1_...`` per level."""
    for i in range(levels):
        df = lookup(df, region, key, "id", {f"r{i}_id": "id", f"r{i}_name": "name", f"r{i}_parent": "parent_id"})
        key = f"r{i}_parent"
    return df
