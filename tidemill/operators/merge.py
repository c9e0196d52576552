"""Combining report sides and appending reports without duplicates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def full_outer(sides: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Full outer join of any number of sides with one row per key each.

    Written as union + group: one shuffle for all sides, keys are merged (a key known to the second and third
    side only stays one row) and null keys meet each other.
    """
    names: list[str] = []
    for side in sides:
        names += [c for c in side.columns if c not in keys and c not in names]
    stacked = sides[0]
    for side in sides[1:]:
        stacked = stacked.unionByName(side, allowMissingColumns=True)
    return stacked.groupBy(*keys).agg(*[F.first(c, ignorenulls=True).alias(c) for c in names])


def one_row(parts: Mapping[str, DataFrame]) -> DataFrame:
    """Several one-value tables side by side as one row (J11): union and sum, no cross join.

    ``parts`` maps the output column -> a table with one numeric column and at most one row.
    """
    names = list(parts)
    stacked = None
    for name, part in parts.items():
        row = part.toDF(name)
        stacked = row if stacked is None else stacked.unionByName(row, allowMissingColumns=True)
    return stacked.agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names])


def signed_total(plus: DataFrame, minus: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """plus - minus per key through a union of negated measures."""
    negated = minus.select(*keys, *[(-F.col(m)).alias(m) for m in measures])
    both = plus.select(*keys, *measures).unionByName(negated)
    grouped = both.groupBy(*keys) if keys else both.groupBy()
    return grouped.agg(*[F.sum(m).alias(m) for m in measures])


def idempotent_append(target: DataFrame, new: DataFrame) -> DataFrame:
    """Target rows plus new rows without duplicates (C5); running it twice changes nothing."""
    return target.unionByName(new).distinct()


def unify(logs: Mapping[str, DataFrame], schema: Sequence[tuple[str, str]], tag: str = "data_type") -> DataFrame:
    """Stack differently shaped logs into one wide table; missing columns are typed nulls."""
    stacked = None
    for name, df in logs.items():
        have = set(df.columns)
        cols: list[Column] = [F.lit(name).alias(tag)]
        cols += [(F.col(c) if c in have else F.lit(None)).cast(t).alias(c) for c, t in schema]
        part = df.select(*cols)
        stacked = part if stacked is None else stacked.unionByName(part)
    return stacked


def share_between(df: DataFrame, people: Sequence[tuple[str, str]], halves: Sequence[str],
                  out: tuple[str, str]) -> DataFrame:
    """One row per person named on a row, the listed measures split evenly between them.

    ``people`` lists (id column, name column); a missing second person leaves the first with everything.
    Duplicate looking rows are kept: two equal trips are two trips.
    """
    crew = F.filter(F.array(*[F.struct(F.col(i).alias("id"), F.col(n).alias("name")) for i, n in people]),
                    lambda p: p["id"].isNotNull())
    rest = [c for c in df.columns if c not in {x for pair in people for x in pair} | set(halves)]
    parts = df.withColumn("_crew", crew).withColumn("_n", F.size("_crew")).withColumn("_p", F.explode("_crew"))
    return parts.select(F.col("_p.id").alias(out[0]), F.col("_p.name").alias(out[1]), *rest,
                        *[(F.col(h) / F.col("_n")).alias(h) for h in halves])
