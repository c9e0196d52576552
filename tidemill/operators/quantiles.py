"""Exact quantiles and quintile scores without collecting the values anywhere."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.operators.ordered import OrderedGroups


def quantile_edges(df: DataFrame, col: str, probs: Sequence[float]) -> DataFrame:
    """One row, one column ``q0..``: linearly interpolated quantiles of a column.

    Values are counted first (map-side combine), then numbered by the sliced cumulative count, so neither one
    task nor the driver ever holds the value list.
    """
    counted = df.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("v")).agg(F.count(F.lit(1)).alias("c"))
    upto = OrderedGroups(counted, [], [F.col("v")], F.col("v")).running_sum("c", "upto")
    n = df.agg(F.count(col).alias("n")).select("n").scalar()
    placed = upto.withColumn("n", n)
    picks = []
    for i, p in enumerate(probs):
        at = F.lit(p) * (F.col("n") - 1)
        for name, place in (("lo", F.floor(at)), ("hi", F.ceil(at))):
            inside = (F.col("upto") - F.col("c") <= place) & (place < F.col("upto"))
            picks.append(F.max(F.when(inside, F.col("v").cast("double"))).alias(f"{name}{i}"))
        picks.append(F.max(at - F.floor(at)).alias(f"w{i}"))
    row = placed.agg(*picks)
    return row.select(*[(F.col(f"lo{i}") + (F.col(f"hi{i}") - F.col(f"lo{i}")) * F.col(f"w{i}")).alias(f"q{i}")
                        for i in range(len(probs))])


def quintile(value: Column, edges: Column, descending: bool = False) -> Column:
    """Score 1..5 from a struct of edges q0..q3: bins are closed on the right, the lowest value is included."""
    score = F.lit(5)
    for i in (3, 2, 1, 0):
        score = F.when(value <= edges[f"q{i}"], F.lit(i + 1)).otherwise(score)
    return F.lit(6) - score if descending else score


def quintile_scores(df: DataFrame, scores: dict[str, tuple[str, bool]]) -> DataFrame:
    """Add quintile scores; ``scores`` maps output -> (value column, smaller is better)."""
    base = df
    for out, (col, descending) in scores.items():
        edges = quantile_edges(base, col, (0.2, 0.4, 0.6, 0.8))
        # the four edges of one column as one scalar struct
        df = df.withColumn("_e", edges.select(F.struct("q0", "q1", "q2", "q3").alias("e")).scalar())
        df = df.withColumn(out, quintile(F.col(col).cast("double"), F.col("_e"), descending)).drop("_e")
    return df
