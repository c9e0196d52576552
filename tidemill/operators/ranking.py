"""Latest-per-key, top-N, full ranks and shares of a total."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.operators.ordered import OrderedGroups, falling, places


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the greatest ``order`` values per key.

    An aggregate, not a window: it combines on the map side, so a key with a third of all rows moves one row
    per map task.
    """
    rest = [c for c in df.columns if c not in keys]
    lead = [F.col(c) for c in order]
    best = F.max_by(F.struct(*rest), F.struct(*lead))
    return df.groupBy(*keys).agg(best.alias("_best")).select(*keys, *[F.col(f"_best.{c}") for c in rest]) \
             .select(*df.columns)


def top_n(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, out: str = "rn",
          ties: bool = False) -> DataFrame:
    """First n rows per group (W2), or rank <= n with ties.

    Spark prunes each map task to its own first n per group before the shuffle, so a hot group costs
    ``n * tasks`` rows.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    fn = F.rank() if ties else F.row_number()
    return df.withColumn(out, fn.over(w)).where(F.col(out) <= n)


def rank_all(df: DataFrame, keys: Sequence[str], value: str, out: str = "rk") -> DataFrame:
    """Rank of every row by ``value`` descending inside its group, ties equal."""
    return OrderedGroups(df, keys, [F.col(value).desc()], falling(F.col(value))).rank(out)


def number_all(df: DataFrame, keys: Sequence[str], value: str, ties_by: Sequence[str], out: str = "rn") -> DataFrame:
    """Unbroken 1..n numbering by ``value`` descending, ties settled by ``ties_by`` ascending."""
    order = [F.col(value).desc(), *[F.col(c).asc() for c in ties_by]]
    return OrderedGroups(df, keys, order, places(df, f"-{value}", *ties_by)).row_number(out)


def with_group_total(df: DataFrame, keys: Sequence[str], value: str, out: str) -> DataFrame:
    """Add the group's total of ``value`` (W8/J12) by aggregate and join: sums combine on the map side, and the
    join back is a size-checked broadcast or a skew-split sort-merge join, never one task per group."""
    totals = df.groupBy(*keys).agg(F.sum(value).alias(out))
    cond = None
    for k in keys:
        one = F.col(f"a.{k}").eqNullSafe(F.col(f"t.{k}"))
        cond = one if cond is None else cond & one
    return df.alias("a").join(totals.alias("t"), cond).select("a.*", f"t.{out}")


def with_grand_total(df: DataFrame, value: str, out: str) -> DataFrame:
    """Add the total of all rows (W9) as a scalar subquery: one number, no window over everything."""
    return df.withColumn(out, df.agg(F.sum(value).alias("t")).select("t").scalar())
