"""Multi-horizon roll-ups: the same measures over the last 1, 7 and 30 days from one scan."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.functions.dates import horizon_start


def in_last(df: DataFrame, date_col: str, d: str, n: int) -> DataFrame:
    """Rows of the n days ending at d; a plain range on the partition column, so files are pruned."""
    return df.where(F.col(date_col).between(horizon_start(d, n), d))


def explode_horizons(df: DataFrame, date_col: str, d: str, horizons: Sequence[int]) -> DataFrame:
    """One copy of a row per horizon that covers it (``recent_days``), after pruning to the widest."""
    covered = [F.when(F.col(date_col) >= horizon_start(d, n), F.lit(n)) for n in sorted(horizons)]
    days = F.filter(F.array(*covered), lambda n: n.isNotNull())
    return in_last(df, date_col, d, max(horizons)).withColumn("recent_days", F.explode(days))


def multi_horizon(df: DataFrame, date_col: str, d: str, horizons: Sequence[int], keys: Sequence[str],
                  aggs: Sequence[Column]) -> DataFrame:
    """Grouped aggregates per horizon. For additive measures sum per day first: the copies then are day rows."""
    return explode_horizons(df, date_col, d, horizons).groupBy("recent_days", *keys).agg(*aggs)


_MERGE = {"sum": F.sum, "count": F.sum, "min": F.min, "max": F.max}


def horizon_rollup(df: DataFrame, date_col: str, d: str, horizons: Sequence[int], keys: Sequence[str],
                   aggs: Mapping[str, tuple[str, str]]) -> DataFrame:
    """C1 for measures that can be merged; ``aggs`` maps output -> (sum | count | min | max, input column).

    Aggregates once per (keys, age class) -- on the map side -- and copies only those few rows per horizon, so no
    fact row is ever duplicated and one shuffle serves all horizons.
    """
    bounds = sorted(horizons)
    age = F.coalesce(*[F.when(F.col(date_col) >= horizon_start(d, n), F.lit(n)) for n in bounds])
    first = {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max}
    base = (in_last(df, date_col, d, bounds[-1]).withColumn("_age", age)
            .groupBy(*keys, "_age").agg(*[first[kind](c).alias(o) for o, (kind, c) in aggs.items()]))
    covers = F.filter(F.array(*[F.lit(n) for n in bounds]), lambda n: n >= F.col("_age"))
    return (base.withColumn("recent_days", F.explode(covers)).groupBy("recent_days", *keys)
            .agg(*[_MERGE[kind](o).alias(o) for o, (kind, _) in aggs.items()]))


def horizon_sums(df: DataFrame, date_col: str, d: str, horizons: Sequence[int], keys: Sequence[str],
                 sums: Mapping[str, str]) -> DataFrame:
    """Additive form: ``sums`` maps output name -> input column."""
    return horizon_rollup(df, date_col, d, horizons, keys, {o: ("sum", c) for o, c in sums.items()})


def horizon_wide(df: DataFrame, date_col: str, d: str, horizons: Sequence[int], keys: Sequence[str],
                 measures: Mapping[str, str]) -> DataFrame:
    """One row per key with a column per measure and horizon, e.g. ``order_count_7d``.

    ``measures`` maps the output stem -> daily column.
    """
    top = max(horizons)
    aggs = []
    for n in horizons:
        inside = F.col(date_col) >= horizon_start(d, n)
        for stem, col in measures.items():
            picked = F.col(col) if n == top else F.when(inside, F.col(col)).otherwise(F.lit(0))
            aggs.append(F.sum(picked).alias(f"{stem}_{n}d"))
    return in_last(df, date_col, d, top).groupBy(*keys).agg(*aggs)


def unfold_horizons(df: DataFrame, keys: Sequence[str], horizons: Sequence[int], stems: Mapping[str, str]) -> DataFrame:
    """Wide -> tall: ``x_7d, x_30d`` become rows with ``recent_days`` (P12). ``stems`` maps output -> stem."""
    rows = F.explode(F.array(*[
        F.struct(F.lit(n).alias("recent_days"), *[F.col(f"{stem}_{n}d").alias(o) for o, stem in stems.items()])
        for n in horizons]))
    return df.select(*keys, rows.alias("_r")).select("_r.recent_days", *keys, *[f"_r.{o}" for o in stems])


def horizon_distinct(df: DataFrame, date_col: str, d: str, horizons: Sequence[int], keys: Sequence[str], ident: str,
                     counts: Mapping[str, Column | None]) -> DataFrame:
    """Distinct ids per key and horizon; ``counts`` maps output -> condition (None: every row).

    One row per (keys, id) remembers the last qualifying day, which answers every horizon at once: no row is copied
    per horizon and no per-group id set is ever built, so a hot key spreads over its ids.
    """
    last = [F.max(F.col(date_col) if cond is None else F.when(cond, F.col(date_col))).alias(f"_{o}")
            for o, cond in counts.items()]
    seen = in_last(df, date_col, d, max(horizons)).where(F.col(ident).isNotNull()).groupBy(*keys, ident).agg(*last)
    per_horizon = [F.count(F.when(F.col(f"_{o}") >= horizon_start(d, n), F.lit(1))).alias(f"{o}_{n}d")
                   for n in horizons for o in counts]
    return unfold_horizons(seen.groupBy(*keys).agg(*per_horizon), list(keys), horizons, {o: o for o in counts})
