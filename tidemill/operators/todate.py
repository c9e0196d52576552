"""Lifetime-to-date tables: full build and the daily merge that must equal it."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.functions.numbers import or_zero


def to_date_init(daily: DataFrame, key: str, date_col: str, first: str, last: str,
                 sums: Mapping[str, str]) -> DataFrame:
    """First date, last date and lifetime sums over every daily partition (C3). ``sums``: output -> daily column."""
    return daily.groupBy(key).agg(
        F.min(date_col).alias(first), F.max(date_col).alias(last),
        *[F.sum(c).alias(o) for o, c in sums.items()])


def to_date_merge(old: DataFrame, today: DataFrame, d: str, key: str, first: str, last: str,
                  sums: Mapping[str, str]) -> DataFrame:
    """Yesterday's table merged with one day (C4); both sides have one row per key, so the join cannot skew."""
    o, n = old.alias("o"), today.alias("n")
    seen_today = F.col(f"n.{key}").isNotNull()
    return o.join(n, F.col(f"o.{key}") == F.col(f"n.{key}"), "full_outer").select(
        F.coalesce(f"o.{key}", f"n.{key}").alias(key),
        F.coalesce(f"o.{first}", F.lit(d)).alias(first),
        F.when(seen_today, F.lit(d)).otherwise(F.col(f"o.{last}")).alias(last),
        *[(or_zero(F.col(f"o.{out}")) + or_zero(F.col(f"n.{c}"))).alias(out) for out, c in sums.items()])
