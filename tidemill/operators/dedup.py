"""Batch forms of the keyed-state operators; the streaming forms live in ``tidemill.streaming.state``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.functions.dates import as_ds, shift
from tidemill.operators.ordered import OrderedGroups, places
from tidemill.session import settled


def first_of_day(df: DataFrame, key: str, ts: str = "ts") -> DataFrame:
    """One row per (key, day): the time of the first event (X12). Aggregate with map-side combine."""
    return df.groupBy(key, as_ds(F.col(ts)).alias("ds")).agg(F.min(ts).alias(ts))


def unique_and_new(df: DataFrame, key: str, ts: str = "ts") -> DataFrame:
    """First event of each key's day, with ``is_new_user`` on the very first day."""
    daily = first_of_day(df, key, ts)
    firsts = df.groupBy(F.col(key).alias("_k")).agg(F.min(ts).alias("_first"))
    return (daily.join(firsts, F.col(key) == F.col("_k"))
            .withColumn("is_new_user", (F.col(ts) == F.col("_first")).cast("int")).drop("_k", "_first"))


def returning(df: DataFrame, key: str, ts: str = "ts", gap_days: int = 8) -> DataFrame:
    """First login of each day, flagged when the previous login day is ``gap_days`` or more ago."""
    daily = first_of_day(df, key, ts)
    # at most one row per key and day, so the window holds a key's calendar, not its events
    cut = F.unix_date(F.col("ds").cast("date"))
    stepped = OrderedGroups(daily, [key], [F.col("ds")], cut).step("ds", "previous_ds", back=True)
    gap = F.datediff(F.col("ds").cast("date"), F.col("previous_ds").cast("date"))
    return stepped.withColumn("is_back", F.coalesce((gap >= gap_days).cast("int"), F.lit(0)))


def repaired_new_flag(df: DataFrame, key: str, ts: str, flag: str) -> DataFrame:
    """Correct a lost or stale new-visitor flag.

    The remembered date of a key is the day of its first event, or the day before when that event already said
    "not new"; a later "new" on any other day becomes "0". One small aggregate per key decides.
    """
    first = F.min_by(F.struct(F.col(ts).alias("t"), F.col(flag).alias("f")), F.struct(ts, flag))
    memory = df.groupBy(F.col(key).alias("_k")).agg(first.alias("_m"))
    day = F.to_date(F.col("_m.t"))
    known = F.when(F.col("_m.f") == "1", day).otherwise(F.date_sub(day, 1))
    stale = (F.col(flag) == "1") & (F.to_date(F.col(ts)) != known)
    return (df.join(memory, F.col(key).eqNullSafe(F.col("_k")))
            .withColumn(flag, F.when(stale, F.lit("0")).otherwise(F.col(flag))).drop("_k", "_m"))


def with_retractions(df: DataFrame, key: str, order: Sequence[Column], cut: Column, amounts: Sequence[str]) -> DataFrame:
    """Every version of a key plus the previous version with negated amounts.

    Summing the result counts each key once, at its latest version. Null amounts stay null. The versions are written once, as the
    ordered groups look through them several times, and both signs come from one pass.
    """
    rows = settled(df.withColumn("_one", F.lit(1)), "versions")
    later = OrderedGroups(rows, [key], order, cut).step("_one", "_later")
    columns = [c for c in df.columns if c != "_one"]
    undone = F.struct(*[(-F.col(c)).alias(c) if c in amounts else F.col(c) for c in columns])
    both = F.array(F.struct(*columns), F.when(F.col("_later").isNotNull(), undone))
    return later.select(F.inline(F.array_compact(both)))


def only_newer(df: DataFrame, key: str, version: str, ties: Sequence[str]) -> DataFrame:
    """Rows that carry a greater version than everything before them in arrival order ``ties``."""
    order = [F.col(c) for c in ties]
    seen = OrderedGroups(df, [key], order, places(df, *ties)).running_max(version, "_seen")
    return seen.where(F.col("_seen").isNull() | (F.col(version) > F.col("_seen"))).drop("_seen")


def consecutive_days(daily: DataFrame, key: str, d: str, window: int = 7, run: int = 3) -> DataFrame:
    """Keys active on ``run`` consecutive days within the last ``window`` days.

    A key has at most ``window`` rows here, so they fit in one small array and no sort is needed.
    """
    recent = daily.where(F.col("ds").between(shift(d, 1 - window), d))
    days = recent.groupBy(key).agg(F.collect_set(F.datediff(F.lit(d).cast("date"), F.col("ds").cast("date"))).alias("_d"))
    hit = F.exists(F.col("_d"), lambda x: F.forall(
        F.sequence(F.lit(1), F.lit(run - 1)), lambda i: F.array_contains(F.col("_d"), x + i)))
    return days.where(hit).select(key)
