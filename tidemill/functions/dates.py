"""Date, partition-value and epoch helpers. Dates travel as ISO strings, the partition value form."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

OPEN_DATE = "9999-12-31"  # fixed value: partition of rows that are still open


def shift(d: str, days: int) -> str:
    """ISO date string moved by a number of days (plain Python: used for job parameters)."""
    return (dt.date.fromisoformat(d) + dt.timedelta(days=days)).isoformat()


def horizon_start(d: str, n: int) -> str:
    """First day of the n-day window that ends on d."""
    return shift(d, 1 - n)


def compact(d: str) -> str:
    """``2025-06-27`` -> ``20250627``, the other partition format in use."""
    return d.replace("-", "")


def as_ds(col: Column) -> Column:
    """Timestamp or date column -> ISO partition value."""
    return F.date_format(col, "yyyy-MM-dd")


def as_text_time(col: Column) -> Column:
    return F.date_format(col, "yyyy-MM-dd HH:mm:ss")


def ms_to_time(col: Column) -> Column:
    """Epoch milliseconds -> session-zone timestamp."""
    return F.timestamp_millis(col.cast("bigint"))


def ms_to_ds(col: Column) -> Column:
    return as_ds(ms_to_time(col))


def ms_to_text(col: Column) -> Column:
    return as_text_time(ms_to_time(col))


def epoch_days_to_ds(col: Column) -> Column:
    """Days since 1970-01-01 -> ISO date."""
    return as_ds(F.date_from_unix_date(col.cast("int")))


def iso_to_text(col: Column) -> Column:
    """``2025-07-11T10:20:30Z`` -> ``2025-07-11 10:20:30`` by slicing, no zone conversion."""
    return F.concat(F.substring(col, 1, 10), F.lit(" "), F.substring(col, 12, 8))


def seconds_between(later: Column, earlier: Column) -> Column:
    return F.unix_timestamp(later) - F.unix_timestamp(earlier)


def span_label(end: Column, n: int) -> Column:
    """Label of the n-day range ending at ``end`` (an ISO string)."""
    return F.concat(as_ds(F.date_sub(end.cast("date"), n - 1)), F.lit("至"), end)


def date_spine(spark: SparkSession, first: str, last: str) -> DataFrame:
    """One row per day, both ends included, as ``yyyymmdd`` integers."""
    days = spark.range(1).select(F.explode(F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"))).alias("d"))
    return days.select(F.date_format("d", "yyyyMMdd").cast("int").alias("day"))


def event_millis(col: Column) -> Column:
    """Event time in ms; 10-digit values are seconds; anything unreadable becomes 0."""
    value = col.try_cast("bigint")
    return F.coalesce(F.when(value < 10_000_000_000, value * 1000).otherwise(value), F.lit(0))
