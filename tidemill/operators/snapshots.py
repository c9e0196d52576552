"""Accumulating snapshots: one row per order, its milestones filled in as they happen."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.functions.dates import OPEN_DATE

# Status codes of the order log and the milestone each one marks.
MILESTONES = {"1002": "payment_time", "1004": "delivery_time", "1005": "closed_time", "1006": "finished_time"}


def milestones(status_log: DataFrame, marks: Mapping[str, str] = MILESTONES, key: str = "order_id") -> DataFrame:
    """One row per order with a column per status: a single pass with map-side combine, not a join per status."""
    return status_log.where(F.col("order_status").isin(*marks)).groupBy(key).agg(
        *[F.min(F.when(F.col("order_status") == code, F.col("create_time"))).alias(name)
          for code, name in marks.items()])


def end_partition(closed: Column, finished: Column) -> Column:
    """ISO date of the first of closed/finished, else the open partition."""
    return F.coalesce(F.substring(F.coalesce(closed, finished), 1, 10), F.lit(OPEN_DATE))


def _finish(df: DataFrame, total: str) -> DataFrame:
    return (df.withColumn("payment_amount", F.when(F.col("payment_time").isNull(), F.lit(0)).otherwise(F.col(total)))
            .withColumn("ds", end_partition(F.col("closed_time"), F.col("finished_time"))))


def snapshot_init(orders: DataFrame, status_log: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Orders with their milestones; partition = end date or open (C8). ``total_amount`` is carried along."""
    done = orders.select("order_id", *keep, "total_amount").join(milestones(status_log), "order_id", "left")
    return _finish(done, "total_amount")


def snapshot_merge(open_rows: DataFrame, new_orders: DataFrame, status_log: DataFrame,
                   keep: Sequence[str]) -> DataFrame:
    """Open rows plus the day's orders, new milestones win over old ones, re-partitioned by end date."""
    names = list(MILESTONES.values())
    old = open_rows.select("order_id", *keep, "total_amount", *names)
    fresh = new_orders.select("order_id", *keep, "total_amount", *[F.lit(None).cast("string").alias(n) for n in names])
    fresh = fresh.join(old.select("order_id"), "order_id", "left_anti")
    news = milestones(status_log).select("order_id", *[F.col(n).alias(f"_{n}") for n in names])
    merged = old.unionByName(fresh).join(news, "order_id", "left")
    for n in names:
        merged = merged.withColumn(n, F.coalesce(f"_{n}", n)).drop(f"_{n}")
    return _finish(merged, "total_amount")
