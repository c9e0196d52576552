"""Zipper tables: every version of a dimension row with its validity interval."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.functions.dates import OPEN_DATE, shift
from tidemill.operators.ranking import latest_per_key


def scd2_init(rows: DataFrame, start) -> DataFrame:
    """Every row opens at ``start`` (a date string or a column) and never ends."""
    start = F.lit(start) if isinstance(start, str) else start
    return rows.withColumn("start_date", start).withColumn("end_date", F.lit(OPEN_DATE))


def scd2_merge(open_rows: DataFrame, changes: DataFrame, d: str, key: str, order: Sequence[str],
               close_offset: int = 1) -> DataFrame:
    """Apply one day's changes (C7): the newest change per key opens at d, the version it replaces is closed at
    ``d - close_offset`` days. Returns open and newly closed rows; write it partitioned by ``end_date``.

    A change to an unknown key just opens. Both sides have one row per key after the map-side-combined
    deduplication, so the join is skew free.
    """
    attrs = [c for c in open_rows.columns if c not in ("start_date", "end_date")]
    newest = latest_per_key(changes, [key], order).select(*attrs)
    touched = newest.select(F.col(key).alias("_k"))
    marked = open_rows.join(touched, F.col(key) == F.col("_k"), "left")
    kept = marked.withColumn(
        "end_date", F.when(F.col("_k").isNotNull(), F.lit(shift(d, -close_offset))).otherwise(F.col("end_date"))
    ).drop("_k")
    return kept.unionByName(scd2_init(newest, d).select(*kept.columns))
