"""Partitioned table reads and writes (batch)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemill.functions.dates import OPEN_DATE, horizon_start


def read_day(df: DataFrame, d: str, part: str = "ds") -> DataFrame:
    """One partition."""
    return df.where(F.col(part) == d)


def read_range(df: DataFrame, d: str, n: int, part: str = "ds") -> DataFrame:
    """The n partitions ending at d."""
    return df.where(F.col(part).between(horizon_start(d, n), d))


def read_open_and(df: DataFrame, d: str, part: str = "ds") -> DataFrame:
    """The open partition and the one closed at d (S3)."""
    return df.where(F.col(part).isin(OPEN_DATE, d))


def read_csv(spark: SparkSession, path: str, schema: StructType | str, required: Sequence[str],
             time_col: str | None = None, time_format: str = "yyyy-MM-dd HH:mm:ss") -> DataFrame:
    """CSV with a declared schema; unreadable times become null, rows lacking a required value go."""
    df = spark.read.schema(schema).option("header", True).csv(path)
    if time_col:
        df = df.withColumn(time_col, F.try_to_timestamp(F.col(time_col), F.lit(time_format)))
    return df.dropna(subset=list(required))


def align_to_schema(df: DataFrame, schema: StructType) -> DataFrame:
    """Columns reordered and cast to the target table (S13); a missing column is an error, an extra one goes."""
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"columns missing for the target table: {missing}")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def _sized(df: DataFrame, part: str) -> DataFrame:
    """One shuffle on the partition value plus a random salt chosen by the optimizer's target size.

    ``REBALANCE`` keeps rows of one date together but splits a date that is too big for one file.
    """
    return df.hint("rebalance", F.col(part))


def append(df: DataFrame, path: str, part: str = "ds", fmt: str = "parquet") -> None:
    """Append to a date-partitioned table."""
    _sized(df, part).write.mode("append").format(fmt).partitionBy(part).save(path)


def overwrite_day(df: DataFrame, path: str, d: str, part: str = "ds", fmt: str = "parquet") -> None:
    """Replace one partition, leave the others alone (S11). The partition value is a literal, so there is no
    shuffle on it: every task would get the same key."""
    (df.withColumn(part, F.lit(d)).hint("rebalance").write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").format(fmt).partitionBy(part).save(path))


def overwrite_parts(df: DataFrame, path: str, part: str = "ds", fmt: str = "parquet") -> None:
    """Replace exactly the partitions present in ``df``."""
    (_sized(df, part).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .format(fmt).partitionBy(part).save(path))


def write_bucketed_by_day(df: DataFrame, path: str, epoch: str, fmt: str = "parquet") -> None:
    """Date-bucketed files (S20): see :func:`day_bucket`."""
    _sized(df.withColumn("day", day_bucket(F.col(epoch))), "day") \
        .write.mode("append").format(fmt).partitionBy("day").save(path)


def day_bucket(epoch):
    """``yyyyMMdd`` of an epoch in seconds or ms; anything unreadable goes to ``error_bucket``."""
    value = epoch.try_cast("bigint")
    ms = F.when(value < 10_000_000_000, value * 1000).otherwise(value)
    return F.coalesce(F.date_format(F.timestamp_millis(ms), "yyyyMMdd"), F.lit("error_bucket"))


def jdbc_query(spark: SparkSession, url: str, query: str, options: Mapping[str, str] | None = None) -> DataFrame:
    """Scan of a pushed-down subquery (S4); needs the driver jar of the database on the class path."""
    return (spark.read.format("jdbc").option("url", url).option("dbtable", f"({query}) t")
            .options(**(options or {})).load())


def jdbc_append(df: DataFrame, url: str, table: str, column_types: str, batch: int = 5000,
                options: Mapping[str, str] | None = None) -> None:
    """JDBC append with explicit column types."""
    (df.write.format("jdbc").mode("append").option("url", url).option("dbtable", table)
     .option("batchsize", batch).option("createTableColumnTypes", column_types)
     .options(**(options or {})).save())
