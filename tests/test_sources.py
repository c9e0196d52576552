"""Reads, writes and keyed tables."""

import pathlib

import pytest
from pyspark.sql import functions as F

from tidemill.session import fresh_path, settled, shared_folder
from tidemill.sources import tables as src
from tidemill.sources.upsert import KeyedTable, upsert_batches


@pytest.fixture
def days(spark):
    return spark.createDataFrame([(i, f"2025-07-{1 + i % 3:02d}") for i in range(30)], "id int, ds string")


def counts(spark, path):
    return {str(r.ds): r["count"] for r in spark.read.parquet(path).groupBy("ds").count().collect()}


def test_overwrites_leave_other_partitions(spark, days):
    path = fresh_path(spark, "t")
    src.append(days, path)
    src.append(src.read_day(days, "2025-07-01"), path)
    src.overwrite_day(days.limit(5).drop("ds"), path, "2025-07-02")
    src.overwrite_parts(src.read_day(days, "2025-07-03").limit(2), path)
    assert counts(spark, path) == {"2025-07-01": 20, "2025-07-02": 5, "2025-07-03": 2}


def test_partition_predicate_prunes_files(spark, days):
    path = fresh_path(spark, "t")
    src.append(days, path)
    plan = src.read_range(spark.read.parquet(path).withColumn("ds", F.col("ds").cast("string")), "2025-07-02", 2)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in text and "PartitionFilters: []" not in text


def test_align(spark, days):
    target = spark.createDataFrame([], "ds string, id bigint").schema
    assert src.align_to_schema(days, target).dtypes == [("ds", "string"), ("id", "bigint")]
    with pytest.raises(ValueError, match="missing"):
        src.align_to_schema(days.drop("id"), target)


def test_day_bucket(spark):
    df = spark.createDataFrame([("1751328000",), ("1751328000123",), ("x",), (None,)], "t string")
    assert [r[0] for r in df.select(src.day_bucket(F.col("t"))).collect()] == [
        "20250701", "20250701", "error_bucket", "error_bucket"]


def test_csv_drops_incomplete_rows(spark):
    path = fresh_path(spark, "csv")
    spark.createDataFrame([("a", "2025-07-01 10:00:00", "1"), ("b", "soon", "2"), (None, "2025-07-01 10:00:00", "3")],
                          "c string, at string, x string").write.option("header", True).csv(path)
    got = src.read_csv(spark, path, "c string, at string, x double", ["c", "at"], "at")
    assert [r.c for r in got.collect()] == ["a"]


def test_keyed_table(spark):
    table = KeyedTable(spark, fresh_path(spark, "k"), ["id"])
    assert table.read() is None

    def batch(*rows):
        return spark.createDataFrame(list(rows), "id int, v string, ts int")

    table.merge(batch((1, "a", 1), (1, "b", 2), (2, "x", 1)), ["ts"])
    table.merge(batch((2, "y", 5), (3, "z", 1)), ["ts"])
    table.merge(batch((2, "y", 5), (3, "z", 1)), ["ts"])  # a repeated batch changes nothing
    table.merge(spark.createDataFrame([], "id int, v string, ts int"), ["ts"])
    assert {r.id: r.v for r in table.read().collect()} == {1: "b", 2: "y", 3: "z"}


def test_two_streams_with_equal_batch_ids_keep_all_rows(spark):
    table = KeyedTable(spark, fresh_path(spark, "k"), ["id"], buckets=4)
    one, other = upsert_batches(table, ["ts"]), upsert_batches(table, ["ts"])
    one(spark.createDataFrame([(1, "a", 1), (None, "n", 1)], "id int, v string, ts int"), 0)
    other(spark.createDataFrame([(2, "b", 1), (None, "m", 2)], "id int, v string, ts int"), 0)
    assert {r.id: r.v for r in table.read().collect()} == {1: "a", 2: "b", None: "m"}


def test_merge_moves_batch_and_table_once(spark):
    table, folder = KeyedTable(spark, fresh_path(spark, "k"), ["id", "n"], buckets=4), pathlib.Path(shared_folder(spark).removeprefix("file:"))
    rows = spark.range(200).select(F.when(F.col("id") > 0, F.col("id")).alias("id"), F.lit("x").alias("n"), (F.col("id") * 2).alias("ts"))
    partitions, left = spark.conf.get("spark.sql.shuffle.partitions"), len(list(folder.glob("upsert-*")))
    table.merge(rows, ["ts"])
    table.merge(rows.where("id < 100").withColumns({"ts": F.lit(-1).cast("long"), "more": F.lit("m")}), ["ts"])
    got = {r.id: (r.ts, r.more) for r in table.read().collect()}
    assert got == {None: (0, None), **{i: (-1, "m") if i < 100 else (2 * i, None) for i in range(1, 200)}}
    assert len(list(folder.glob("upsert-*"))) == left  # nothing is left of the batches
    parts = sorted(pathlib.Path(table.path.removeprefix("file:")).glob("_bucket=*"))
    assert len(parts) == 4 and all(len(list(p.glob("part-*"))) == 1 for p in parts)
    assert spark.conf.get("spark.sql.shuffle.partitions") == partitions


def test_settled_reads_back(spark, days):
    again = settled(days)
    assert again.exceptAll(days).count() == 0 and "parquet" in again._jdf.queryExecution().executedPlan().toString().lower()
