"""The inputs of the real-time queries: what their files hold, and how often the tables are read for them."""

import datetime as dt
import pathlib
import time
import types

import duckdb
from pyspark.sql import functions as F
from registry import realtime
from registry.core import _DUCK_SOURCES, Tables

from tidemill.session import fresh_path, shuffles_removed
from tidemill.streaming.state import first_of_day

ORDERS = ("o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp, "
          "o_orderpriority string")
LINES = ("l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, "
         "l_discount double, l_tax double, l_returnflag string, l_linestatus string")


def test_feed_files_are_compressed_and_whole(spark):
    rows = spark.range(20_000).select(F.to_json(F.struct(F.col("id").alias("a_long_column_name"), F.lit("x" * 50).alias("b"))).alias("value"))
    t = types.SimpleNamespace(spark=spark, sf_dir="feeds")
    path = realtime.feed(t, "compressed", lambda _: rows)
    size = sum(f.stat().st_size for f in pathlib.Path(path.removeprefix("file:")).rglob("part-*"))
    assert size * 3 < rows.agg(F.sum(F.length("value") + 1).alias("n")).first().n
    assert realtime.lines(t, "compressed", lambda _: rows).isStreaming
    read = spark.read.text(path)
    assert read.exceptAll(rows).isEmpty() and rows.exceptAll(read).isEmpty()


def test_detail_versions_come_from_one_pass(spark, tmp_path):
    day = dt.datetime(1995, 3, 1)
    orders = [(1, 10, "F", 1.0, day, "5-LOW"), (1, 11, "O", 1.0, day, "1-URGENT"), (2, None, "P", 2.0, day, None), (None, 3, "F", 1.0, day, "x")]
    lines = [(1, 5, 1, n, 2.0, 10.0 + n, disc, tax, "R", "F") for n, (disc, tax) in enumerate(
        [(0.06, 0.06), (0.06, 0.01), (0.01, 0.0), (None, 0.05), (0.04, None)], 1)] + [(2, 6, 1, 1, 1.0, 5.0, 0.1, 0.01, "N", "O"), (None, 5, 1, 1, 1.0, 5.0, 0.1, 0.1, "N", "O")]
    spark.createDataFrame(orders, ORDERS).write.parquet(str(tmp_path / "orders.parquet"))
    spark.createDataFrame(lines, LINES).write.parquet(str(tmp_path / "lineitem.parquet"))
    spark.createDataFrame([(5, "five"), (5, "again"), (6, "six")], "p_partkey bigint, p_name string").write.parquet(str(tmp_path / "part.parquet"))
    got = Tables(spark, str(tmp_path))["dwd_detail_versions"]
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for name in ("orders", "lineitem", "part"):
        con.execute(f"create view {name} as select * from read_parquet('{tmp_path}/{name}.parquet/*.parquet')")
    want = con.execute(_DUCK_SOURCES["dwd_detail_versions"].replace("{", "").replace("}", "")).fetchall()
    assert sorted(map(str, (tuple(r) for r in got.collect()))) == sorted(map(str, want)) and len(want) > 20
    plan = got._jdf.queryExecution().optimizedPlan().toString().splitlines()
    assert sum("Relation" in line and "l_linenumber" in line for line in plan) == 1


def test_raw_copy_is_packed_harder_than_its_feed_and_whole(spark, monkeypatch):
    def topic(t):
        after = {"id": F.col("id").cast("string"), "sku_name": F.md5(F.pmod(F.xxhash64("id"), F.lit(3000)).cast("string"))}
        return spark.range(0, 30_000, 1, 2).select(realtime._record("order_detail", after, F.lit("r"), {}, F.col("id")))

    written = []
    monkeypatch.setattr(realtime, "change_topic", topic)
    monkeypatch.setattr(realtime, "fresh_path", lambda spark, label: written.append(fresh_path(spark, label)) or written[-1])
    got = realtime.raw_copy(types.SimpleNamespace(spark=spark, sf_dir="feeds-raw-copy"))
    assert sorted((r.source_table, r.op, r.ts_ms) for r in got.collect()) == [("order_detail", "r", i) for i in range(30_000)]

    def size(label):
        path = next(p for p in written if f"/{label}-" in p and "ckpt" not in p)
        return sum(f.stat().st_size for f in pathlib.Path(path.removeprefix("file:")).rglob("part-*"))

    assert size("raw-changes") < 0.8 * size("feed-change") and spark.conf.get("parquet.page.size", None) is None


class Given(dict):
    """Tables by name, with what a feed needs besides."""

    def __init__(self, spark, tables, sf_dir):
        super().__init__(tables)
        self.spark, self.sf_dir = spark, sf_dir


def test_large_feed_is_read_in_batches_that_follow_each_other(spark, monkeypatch):
    monkeypatch.setattr(realtime, "ROWS_A_FILE", 100)
    monkeypatch.setattr(realtime, "FILES_A_BATCH", 3)
    rows = spark.range(1, 601).select(F.to_json(F.struct("id", (F.col("id") * 60_000).alias("ts"))).alias("value"), (F.col("id") * 60_000).alias("at"))
    t = Given(spark, {"orders": rows, "lineitem": rows, "events": rows}, "feeds-in-order")
    mixed = lambda _: rows.repartition(8, "value")
    read = realtime.flat(t, "ordered", mixed, "id bigint", "0 seconds", timed=True)
    batches = []

    def seen(batch, batch_id):
        batches.append(batch.count())

    realtime.drain(read.dropDuplicates(["id", "event_time"]).writeStream.foreachBatch(seen).option(
        "checkpointLocation", realtime.fresh_path(spark, "ordered-ckpt")))
    assert sum(batches) == 600 and sum(n > 0 for n in batches) == 6  # 18 files, three a batch, nothing late


def test_large_feed_is_cut_without_moving_its_lines(spark, monkeypatch):
    monkeypatch.setattr(realtime, "ROWS_A_FILE", 100)
    monkeypatch.setattr(realtime, "FILES_A_BATCH", 3)
    at = F.pmod(F.xxhash64("id"), F.lit(1000)).cast("bigint")
    rows = spark.range(0, 3000, 1, 5).select(F.to_json(F.struct("id")).alias("value"), F.when(F.col("id") > 5, at).alias("at"))
    t = Given(spark, {"orders": rows, "lineitem": rows, "events": rows.limit(0)}, "feeds-cut")
    path = realtime.feed(t, "cut", lambda _: rows)
    folder = pathlib.Path(path.removeprefix("file:"))
    slices = sorted(folder.glob("slice=*"), key=lambda p: int(p.name[6:]))
    files = [[f for f in s.iterdir() if not f.name.startswith(".")] for s in slices]
    assert len(slices) == 20 and {len(f) for f in files} == {realtime._ORDERED[path]}
    assert all(max(f.stat().st_mtime for f in a) < min(f.stat().st_mtime for f in b) for a, b in zip(files, files[1:]))
    read = spark.read.text(path)
    assert read.select("value").exceptAll(rows.select("value")).isEmpty() and read.count() == 3000
    timed = read.join(rows, "value").groupBy("slice").agg(F.min("at").alias("low"), F.max("at").alias("high"), F.count("*").alias("n")).orderBy("slice").collect()
    assert all(a.high < b.low for a, b in zip(timed, timed[1:])) and sum(r.n for r in timed) == 3000


def test_shuffles_of_a_build_are_removed(spark, tmp_path):
    store = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def held():
        files = store.getAllFiles()
        return sum("shuffle_" in files.apply(i).getName() for i in range(files.size()))

    before = held()
    with shuffles_removed(spark):
        spark.range(1000).repartition(3, "id").write.parquet(str(tmp_path / "rows"))
    for _ in range(50):
        if held() <= before:
            break
        time.sleep(0.1)
    assert held() <= before and spark.read.parquet(str(tmp_path / "rows")).count() == 1000


def test_first_of_day_thins_in_one_step(spark):
    rows = spark.readStream.format("rate").load().select(F.col("value").cast("string").alias("user_id"), F.col("timestamp").alias("event_time")).withWatermark("event_time", "0 seconds")
    plan = first_of_day(rows, ["user_id"], "5 seconds")._jdf.queryExecution().analyzed().toString()
    assert "Deduplicate" not in plan and plan.count("Aggregate [") == 1
