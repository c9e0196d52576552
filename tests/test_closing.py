"""Joins and windows whose state is kept as files, over batches in the order of time."""

import pathlib

from pyspark.sql import functions as F
from registry import realtime
from registry.core import REG

from tidemill.streaming import closing, facts, metrics
from tidemill.streaming.closing import Part, Stream, closed_results

HOUR = 3_600


def stream(spark, path, files, schema, delay_s, keep=None):
    """One file a batch; times in seconds."""
    for rows in files:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").json(str(path))
    read = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(str(path))
    return Stream(read.withColumn("event_time", F.timestamp_seconds("at")), delay_s, keep)


def kept(spark, monkeypatch):
    """The folders that a run asks for."""
    asked, fresh = [], closing.fresh_path
    monkeypatch.setattr(closing, "fresh_path", lambda s, label: asked.append(fresh(s, label)) or asked[-1])
    return asked


def test_join_over_batches(spark, tmp_path, monkeypatch):
    """Partners in the same batch, in the one before and after it; a late row; an order with many lines; nothing but the border is carried."""
    asked = kept(spark, monkeypatch)
    lines = [[(f"h{i}", "o1", 100) for i in range(500)] + [("a", "o1", 95), ("b", "o2", 105), ("far", "o1", 116)],
             [("c", "o3", 211), ("d", "o2", 118), ("none", None, 150)], [("late", "o1", 101), ("beat", "-", 9999)]]
    orders = [[("o1", 105), ("o3", 90)], [("o2", 112), ("o3", 221), ("o3", 222)], [("-", 8888)]]
    left = stream(spark, tmp_path / "lines", lines, "id string, order_id string, at long", 5)
    right = stream(spark, tmp_path / "orders", orders, "order string, at long", 5, F.col("order") != "-")

    def job(rows, o):
        return facts.join_order(rows, o.select(F.col("order").alias("_o"), F.col("event_time").alias("_ot")), "order_id", "event_time", 10)

    got = closed_results([left, right], [Part(job, 10, 10)], "joined")[0]
    want = sorted([f"h{i}" for i in range(500)] + ["a", "b", "c", "d"])
    assert sorted(r.id for r in got.collect()) == want and "event_time" not in got.columns
    assert spark.read.parquet(f"{asked[0]}/carried-2").where("s0 is not null").count() <= 1
    plan = job(spark.range(1).selectExpr("'a' as id", "'b' as order_id", "current_timestamp() as event_time"),
               spark.range(1).selectExpr("'b' as order", "current_timestamp() as event_time"))._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan  # no copies of the orders


def test_windows_and_several_parts(spark, tmp_path):
    """Windows that reach over the border of a batch are given out once and whole, each part by its own horizon."""
    files = [[("k", "u1", 10), ("k", "u2", 3599), ("j", "u1", 20)], [("k", "u1", 3500), ("k", "u3", 3590), ("k", "u1", 3601)],
             [("k", "u1", 7300), ("k", "u9", 7100)], [(None, None, 99_999)]]
    rows = stream(spark, tmp_path / "in", files, "sku_name string, user_id string, at long", 300)
    parts = [Part(metrics.sku_visitors, 0, HOUR, F.col("edt").cast("timestamp")), Part(lambda d: d.where("user_id is not null"), 0, 0)]
    visitors, every = closed_results([rows], parts, "windows")
    assert sorted((r.stt[11:], r.sku_name, r.uv_cnt) for r in visitors.collect()) == [
        ("00:00:00", "j", 1), ("00:00:00", "k", 3), ("01:00:00", "k", 2), ("02:00:00", "k", 1)]
    assert sorted(r.at for r in every.collect()) == [10, 20, 3500, 3590, 3599, 3601, 7100, 7300]


def test_left_joins_give_every_line_once(spark, tmp_path):
    files = [[("l1", "x", 10), ("l2", "x", 19)], [("l1", "y", 20), ("l3", "x", 21), ("l2", "y", 30)], [("-", "-", 9999)]]
    rows = stream(spark, tmp_path / "in", files, "id string, kind string, at long", 0)

    def job(r):
        b = r.where("kind = 'y'").select(F.col("id").alias("_b"), F.col("at").alias("met"), F.col("event_time").alias("_bt"))
        return r.where("kind = 'x'").join(b, (F.col("id") == F.col("_b")) & facts.near("event_time", "_bt", 10, 10), "left_outer").select("id", "met", "event_time")

    got = closed_results([rows], [Part(job, 10, 10)], "left")[0]
    assert sorted((r.id, r.met) for r in got.collect()) == [("l1", 20), ("l2", None), ("l3", None)]


def test_joins_and_windows_of_the_feeds_hold_no_state_store(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(realtime, "ROWS_A_FILE", 150)
    monkeypatch.setattr(realtime, "_FEEDS", {})
    asked = kept(spark, monkeypatch)
    for key in ("R11_order_detail_board", "R23_sku_visitors"):
        assert REG.queries[key](spark, sf_dir).count() > 0
    assert asked and not any(p.is_dir() for a in asked for p in pathlib.Path(a.removeprefix("file:")).glob("state"))
    assert any(len(list(pathlib.Path(a.removeprefix("file:")).glob("part-0/batch=*"))) > 1 for a in asked)  # in several batches


def test_records_are_written_without_interpreted_functions(spark):
    rows = spark.createDataFrame([("1", None, 5, 7)], "a string, b string, n int, at long")
    record = realtime._record("t", {"a": F.col("a"), "b": F.col("b"), "n": F.col("n")}, F.lit("u"), {"b": F.col("b")}, F.col("at"))
    text = '{"op":"u","before":{},"after":{"a":"1","n":"5"},"source":{"table":"t"},"ts_ms":7}'
    assert [r.value for r in rows.select(record).collect()] == [text]
    assert "map_filter" not in rows.select(record)._jdf.queryExecution().optimizedPlan().toString().lower()
