"""Streams: several files, restarts, late rows, live configuration."""

import json
import os
import pathlib
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from tidemill.session import fresh_path
from tidemill.streaming import facts, logs, metrics
from tidemill.streaming.sinks import drain, files_writer
from tidemill.streaming.sources import change_log, json_lines
from tidemill.streaming.state import first_of_day, live, with_retractions

ROOT = pathlib.Path(__file__).resolve().parents[1]
DAY = 86_400_000
T0 = 1_751_328_000_000  # 2025-07-01 00:00:00


def put(spark, path, records):
    """Append one file of JSON lines (or raw text lines)."""
    lines = [r if isinstance(r, str) else json.dumps(r) for r in records]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("append").text(path)


def log(mid, ts, is_new="1", **extra):
    base = {"common": {"mid": mid, "is_new": is_new}, "page": {"page_id": "home"}, "ts": ts}
    return {**base, **extra}


def run_log(spark, path, out, memory, ckpt):
    drain(json_lines(spark, path, 1).writeStream.foreachBatch(logs.split_batches(out, memory))
          .option("checkpointLocation", ckpt))


def test_log_split_and_repair_across_batches(spark):
    path, out, memory, ckpt = (fresh_path(spark, x) for x in ("in", "out", "mem", "ck"))
    put(spark, path, ["no json", log("a", T0, displays=[{"pos": "1"}, {"pos": "2"}], actions=[{"action_id": "x"}]),
                      log("b", T0, is_new="0", err={"code": "7"}),
                      {"common": {"mid": "c", "is_new": "1"}, "start": {"entry": "icon"}, "ts": T0}])
    run_log(spark, path, out, memory, ckpt)
    put(spark, path, [log("a", T0 + DAY), log("a", T0 + 1000), log("b", T0 + 5, is_new="1"), log("d", T0 + DAY)])
    run_log(spark, path, out, memory, ckpt)  # restarted from the checkpoint
    rows = spark.read.option("basePath", out).parquet(f"{out}/batch=*")
    assert {r.route: r["count"] for r in rows.groupBy("route").count().collect()} == {
        "dirty": 1, "err": 1, "start": 1, "display": 2, "action": 1, "page": 6}
    j = F.get_json_object
    got = rows.where("route = 'page'").select(j("value", "$.common.mid").alias("m"), j("value", "$.ts").cast("long").alias("t"),
                                             j("value", "$.common.is_new").alias("f")).collect()
    assert sorted((r.m, r.t - T0, r.f) for r in got) == [
        ("a", 0, "1"), ("a", 1000, "1"), ("a", DAY, "0"), ("b", 0, "0"), ("b", 5, "0"), ("d", DAY, "1")]


def events(spark, path, delay="0 seconds"):
    schema = "mid string, ts bigint"
    rec = F.from_json("value", schema).alias("r")
    return metrics.clocked(json_lines(spark, path, 1).select(rec).select("r.*"), "ts", delay)


def test_first_of_day_survives_a_restart(spark):
    path, out, ckpt = (fresh_path(spark, x) for x in ("in", "out", "ck"))

    def run():
        rows = events(spark, path).where(live(F.col("mid") != "beat"))
        drain(files_writer(first_of_day(rows, ["mid"], "5 seconds"), out, ckpt).outputMode("append"))

    put(spark, path, [{"mid": "a", "ts": T0 + 20_000}, {"mid": "a", "ts": T0 + 1_000}, {"mid": "b", "ts": T0 + 2_000}])
    run()
    put(spark, path, [{"mid": "a", "ts": T0 + 30_000}, {"mid": "a", "ts": T0 + 9 * DAY}])
    run()
    got = spark.read.parquet(out).select("mid", F.date_format("event_time", "dd HH:mm:ss").alias("at"), "is_first", "gap_days")
    assert sorted(tuple(r) for r in got.collect()) == [
        ("a", "01 00:00:04", 1, None), ("a", "10 00:00:04", 0, 9), ("b", "01 00:00:04", 1, None)]


def test_hot_key_windows(spark):
    """A visitor with a third of all events counts once."""
    path, out, ckpt = (fresh_path(spark, x) for x in ("in", "out", "ck"))
    put(spark, path, [{"mid": "hot" if i % 3 == 0 else f"u{i % 50}", "ts": T0 + i} for i in range(900)]
        + [{"mid": "beat", "ts": T0 + DAY}])
    rows = events(spark, path).where(live(F.col("mid") != "beat")).withColumn("ch", F.lit("c"))
    drain(files_writer(metrics.distinct_in_window(rows, "10 seconds", ["ch"], "mid", "uv"), out, ckpt).outputMode("append"))
    assert [r.uv for r in spark.read.parquet(out).collect()] == [51]


def test_retraction_within_lifetime_only(spark):
    path, out, ckpt = (fresh_path(spark, x) for x in ("in", "out", "ck"))
    for batch in ([("x", 0, 5), ("y", 0, None)], [("x", 6_000, 7), ("y", 7_000, 2)], [("x", 60_000, 9)], [("beat", DAY, 0)],
                  [("beat", DAY + 1, 0)]):
        put(spark, path, [{"id": i, "ts": T0 + t, "v": v} for i, t, v in batch])
    rec = F.from_json("value", "id string, ts bigint, v int").alias("r")
    rows = metrics.clocked(json_lines(spark, path, 1).select(rec).select("r.*"), "ts", "0 seconds").where(live(F.col("id") != "beat"))
    drain(files_writer(with_retractions(rows, "id", "ts", ["v"], "5 seconds"), out, ckpt).outputMode("append"))
    got = spark.read.parquet(out).groupBy("id").agg(F.sum(F.col("sign") * F.coalesce("v", F.lit(0))).alias("v"), F.sum("sign").alias("n"))
    # x: 5 replaced by 7 in time; 9 comes a minute later and counts on its own
    assert {r.id: (r.v, r.n) for r in got.collect()} == {"x": (16, 2), "y": (2, 1)}


@pytest.mark.parametrize("grain", ["1 second", "5 seconds", "10 seconds"])
def test_retraction_lifetime_is_event_time(spark, grain):
    """Distances of 9.9, 10 and 10.1 s at every place of the windows; several versions in one window; one batch per file."""
    path, out, ckpt = (fresh_path(spark, x) for x in ("in", "out", "ck"))
    rows = []
    for k, start in enumerate(range(0, 10_000, 700)):
        for name, gap in (("in", 9_900), ("edge", 10_000), ("out", 10_100)):
            rows += [(f"{name}{k}", start, 1), (f"{name}{k}", start + gap, 10), (f"{name}{k}", start + gap + 40, 100)]
    rows += [("hot", i * 7, i) for i in range(600)]
    rows.sort(key=lambda r: r[1])
    for n in range(0, len(rows), 150):
        put(spark, path, [{"id": i, "ts": T0 + t, "v": v} for i, t, v in rows[n:n + 150]])
    put(spark, path, [{"id": "beat", "ts": T0 + DAY, "v": 0}])
    put(spark, path, [{"id": "beat", "ts": T0 + DAY + 1, "v": 0}])
    rec = F.from_json("value", "id string, ts bigint, v int").alias("r")
    stream = metrics.clocked(json_lines(spark, path, 1).select(rec).select("r.*"), "ts", "1 second").where(live(F.col("id") != "beat"))
    drain(files_writer(with_retractions(stream, "id", "ts", ["v"], grain), out, ckpt).outputMode("append"))
    got = {r.id: (r.v, r.n) for r in spark.read.parquet(out).groupBy("id").agg(F.sum(F.col("sign") * F.col("v")).alias("v"), F.sum("sign").alias("n")).collect()}
    want = {"hot": (599, 1)}
    for k in range(15):
        want |= {f"in{k}": (100, 1), f"edge{k}": (100, 1), f"out{k}": (101, 2)}
    assert got == want


def test_retraction_needs_a_grain_within_the_lifetime(spark):
    with pytest.raises(ValueError):
        with_retractions(spark.createDataFrame([], "id string, event_time timestamp, ts long, v int"), "id", "ts", ["v"], "20 seconds")


def test_state_processors_run_from_another_folder(tmp_path):
    """The package is on the driver's path only, not in the workers' folder."""
    code = f"""
import json, sys
sys.path.insert(0, {str(ROOT)!r})
from pyspark.sql import functions as F
from tidemill.session import fresh_path, local_session
from tidemill.streaming.metrics import clocked
from tidemill.streaming.sinks import run_to_table
from tidemill.streaming.sources import json_lines
from tidemill.streaming.state import first_of_day, live, only_newer
spark = local_session("2", "elsewhere", 2)
path = fresh_path(spark, "in")
lines = [json.dumps({{"id": i, "ts": 1751328000000 + t}}) for i, t in (("a", 5), ("a", 1), ("b", 2), ("beat", 400000000))]
spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
rec = F.from_json("value", "id string, ts bigint").alias("r")
rows = clocked(json_lines(spark, path, 1).select(rec).select("r.*"), "ts", "0 seconds").where(live(F.col("id") != "beat"))
print("FIRST", run_to_table(first_of_day(rows, ["id"], "5 seconds"), "out").count())
print("NEWER", run_to_table(only_newer(rows.withColumnRenamed("ts", "ts_ms")), "out").count())
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    got = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "FIRST 2" in got.stdout and "NEWER 3" in got.stdout, got.stderr[-2000:]


def change(table, after, op="r", before=None, ts=0):
    return {"op": op, "before": before, "after": after, "source": {"table": table}, "ts_ms": T0 + ts}


def test_order_detail_left_sides(spark):
    path, out, ckpt = (fresh_path(spark, x) for x in ("in", "out", "ck"))
    line = {"order_id": "1", "sku_id": "9", "create_time": str(T0), "sku_num": "2", "order_price": "1.50"}
    put(spark, path, [
        change("order_info", {"id": "1", "user_id": "u", "province_id": "p", "order_status": "1001"}),
        change("order_detail", {**line, "id": "a"}), change("order_detail", {**line, "id": "b"}),
        change("order_detail", {**line, "id": "far"}, ts=60_000),
        change("order_detail_activity", {"order_detail_id": "a", "activity_id": "A", "activity_rule_id": "R"}, ts=1000),
        {"ts_ms": T0 + DAY}])
    changes = change_log(json_lines(spark, path)).withWatermark("event_time", "5 seconds")
    drain(files_writer(facts.order_detail(changes), out, ckpt).outputMode("append"))
    got = spark.read.parquet(out).select("id", "user_id", "activity_id", "coupon_id", "split_original_amount").collect()
    assert sorted(tuple(r) for r in got) == [("a", "u", "A", None, "3.00"), ("b", "u", None, None, "3.00")]


def test_router_reads_its_config_every_batch(spark):
    changes = spark.createDataFrame([
        ("u", None, {"id": "1", "n": "2", "secret": "s"}, {"table": "cart_info"}, 1),
        ("d", {"id": "2"}, None, {"table": "cart_info"}, 2),
        ("c", None, {"id": "3"}, {"table": "other"}, 3)],
        "op string, before map<string,string>, after map<string,string>, source map<string,string>, ts_ms bigint")
    schema = "source_table string, sink_table string, sink_columns string, op string"
    first = spark.createDataFrame([("cart_info", "dwd_cart", "id,n", "u")], schema)
    got = [(r.topic, json.loads(r.value)) for r in facts.fact_routes(changes, first).collect()]
    assert got == [("dwd_cart", {"id": "1", "n": "2", "ts": "1"})]
    second = spark.createDataFrame([("other", "dwd_other", "id", "c")], schema)
    assert [r.topic for r in facts.fact_routes(changes, second).collect()] == ["dwd_other"]
    dims = spark.createDataFrame([("cart_info", "dim_cart", "id", "id")],
                                 "source_table string, sink_table string, sink_columns string, sink_row_key string")
    assert [json.loads(r.value) for r in facts.dim_routes(changes, dims).collect()] == [{"id": "1"}]


def test_router_does_not_shuffle_its_records(spark, monkeypatch):
    changes = spark.createDataFrame([("u", None, {"id": "1"}, {"table": "cart_info"}, 1)],
                                    "op string, before map<string,string>, after map<string,string>, source map<string,string>, ts_ms bigint")
    config = spark.createDataFrame([("cart_info", "dwd_cart", "id", "u")], "source_table string, sink_table string, sink_columns string, op string")

    def plan():
        return facts.fact_routes(changes, config)._jdf.queryExecution().sparkPlan().toString()

    assert "BroadcastHashJoin" in plan()  # the optimizer does not know the size of this table
    monkeypatch.setattr(facts, "ROUTES", 0)
    assert "BroadcastHashJoin" not in plan() and facts.fact_routes(changes, config).count() == 1


@pytest.mark.parametrize("op, was, now, want", [("r", None, "3", 3), ("u", "1", "3", 2), ("u", "3", "1", None), ("u", None, "3", None)])
def test_cart_adds(spark, op, was, now, want):
    df = spark.createDataFrame([(op, {"sku_num": was} if was else {}, {"id": "1", "sku_num": now}, {"table": "cart_info"}, T0)],
                               "op string, before map<string,string>, after map<string,string>, source map<string,string>, "
                               "ts_ms bigint").withColumn("event_time", F.timestamp_millis("ts_ms"))
    got = [r.sku_num for r in facts.cart_adds(df).collect()]
    assert got == ([] if want is None else [want])
