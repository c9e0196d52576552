"""Streaming operators with a mechanism of their own: Bloom filters, clock windows, live configuration, bounded merges."""

import json
import time

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from test_streaming import DAY, T0, change, put
from tidemill.session import fresh_path
from tidemill.streaming import facts, metrics
from tidemill.streaming.bloom import Layer, bits_for, bloom_deduplicated
from tidemill.streaming.sinks import drain, files_writer
from tidemill.streaming.sources import change_log, json_lines
from tidemill.streaming.state import first_of_day, live, only_newer


def test_bloom_layer_rate():
    rng = np.random.default_rng(1)
    layer = Layer(0, 5000, 0.01)
    keys = rng.integers(0, 2 ** 32, (2, 5000), dtype=np.uint32)
    layer.add(*keys)
    assert layer.holds(*keys).all()
    other = rng.integers(0, 2 ** 32, (2, 200_000), dtype=np.uint32)
    assert layer.holds(*other).mean() < 0.015
    assert bits_for(5000, 0.01) == 47_926  # -n ln p / ln(2)^2


def bloom_run(spark, files, expected, fpp, period="1 hour", delay="2 hours"):
    path, out, ckpt = (fresh_path(spark, x) for x in ("in", "out", "ck"))
    for rows in files:
        spark.createDataFrame(pd.DataFrame(rows, columns=["key", "ts"])).coalesce(1).write.mode("append").json(path)
    reader = spark.readStream.schema("key string, ts bigint").option("maxFilesPerTrigger", 1).json(path)
    rows = metrics.clocked(reader, "ts", delay)
    drain(files_writer(bloom_deduplicated(rows, "key", period, expected, fpp, shards=4), out, ckpt).outputMode("append"))
    return [r.key for r in spark.read.parquet(out).collect()]


def test_bloom_passes_no_repeat_and_loses_little(spark):
    """Three times as many keys as expected, sent twice in the same and in later batches; one key has a third of all rows."""
    first = [(f"k{i}", T0 + i) for i in range(6000)] + [("hot", T0 + i) for i in range(3000)]
    files = [first, first[::-1], [(f"n{i}", T0 + 3_000_000 + i) for i in range(3000)] + [(f"k{i}", T0 + 3_000_000) for i in range(0, 6000, 7)]]
    got = bloom_run(spark, files, 2000, 0.02)
    assert len(got) == len(set(got))
    assert 9001 - len(got) <= 0.02 * 9001 and "hot" in got


def test_bloom_forgets_with_the_watermark(spark):
    files = [[("a", T0), ("b", T0)], [("beat", T0 + 10 * 3_600_000)], [("beat2", T0 + 10 * 3_600_000)], [("a", T0 + 10 * 3_600_000)]]
    got = bloom_run(spark, files, 100, 0.01)
    assert sorted(got) == ["a", "a", "b", "beat", "beat2"]


def test_clock_windows_follow_the_clock(spark):
    """Two batches seconds apart, with the same stated times: two windows."""
    path, out, ckpt = (fresh_path(spark, x) for x in ("in", "out", "ck"))

    def run(n):
        put(spark, path, [{"ts": T0, "n": i} for i in range(n)])
        rec = F.from_json("value", "ts bigint, n int").alias("r")
        rows = json_lines(spark, path).select(rec).select("r.*")
        drain(files_writer(metrics.processing_windows(rows, "1 second", [], F.count(F.lit(1)).alias("n")), out, ckpt).outputMode("append"))
        time.sleep(1.2)

    for n in (5, 7, 1):
        run(n)
    got = spark.read.parquet(out).orderBy("stt").collect()
    assert [r.n for r in got] == [5, 7]  # the third window is still open
    assert got[0].edt <= got[1].stt and all(pd.Timestamp(r.edt) - pd.Timestamp(r.stt) == pd.Timedelta("1s") for r in got)


def test_one_running_query_follows_the_configuration(spark):
    records, config, out, ckpt = (fresh_path(spark, x) for x in ("rec", "conf", "out", "ck"))

    def configure(*rows):
        spark.createDataFrame([(*r,) for r in rows], facts.CONFIG_CHANGE).coalesce(1).write.mode("append").json(config)

    def run(batch, batch_id):
        history = facts.config_history(spark.read.schema(facts.CONFIG_CHANGE).json(config), ["source_table", "op"])
        facts.fact_routes_as_of(batch, history).write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    def count():
        return spark.read.parquet(f"{out}/*").count()

    configure(("r", "cart_info", "old", "id,n", "u", T0))  # there at the start
    put(spark, records, [change("cart_info", {"id": "1", "n": "2", "x": "s"}, "u", ts=5), change("cart_info", {"id": "0"}, "u", ts=-1)])
    query = change_log(json_lines(spark, records, 1)).writeStream.foreachBatch(run).option("checkpointLocation", ckpt).start()
    try:
        for at, changes, rows in ((100, [("u", "cart_info", "new", "id", "u", T0 + 100), ("c", "other", "more", "id", "c", T0 + 100)],
                                   [change("cart_info", {"id": "2", "n": "3"}, "u", ts=150), change("cart_info", {"id": "3", "n": "4"}, "u", ts=99),
                                    change("other", {"id": "4"}, "c", ts=120)]),
                                  (200, [("d", "cart_info", "new", "id", "u", T0 + 200)],
                                   [change("cart_info", {"id": "5"}, "u", ts=200), change("cart_info", {"id": "6"}, "u", ts=199)])):
            query.processAllAvailable()
            configure(*changes)
            put(spark, records, rows)
        query.processAllAvailable()
    finally:
        query.stop()
    got = {(r.topic, json.loads(r.value)["id"], json.loads(r.value).get("n")) for r in spark.read.parquet(f"{out}/*").collect()}
    assert got == {("old", "1", "2"), ("old", "3", "4"), ("new", "2", None), ("more", "4", None), ("new", "6", None)} and count() == 5


def test_prefixed_merge_is_bounded_in_time(spark):
    path, out, ckpt = (fresh_path(spark, x) for x in ("in", "out", "ck"))
    put(spark, path, [{"kind": "o", "id": "1", "v": "x", "ts": T0}, {"kind": "l", "id": "a", "v": "1", "ts": T0 + 2000},
                      {"kind": "l", "id": "b", "v": "1", "ts": T0 - 2000}, {"kind": "l", "id": "c", "v": "1", "ts": T0 + 2001}, {"kind": "beat", "ts": T0 + DAY}])
    rec = F.from_json("value", "kind string, id string, v string, ts bigint").alias("r")
    rows = metrics.clocked(json_lines(spark, path).select(rec).select("r.*"), "ts", "5 seconds")
    lines = rows.where(live(F.col("kind") == "l")).select("id", F.col("v").alias("order_id"), "event_time")
    orders = rows.where(live(F.col("kind") == "o")).select("id", "v", "event_time")
    drain(files_writer(facts.prefixed_merge(lines, orders, "order_id", "id", "info_", 2), out, ckpt).outputMode("append"))
    got = spark.read.parquet(out)
    assert sorted((r.id, r.info_id, r.info_v) for r in got.collect()) == [("a", "1", "x"), ("b", "1", "x")]


def test_newest_over_batches(spark):
    """One file a batch; an id comes late with an older version, and is forgotten two lifetimes later."""
    path, out, ckpt = (fresh_path(spark, x) for x in ("in", "out", "ck"))
    hour = 3_600_000
    for batch in ([("a", 5, 0), ("a", 3, 1), ("b", 1, 0)], [("a", 4, 10), ("a", 9, 20), ("b", 1, 10)], [("a", 8, 15), ("c", 1, 5)],
                  [("beat", 1, 9 * hour)], [("beat", 2, 9 * hour + 1)], [("a", 2, 9 * hour)]):
        put(spark, path, [{"id": i, "v": v, "ts": T0 + t} for i, v, t in batch])
    rec = F.from_json("value", "id string, v bigint, ts bigint").alias("r")
    rows = metrics.clocked(json_lines(spark, path, 1).select(rec).select("r.*"), "ts", "2 hours").withColumnRenamed("v", "ts_ms")
    drain(files_writer(only_newer(rows, ttl_ms=hour, buckets=2), out, ckpt).outputMode("append"))
    got = sorted((r.id, r.ts_ms) for r in spark.read.parquet(out).collect())
    assert got == [("a", 2), ("a", 5), ("a", 9), ("b", 1), ("beat", 1), ("beat", 2), ("c", 1)]


def test_first_of_day_over_batches(spark):
    """Many keys of one bucket, one file a batch, late rows of earlier days, several days in one batch."""
    path, out, ckpt = (fresh_path(spark, x) for x in ("in", "out", "ck"))
    files = [[(f"u{i}", "p", i) for i in range(40)] + [("u1", "q", 7)], [(f"u{i}", "p", DAY + i) for i in range(0, 40, 2)] + [("u3", "p", 50_000)],
             [("u1", "p", 12 * DAY), ("u2", "p", 12 * DAY), ("u2", "p", 13 * DAY), ("u4", "p", 11 * DAY + 5)]]
    for batch in files:
        put(spark, path, [{"mid": m, "page": p, "ts": T0 + t} for m, p, t in batch])
    for k in (1, 2):
        put(spark, path, [{"mid": "beat", "ts": T0 + 40 * DAY + k}])
    rec = F.from_json("value", "mid string, page string, ts bigint").alias("r")
    rows = metrics.clocked(json_lines(spark, path, 1).select(rec).select("r.*"), "ts", "3 days").where(live(F.col("mid") != "beat"))
    drain(files_writer(first_of_day(rows, ["mid", "page"], "5 seconds"), out, ckpt).outputMode("append"))
    want = {}
    for m, p, t in (x for batch in files for x in batch):
        want.setdefault((m, p), set()).add(t // DAY)
    expected = []
    for (m, p), days in want.items():
        ordered = sorted(days)
        expected += [(m, p, d, int(k == 0), None if k == 0 else d - ordered[k - 1]) for k, d in enumerate(ordered)]
    got = spark.read.parquet(out).select("mid", "page", ((F.unix_millis("event_time") - T0) / DAY).cast("int").alias("d"), "is_first", "gap_days")
    assert sorted(map(tuple, got.collect()), key=str) == sorted(expected, key=str)


def test_newest_lists_its_entries_once_for_many_generations():
    """A batch of many days has one timer, which removes what is over with one call."""
    import types

    import pandas as pd

    from tidemill.streaming.state import Newest

    calls = {"keys": 0, "timers": 0, "sets": 0}

    class Entries(dict):
        containsKey = dict.__contains__
        getValue = dict.__getitem__

        def updateValue(self, k, v):
            calls["sets"] += 1
            self[k] = v

        def removeKey(self, k):
            del self[k]

        def keys(self):
            calls["keys"] += 1
            return super().keys()

    class Value:
        held = None

        def exists(self):
            return self.held is not None

        def get(self):
            return self.held

        def update(self, v):
            calls["sets"] += 1
            self.held = v

        def clear(self):
            self.held = None

    timers = []
    handle = types.SimpleNamespace(getMapState=lambda *a: Entries(), getValueState=lambda *a: Value(), registerTimer=timers.append)
    newest = Newest("string", 1000)
    newest.init(handle)
    pdf = pd.DataFrame({"id": [f"i{k % 7}" for k in range(300)], "ts_ms": range(300), "event_time": pd.to_datetime([k * 500 for k in range(300)], unit="ms")})
    now = types.SimpleNamespace(getCurrentWatermarkInMs=lambda: 0)
    assert sum(len(p) for p in newest.handleInputRows(None, iter([pdf]), now)) == 300 and timers == [2000]
    half = types.SimpleNamespace(getCurrentWatermarkInMs=lambda: 100_000)
    list(newest.handleExpiredTimer(None, half, types.SimpleNamespace(getExpiryTimeInMs=lambda: timers[0])))
    assert timers == [2000, 101_000] and newest.generations() == set(range(99, 150)) and {g for g, _ in newest.top} == set(range(99, 150))
    late = types.SimpleNamespace(getCurrentWatermarkInMs=lambda: 10_000_000)
    list(newest.handleExpiredTimer(None, late, types.SimpleNamespace(getExpiryTimeInMs=lambda: timers[1])))
    assert calls["keys"] <= 1 and len(timers) == 2 and not newest.top and not newest.generations() and calls["sets"] <= 300 + 2
