"""Warehouse operators on tiny tables."""

import pytest
from pyspark.sql import functions as F

from tidemill.functions import dates, masks, numbers, rules, text
from tidemill.functions.dates import OPEN_DATE
from tidemill.operators import dedup, horizons, merge, ranking, scd2, snapshots, todate


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


@pytest.fixture(scope="module")
def daily(spark):
    data = [(u, f"2025-06-{d:02d}", d * u) for u in (1, 2, 3) for d in range(1, 31) if d % u == 0]
    return spark.createDataFrame(data, "u int, ds string, n int")


def test_horizon_forms_agree(daily):
    d = "2025-06-30"
    copies = horizons.multi_horizon(daily, "ds", d, (1, 7, 30), ["u"], [F.sum("n").alias("n")])
    classes = horizons.horizon_sums(daily, "ds", d, (1, 7, 30), ["u"], {"n": "n"})
    assert rows(copies, "recent_days", "u", "n") == rows(classes, "recent_days", "u", "n")
    wide = horizons.horizon_wide(daily, "ds", d, (7, 30), ["u"], {"n": "n"})
    tall = horizons.unfold_horizons(wide, ["u"], (7, 30), {"n": "n"})
    assert rows(tall, "recent_days", "u", "n") == rows(classes.where("recent_days > 1"), "recent_days", "u", "n")


def test_horizon_distinct_counts_each_id_once(spark):
    df = spark.createDataFrame([("a", 1, "2025-06-30"), ("a", 1, "2025-06-29"), ("a", 2, "2025-06-01"), ("a", None, "2025-06-30")],
                               "k string, id int, ds string")
    got = horizons.horizon_distinct(df, "ds", "2025-06-30", (1, 7, 30), ["k"], "id", {"ids": None})
    assert rows(got, "recent_days", "ids") == [(1, 1), (7, 1), (30, 2)]


def test_to_date_fold_equals_full_build(daily):
    sums = {"total": "n"}
    table = todate.to_date_init(daily.where("ds <= '2025-06-27'"), "u", "ds", "first", "last", sums)
    for day in ("2025-06-28", "2025-06-29", "2025-06-30"):
        table = todate.to_date_merge(table, daily.where(F.col("ds") == day), day, "u", "first", "last", sums)
    full = todate.to_date_init(daily, "u", "ds", "first", "last", sums)
    assert rows(table, "u", "first", "last", "total") == rows(full, "u", "first", "last", "total")


@pytest.mark.parametrize("offset, closed", [(0, "2025-07-01"), (1, "2025-06-30")])
def test_scd2_merge(spark, offset, closed):
    base = scd2.scd2_init(spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string"), "2025-01-01")
    changes = spark.createDataFrame([(1, "x", 1), (1, "y", 2), (9, "new", 1)], "id int, v string, seq int")
    got = scd2.scd2_merge(base, changes, "2025-07-01", "id", ["seq"], offset)
    assert rows(got, "id", "v", "start_date", "end_date") == [
        (1, "a", "2025-01-01", closed), (1, "y", "2025-07-01", OPEN_DATE), (2, "b", "2025-01-01", OPEN_DATE),
        (9, "new", "2025-07-01", OPEN_DATE)]
    assert got.where(F.col("end_date") == OPEN_DATE).groupBy("id").count().where("count <> 1").count() == 0


def test_snapshot_daily_equals_full(spark):
    orders = spark.createDataFrame([(1, "u", "2025-07-01 08:00:00", 10), (2, "u", "2025-07-02 08:00:00", 20)],
                                   "order_id int, user_id string, order_time string, total_amount int")
    log = spark.createDataFrame([(1, "1002", "2025-07-01 09:00:00"), (1, "1006", "2025-07-02 10:00:00"),
                                 (2, "1002", "2025-07-02 09:00:00")], "order_id int, order_status string, create_time string")
    keep = ["user_id", "order_time"]
    full = snapshots.snapshot_init(orders, log, keep)
    first = snapshots.snapshot_init(orders.where("order_id = 1"), log.where("create_time < '2025-07-02'"), keep)
    assert rows(first, "order_id", "ds", "payment_amount") == [(1, OPEN_DATE, 10)]
    merged = snapshots.snapshot_merge(first, orders.where("order_id = 2"), log.where("create_time >= '2025-07-02'"), keep)
    cols = ["order_id", "payment_time", "payment_amount", "ds"]
    assert rows(merged, *cols) == rows(full, *cols)
    assert [r[3] for r in rows(merged, *cols)] == ["2025-07-02", OPEN_DATE]


def test_full_outer_merges_keys_known_to_two_late_sides(spark):
    a = spark.createDataFrame([("x", 1), (None, 7)], "k string, a int")
    b = spark.createDataFrame([("y", 2)], "k string, b int")
    c = spark.createDataFrame([("y", 3), (None, 9)], "k string, c int")
    got = merge.full_outer([a, b, c], ["k"]).collect()
    assert {tuple(r) for r in got} == {("x", 1, None, None), ("y", None, 2, 3), (None, 7, None, 9)}


def test_shared_trip_keeps_equal_rows(spark):
    trips = spark.createDataFrame([(1, "a", None, None, 10.0, 1), (1, "a", 2, "b", 10.0, 1), (1, "a", 2, "b", 10.0, 1)],
                                  "i1 int, n1 string, i2 int, n2 string, km double, late int")
    got = merge.share_between(trips, [("i1", "n1"), ("i2", "n2")], ["km"], ("id", "name"))
    assert rows(got.groupBy("id").agg(F.sum("km").alias("km"), F.sum("late").alias("late")), "id", "km", "late") == [
        (1, 20.0, 3), (2, 10.0, 2)]


def test_idempotent_append(spark):
    old, new = spark.range(3), spark.range(2, 5)
    once = merge.idempotent_append(old, new)
    assert rows(merge.idempotent_append(once, new), "id") == rows(once, "id") == [(i,) for i in range(5)]


def test_latest_and_top_with_a_hot_key(spark):
    df = spark.range(3000).selectExpr("id", "case when id % 3 = 0 then 'hot' else cast(id % 40 as string) end as k")
    assert dict(ranking.latest_per_key(df, ["k"], ["id"]).select("k", "id").collect())["hot"] == 2997
    top = ranking.top_n(df, ["k"], [F.col("id").desc()], 3)
    assert rows(top.where("k = 'hot'"), "id", "rn") == [(2991, 3), (2994, 2), (2997, 1)]


def test_share_of_total_counts_null_groups(spark):
    df = spark.createDataFrame([(None, 1), (None, 3), ("a", 5)], "k string, n int")
    assert sorted(r.t for r in ranking.with_group_total(df, ["k"], "n", "t").collect()) == [4, 4, 5]


def test_consecutive_days(spark):
    df = spark.createDataFrame([("in", f"2025-06-{d}") for d in (25, 26, 27)] + [("gap", f"2025-06-{d}") for d in (21, 23, 24, 26, 27)]
                               + [("old", f"2025-06-{d}") for d in (19, 20, 21)], "u string, ds string")
    assert rows(dedup.consecutive_days(df, "u", "2025-06-27"), "u") == [("in",)]


def test_new_flag_repair(spark):
    df = spark.createDataFrame([("m", "2025-06-01 10:00:00", "1"), ("m", "2025-06-01 11:00:00", "1"),
                                ("m", "2025-06-02 10:00:00", "1"), ("o", "2025-06-01 10:00:00", "0"),
                                ("o", "2025-06-01 12:00:00", "1")], "mid string, ts string, f string")
    got = dedup.repaired_new_flag(df.withColumn("ts", F.col("ts").cast("timestamp")), "mid", "ts", "f")
    assert [r.f for r in got.orderBy("mid", "ts").collect()] == ["1", "1", "0", "0", "0"]


def test_retractions_are_null_safe(spark):
    df = spark.createDataFrame([("a", 1, None), ("a", 2, 5), ("a", 3, 7), ("b", 1, 2)], "id string, v int, x int")
    got = dedup.with_retractions(df, "id", [F.col("v")], F.col("v"), ["x"])
    assert dict(got.groupBy("id").agg(F.sum("x")).collect()) == {"a": 7, "b": 2}


def test_only_newer(spark):
    df = spark.createDataFrame([("a", 1, 10), ("a", 2, 9), ("a", 3, 10), ("a", 4, 11)], "id string, at int, v int")
    assert rows(dedup.only_newer(df, "id", "v", ["at"]), "at") == [(1,), (4,)]


def test_scalars(spark):
    one = spark.range(1)

    def value(col):
        return one.select(col.alias("x")).first().x

    assert value(masks.keep_three(F.lit("13812345678"))) == "138*"
    assert value(masks.hashed_phone(F.lit("12345"))) is None
    assert value(masks.mail_domain(F.lit("a@b.c"))) == "*@b.c" and value(masks.mail_domain(F.lit("nomail"))) is None
    assert value(dates.event_millis(F.lit("1700000000"))) == 1700000000000 and value(dates.event_millis(F.lit("x"))) == 0
    assert value(dates.span_label(F.lit("2025-07-07"), 7)) == "2025-07-01至2025-07-07"
    assert [r.day for r in dates.date_spine(spark, "2025-02-27", "2025-03-01").collect()] == [20250227, 20250228, 20250301]
    assert value(numbers.ratio(F.lit(1), F.lit(8))) == __import__("decimal").Decimal("0.13")
    assert value(numbers.ratio(F.lit(1), F.lit(0))) is None
    assert value(text.words(F.lit("Red-Widget 5,été"))) == ["red", "widget", "5", "été"]
    assert len(value(masks.hash_bucket(F.lit("k"), 7))) == 4
    code = spark.createDataFrame([("3101", "100", "10", "2", "8")], "t string, condition_amount string, benefit_amount string, "
                                 "condition_num string, benefit_discount string")
    assert code.select(rules.activity_benefit(F.col("t"))).first()[0] == "满100元减10元"


def test_moderation_reads_the_last_token(spark):
    df = spark.createDataFrame([(1, "a,bad"), (2, "bad,a"), (3, "bad")], "id int, txt string")
    got = text.moderated(df, "txt", spark.createDataFrame([("bad",)], "word string"))
    assert rows(got, "id", "is_violation") == [(1, 1), (2, 0), (3, 1)]


def test_retractions_read_their_input_once(spark, tmp_path):
    path = str(tmp_path / "versions")
    spark.createDataFrame([("a", 1, 5), ("a", 2, None), ("b", 1, 7), (None, 1, 2), (None, 3, 4)], "id string, v int, x int").write.parquet(path)
    df = spark.read.parquet(path)
    got = dedup.with_retractions(df, "id", [F.col("v")], F.col("v"), ["x"])
    assert not [f for f in got.inputFiles() if path in f]
    assert sorted(map(str, (tuple(r) for r in got.collect()))) == sorted(map(str, [
        ("a", 1, 5), ("a", 1, -5), ("a", 2, None), ("b", 1, 7), (None, 1, 2), (None, 1, -2), (None, 3, 4)]))
