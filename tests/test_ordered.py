"""Ordered group operators must equal plain windows, hot groups, null keys and ties included."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemill.operators.ordered import OrderedGroups, falling, places, rising
from tidemill.operators.quantiles import quantile_edges, quintile_scores


@pytest.fixture(scope="module")
def rows(spark):
    return spark.range(6000).selectExpr(
        "id", "case when id % 3 = 0 then 1 when id % 50 = 7 then null else id % 50 end as k",
        "(id * 7919) % 300 as v").cache()


def same(a, b, cols):
    a, b = a.select(*cols), b.select(*cols)
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def groups(rows, order=None):
    return OrderedGroups(rows, ["k"], order or [F.col("v"), F.col("id")], F.col("v"), share=8, slices=64, least=8)


def by_v():
    return Window.partitionBy("k").orderBy("v", "id")


def test_next_and_number(rows):
    want = rows.withColumn("nx", F.lead("id").over(by_v())).withColumn("rn", F.row_number().over(by_v()).cast("bigint"))
    assert same(groups(rows).step("id", "nx", "rn"), want, ["id", "nx", "rn"])


def test_previous(rows):
    assert same(groups(rows).step("id", "pv", back=True), rows.withColumn("pv", F.lag("id").over(by_v())), ["id", "pv"])


def test_rank_with_ties(rows):
    got = OrderedGroups(rows, ["k"], [F.col("v").desc()], -F.col("v"), share=8, slices=64, least=8).rank()
    want = rows.withColumn("rk", F.rank().over(Window.partitionBy("k").orderBy(F.col("v").desc())).cast("bigint"))
    assert same(got, want, ["id", "rk"])


@pytest.mark.parametrize("down", [False, True])
@pytest.mark.parametrize("blocks", [128, 4])
def test_nulls_and_nan_in_the_value_of_a_cut_group(spark, monkeypatch, down, blocks):
    """Null, NaN and infinite values keep their places, in both directions."""
    monkeypatch.setattr("tidemill.operators.ordered.BLOCK", blocks)
    df = spark.range(8000).selectExpr("id", "id % 2 as k", """cast(case when id % 10 = 3 then null when id % 11 = 5 then double('NaN') when id % 97 = 1 then double('Infinity')
        when id % 89 = 1 then double('-Infinity') else (id * 7919) % 500 - 250 end as double) as v""").cache()
    order = F.col("v").desc() if down else F.col("v").asc()
    groups = OrderedGroups(df, ["k"], [order], falling(F.col("v")) if down else rising(F.col("v")), share=8, slices=64, least=8)
    assert groups.sliced.select("k", "_slice").distinct().count() > 30
    want = df.withColumn("rk", F.rank().over(Window.partitionBy("k").orderBy(order)).cast("bigint"))
    assert same(groups.rank(), want, ["id", "rk"])
    tied = [order, F.col("id")]
    numbered = OrderedGroups(df, ["k"], tied, falling(F.col("v")) if down else rising(F.col("v")), share=8, slices=64, least=8).row_number()
    assert same(numbered, df.withColumn("rn", F.row_number().over(Window.partitionBy("k").orderBy(*tied)).cast("bigint")), ["id", "rn"])


def test_running(rows):
    span = by_v().rowsBetween(Window.unboundedPreceding, -1)
    assert same(groups(rows).running_max("id", "m"), rows.withColumn("m", F.max("id").over(span)), ["id", "m"])
    upto = by_v().rowsBetween(Window.unboundedPreceding, 0)
    assert same(groups(rows).running_sum("v", "s"), rows.withColumn("s", F.sum("v").over(upto)), ["id", "s"])


def test_hot_group_really_is_cut(rows):
    og = groups(rows)
    cut = og.sliced.where("_slice >= 0").groupBy("k", "_slice").count()
    assert cut.select("k").distinct().count() == 1
    assert cut.count() > 8


def test_quantiles_match_exact_percentile(rows):
    got = quantile_edges(rows, "v", (0.2, 0.4, 0.6, 0.8)).first()
    want = rows.agg(F.percentile("v", [0.2, 0.4, 0.6, 0.8]).alias("p")).first().p
    assert [round(x, 6) for x in got] == [round(x, 6) for x in want]


def test_quintiles_closed_on_the_right(spark):
    df = spark.createDataFrame([(float(i),) for i in range(1, 11)], "v double")
    got = {r.v: (r.up, r.down) for r in quintile_scores(df, {"up": ("v", False), "down": ("v", True)}).collect()}
    assert [got[float(i)][0] for i in range(1, 11)] == [1, 1, 2, 2, 3, 3, 4, 4, 5, 5]
    assert all(u + d == 6 for u, d in got.values())


def cut_on_all(df, *order):
    cols = [F.col(c.removeprefix("-")).desc() if c.startswith("-") else F.col(c) for c in order]
    groups = OrderedGroups(df, ["k"], cols, places(df, *order), share=8, slices=64, least=8)
    return groups, Window.partitionBy("k").orderBy(*cols)


@pytest.mark.parametrize("ties", ["id", "name", "-name", "clock", "-at", "odd", "-odd"])
def test_one_group_all_ties_in_the_first_key(spark, ties):
    """The group is cut among its ties, by numbers that a double would round, strings, clock times, null and NaN."""
    df = spark.range(4000).selectExpr(
        "id * 7919 % 4000 + 9007199254740992 as id", "1 as k", "cast('2025-07-01 10:00:00' as timestamp) as ts",
        "case when id % 9 = 0 then null else concat(repeat('ä', int(id % 4)), hex(id * 7919 % 4000)) end as name",
        "timestamp_ntz '2025-03-30 00:00:00' + make_interval(0, 0, 0, 0, 0, 0, id * 7.000013) as clock",
        "timestamp_micros(1751328000000000 + id * 7919 % 4000) as at",
        "case when id % 9 = 0 then null when id % 7 = 0 then double('NaN') when id % 11 = 0 then double('Infinity') else double(id % 700) end as odd").cache()
    groups, window = cut_on_all(df, "ts", ties, "id")
    assert groups.sliced.select("_slice").distinct().count() > 20
    want = (df.withColumn("nx", F.lead("id").over(window)) if "-" not in ties else df).withColumn("rn", F.row_number().over(window).cast("bigint"))
    assert same(groups.row_number(), want, ["id", "rn"])
    if "-" not in ties:
        assert same(groups.step("id", "nx", "rn"), want, ["id", "nx", "rn"])
