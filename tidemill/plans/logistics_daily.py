"""Logistics daily, n-day and to-date aggregates. An order's amount repeats on each cargo, so it is reduced to one
row per order before anything is summed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.functions.numbers import sum_if
from tidemill.operators.dims import by_level, lookup, region_parents
from tidemill.operators.horizons import horizon_sums

CITY = ["city_id", "city_name"]
PLACE = ["org_id", "org_name", *CITY, "province_id", "province_name"]


def _per_order(fact: DataFrame, keys: list[str]) -> DataFrame:
    return fact.groupBy("order_id", *keys, "dt").agg(F.max("amount").alias("amount"))


def _org_of(df: DataFrame, t, district: str) -> DataFrame:
    return lookup(df, t["dim_organ_full"], district, "region_id", {"org_id": "id", "org_name": "org_name"})


def _with_place(df: DataFrame, t, district: str) -> DataFrame:
    """Organisation serving a district with its city and province."""
    df = region_parents(_org_of(df, t, district), t["dim_region_full"], district, 3)
    served = F.col("org_id").isNotNull()
    for i, level in ((1, "city"), (2, "province")):
        for part in ("id", "name"):
            df = df.withColumn(f"{level}_{part}", F.when(served, F.col(f"r{i}_{part}")))
    return df


def dws_trade_org_cargo_type_order_1d(t, d) -> DataFrame:
    """(organisation, city, cargo type, day) -> orders and amount (T-S1)."""
    orders = _per_order(t["dwd_trade_order_detail"], ["cargo_type", "cargo_type_name", "sender_district_id",
                                                      "sender_city_id"])
    # one row per district first: the organisation is looked up for groups, not for orders
    by_district = orders.groupBy("sender_district_id", F.col("sender_city_id").alias("city_id"), "cargo_type",
                                 "cargo_type_name", "dt").agg(
        F.count("order_id").alias("order_count"), F.sum("amount").alias("order_amount"))
    rows = _org_of(by_district, t, "sender_district_id").groupBy(
        "org_id", "org_name", "city_id", "cargo_type", "cargo_type_name", "dt").agg(
        F.sum("order_count").alias("order_count"), F.sum("order_amount").alias("order_amount"))
    return lookup(rows, t["dim_region_full"], "city_id", "id", {"city_name": "name"})


def dws_trans_dispatch_1d(t, d) -> DataFrame:
    """day -> dispatched orders and amount (T-S2)."""
    return _per_order(t["dwd_trans_dispatch_detail"], []).groupBy("dt").agg(
        F.count("order_id").alias("order_count"), F.sum("amount").alias("order_amount"))


def dws_trans_org_deliver_suc_1d(t, d) -> DataFrame:
    """(organisation, city, province, day) -> delivered orders (T-S3)."""
    orders = t["dwd_trans_deliver_suc_detail"].select("order_id", "receiver_district_id", "dt").distinct()
    counts = orders.groupBy("receiver_district_id", "dt").agg(F.count("order_id").alias("order_count"))
    return _with_place(counts, t, "receiver_district_id").groupBy(*PLACE, "dt").agg(
        F.sum("order_count").alias("order_count"))


def dws_trans_org_receive_1d(t, d) -> DataFrame:
    """(organisation, city, province, day) -> received orders and amount (T-S4)."""
    orders = _per_order(t["dwd_trans_receive_detail"], ["sender_district_id"])
    counts = orders.groupBy("sender_district_id", "dt").agg(
        F.count("order_id").alias("order_count"), F.sum("amount").alias("order_amount"))
    return _with_place(counts, t, "sender_district_id").groupBy(*PLACE, "dt").agg(
        F.sum("order_count").alias("order_count"), F.sum("order_amount").alias("order_amount"))


def _org_levels(df: DataFrame, t, levels: int) -> DataFrame:
    df = lookup(df, t["dim_organ_full"], "org_id", "id", {"_level": "org_level", "_region": "region_id"})
    return region_parents(df, t["dim_region_full"], "_region", levels)


def _city(part: str):
    return by_level(F.col("_level"), f"r0_{part}", f"r1_{part}").alias(f"city_{part}")


def dws_trans_org_sort_1d(t, d) -> DataFrame:
    """(organisation, day) -> sorted parcels with the organisation's city and province (T-S5)."""
    counts = t["dwd_bound_sort"].groupBy("org_id", "dt").agg(F.count(F.lit(1)).alias("sort_count"))
    rows = lookup(_org_levels(counts, t, 3), t["dim_organ_full"], "org_id", "id", {"org_name": "org_name"})
    level = F.col("_level")
    return rows.select("org_id", "org_name", _city("id"), _city("name"),
                       by_level(level, "r1_id", "r2_id").alias("province_id"),
                       by_level(level, "r1_name", "r2_name").alias("province_name"), "sort_count", "dt")


def dws_trans_org_truck_model_type_trans_finish_1d(t, d) -> DataFrame:
    """(organisation, truck model type, day) -> trips, distance, seconds (T-S6)."""
    per_truck = t["dwd_trans_trans_finish"].groupBy(
        F.col("start_org_id").alias("org_id"), F.col("start_org_name").alias("org_name"), "truck_id", "dt").agg(
        F.count("id").alias("trans_finish_count"), F.sum("actual_distance").alias("trans_finish_distance"),
        F.sum("finish_dur_sec").alias("trans_finish_dur_sec"))
    rows = lookup(per_truck, t["dim_truck_full"], "truck_id", "id", {
        "truck_model_type": "truck_model_type", "truck_model_type_name": "truck_model_type_name"})
    return rows.groupBy("org_id", "org_name", "truck_model_type", "truck_model_type_name", "dt").agg(
        *[F.sum(c).alias(c) for c in ("trans_finish_count", "trans_finish_distance", "trans_finish_dur_sec")])


def _nd(t, d, table: str, keys: list[str], measures: list[str]) -> DataFrame:
    return horizon_sums(t[table], "dt", d, (7, 30), keys, {m: m for m in measures})


def dws_trade_org_cargo_type_order_nd(t, d) -> DataFrame:
    return _nd(t, d, "dws_trade_org_cargo_type_order_1d", ["org_id", "org_name", *CITY, "cargo_type",
                                                           "cargo_type_name"], ["order_count", "order_amount"])


def dws_trans_dispatch_nd(t, d) -> DataFrame:
    return _nd(t, d, "dws_trans_dispatch_1d", [], ["order_count", "order_amount"])


def dws_trans_org_deliver_suc_nd(t, d) -> DataFrame:
    return _nd(t, d, "dws_trans_org_deliver_suc_1d", PLACE, ["order_count"])


def dws_trans_org_receive_nd(t, d) -> DataFrame:
    return _nd(t, d, "dws_trans_org_receive_1d", PLACE, ["order_count", "order_amount"])


def dws_trans_org_sort_nd(t, d) -> DataFrame:
    return _nd(t, d, "dws_trans_org_sort_1d", PLACE, ["sort_count"])


TRIP = ["trans_finish_count", "trans_finish_distance", "trans_finish_dur_sec"]
SHIFT_KEYS = ["shift_id", "line_id", "org_id", "org_name", "driver1_emp_id", "driver1_name", "driver2_emp_id",
              "driver2_name", "truck_id"]


def dws_trans_shift_trans_finish_nd(t, d) -> DataFrame:
    """(shift, crew, truck) x {7, 30} -> trips, distance, seconds, orders, late trips (T-N2).

    Trips are summed per day and shift first; only those rows are looked up and copied per horizon.
    """
    daily = t["dwd_trans_trans_finish"].withColumnsRenamed({"start_org_id": "org_id", "start_org_name": "org_name"}) \
        .groupBy(*SHIFT_KEYS, "dt").agg(
        F.count("id").alias("trans_finish_count"), F.sum("actual_distance").alias("trans_finish_distance"),
        F.sum("finish_dur_sec").alias("trans_finish_dur_sec"), F.sum("order_num").alias("trans_finish_order_count"),
        sum_if(F.col("actual_end_time") > F.col("estimate_end_time"), 1).alias("trans_finish_delay_count"))
    measures = [*TRIP, "trans_finish_order_count", "trans_finish_delay_count"]
    rows = horizon_sums(daily, "dt", d, (7, 30), SHIFT_KEYS, {m: m for m in measures})
    rows = lookup(rows, t["dim_shift_full"], "shift_id", "id", {"line_name": "line_name"})
    rows = lookup(rows, t["dim_truck_full"], "truck_id", "id", {
        "truck_model_type": "truck_model_type", "truck_model_type_name": "truck_model_type_name"})
    return _org_levels(rows, t, 2).select(
        "shift_id", _city("id"), _city("name"), "org_id", "org_name", "line_id", "line_name", "driver1_emp_id",
        "driver1_name", "driver2_emp_id", "driver2_name", "truck_model_type", "truck_model_type_name", "recent_days",
        *measures)


def dws_trans_bound_finish_td(t, d) -> DataFrame:
    """All finished orders and their amount (T-N3): one row per order over its whole life."""
    orders = t["dwd_trans_bound_finish_detail"].where(F.col("dt") <= d).groupBy("order_id").agg(
        F.max("amount").alias("amount"))
    return orders.agg(F.count("order_id").alias("order_count"), F.sum("amount").alias("order_amount"))


def dws_trans_dispatch_td(t, d) -> DataFrame:
    """All dispatched orders and their amount (T-N3)."""
    return t["dws_trans_dispatch_1d"].where(F.col("dt") <= d).agg(
        F.sum("order_count").alias("order_count"), F.sum("order_amount").alias("order_amount"))


def org_city(df: DataFrame, t) -> DataFrame:
    """City of each row's organisation, whatever its level."""
    rows = _org_levels(df, t, 2)
    return rows.select(*df.columns, _city("id"), _city("name"))
