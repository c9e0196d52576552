"""Logistics reports. Each returns the new rows of the run date; ``operators.merge.idempotent_append`` adds them to
the stored report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.functions.numbers import mean
from tidemill.operators.horizons import horizon_sums
from tidemill.operators.merge import full_outer, share_between, signed_total
from tidemill.plans.logistics_daily import CITY, TRIP, org_city

MODEL = ["truck_model_type", "truck_model_type_name"]


def _stamp(df: DataFrame, d: str) -> DataFrame:
    return df.select(F.lit(d).alias("dt"), "*")


def _one_and_many(t, d, stem: str, keys: list[str], measures: dict[str, str]) -> DataFrame:
    """Sums per key over 1, 7 and 30 days. The n-day table is a sum of the same daily rows, so one pass over them serves all."""
    return horizon_sums(t[f"{stem}_1d"], "dt", d, (1, 7, 30), keys, measures)


ORDERS = {"order_count": "order_count", "order_amount": "order_amount"}


def _averages(df: DataFrame) -> DataFrame:
    trips = F.col("trans_finish_count")
    return (df.withColumn("avg_trans_finish_distance", mean(F.col("trans_finish_distance"), trips))
            .withColumn("avg_trans_finish_dur_sec", mean(F.col("trans_finish_dur_sec"), trips)))


def _trips(t, d, keys: list[str], one: DataFrame) -> DataFrame:
    day = one.where(F.col("dt") == d).select(F.lit(1).alias("recent_days"), *keys, *TRIP)
    many = t["dws_trans_shift_trans_finish_nd"].select("recent_days", *keys, *TRIP)
    return day.unionByName(many).groupBy("recent_days", *keys).agg(*[F.sum(c).alias(c) for c in TRIP])


def ads_city_stats(t, d) -> DataFrame:
    """city x {1, 7, 30}: orders next to transport, whichever is known (T-A1)."""
    orders = _one_and_many(t, d, "dws_trade_org_cargo_type_order", CITY, ORDERS)
    trips = _trips(t, d, CITY, org_city(t["dws_trans_org_truck_model_type_trans_finish_1d"], t))
    return _stamp(_averages(full_outer([orders, trips], ["recent_days", *CITY])), d)


def ads_org_stats(t, d) -> DataFrame:
    """organisation x {1, 7, 30}: orders next to transport (T-A1); full outer at every horizon."""
    keys = ["org_id", "org_name"]
    orders = _one_and_many(t, d, "dws_trade_org_cargo_type_order", keys, ORDERS)
    trips = _trips(t, d, keys, t["dws_trans_org_truck_model_type_trans_finish_1d"])
    return _stamp(_averages(full_outer([orders, trips], ["recent_days", *keys])), d)


def ads_driver_stats(t, d) -> DataFrame:
    """driver x {7, 30}: two drivers of a trip share its distance and time; trips and delays count for both (T-A2)."""
    rows = t["dws_trans_shift_trans_finish_nd"].select(
        "recent_days", "driver1_emp_id", "driver1_name", "driver2_emp_id", "driver2_name", *TRIP,
        "trans_finish_delay_count")
    people = share_between(rows, [("driver1_emp_id", "driver1_name"), ("driver2_emp_id", "driver2_name")],
                           ["trans_finish_distance", "trans_finish_dur_sec"], ("driver_emp_id", "driver_name"))
    total = people.groupBy("recent_days", "driver_emp_id", "driver_name").agg(
        *[F.sum(c).alias(c) for c in TRIP], F.sum("trans_finish_delay_count").alias("trans_finish_late_count"))
    return _stamp(_averages(total), d)


def _express(t, d, keys: list[str]) -> DataFrame:
    """deliver, sort and receive sides merged on coalesced keys, so a place known to two of them is one row (T-A3)."""
    deliver = _one_and_many(t, d, "dws_trans_org_deliver_suc", keys, {"deliver_suc_count": "order_count"})
    sort = _one_and_many(t, d, "dws_trans_org_sort", keys, {"sort_count": "sort_count"})
    receive = _one_and_many(t, d, "dws_trans_org_receive", keys, {
        "receive_order_count": "order_count", "receive_order_amount": "order_amount"})
    return _stamp(full_outer([deliver, sort, receive], ["recent_days", *keys]), d)


def ads_express_city_stats(t, d) -> DataFrame:
    return _express(t, d, CITY)


def ads_express_org_stats(t, d) -> DataFrame:
    return _express(t, d, ["org_id", "org_name"])


def ads_express_province_stats(t, d) -> DataFrame:
    return _express(t, d, ["province_id", "province_name"])


def ads_express_stats(t, d) -> DataFrame:
    """National deliveries and sorts x {1, 7, 30} (T-A4)."""
    deliver = _one_and_many(t, d, "dws_trans_org_deliver_suc", [], {"deliver_suc_count": "order_count"})
    sort = _one_and_many(t, d, "dws_trans_org_sort", [], {"sort_count": "sort_count"})
    return _stamp(full_outer([deliver, sort], ["recent_days"]), d)


def _shift_sums(t, keys: list[str], cols: list[str]) -> DataFrame:
    return t["dws_trans_shift_trans_finish_nd"].groupBy("recent_days", *keys).agg(*[F.sum(c).alias(c) for c in cols])


def ads_line_stats(t, d) -> DataFrame:
    """line x {7, 30} (T-A5)."""
    return _stamp(_shift_sums(t, ["line_id", "line_name"], [*TRIP, "trans_finish_order_count"]), d)


def ads_shift_stats(t, d) -> DataFrame:
    """shift x {7, 30}, one row per crew and truck as in the source table (T-A5)."""
    return _stamp(t["dws_trans_shift_trans_finish_nd"].select(
        "recent_days", "shift_id", *TRIP, "trans_finish_order_count"), d)


def ads_order_stats(t, d) -> DataFrame:
    """All orders x {1, 7, 30} (T-A6)."""
    return _stamp(_one_and_many(t, d, "dws_trade_org_cargo_type_order", [], ORDERS), d)


def ads_order_cargo_type_stats(t, d) -> DataFrame:
    """cargo type x {1, 7, 30} (T-A6)."""
    return _stamp(_one_and_many(t, d, "dws_trade_org_cargo_type_order", ["cargo_type", "cargo_type_name"], ORDERS), d)


def ads_trans_order_stats(t, d) -> DataFrame:
    """Received next to dispatched orders x {1, 7, 30} (T-A7)."""
    receive = _one_and_many(t, d, "dws_trans_org_receive", [], {
        "receive_order_count": "order_count", "receive_order_amount": "order_amount"})
    dispatch = horizon_sums(t["dws_trans_dispatch_1d"], "dt", d, (1, 7, 30), [], {
        "dispatch_order_count": "order_count", "dispatch_order_amount": "order_amount"})
    return _stamp(full_outer([receive, dispatch], ["recent_days"]), d)


def ads_trans_order_stats_td(t, d) -> DataFrame:
    """Orders on the road: dispatched minus finished (T-A8)."""
    rows = signed_total(t["dws_trans_dispatch_td"], t["dws_trans_bound_finish_td"], [], ["order_count", "order_amount"])
    return _stamp(rows.withColumnsRenamed({"order_count": "bounding_order_count",
                                           "order_amount": "bounding_order_amount"}), d)


def ads_trans_stats(t, d) -> DataFrame:
    """All trips x {1, 7, 30} (T-A9)."""
    return _stamp(_trips(t, d, [], t["dws_trans_org_truck_model_type_trans_finish_1d"]), d)


def ads_truck_stats(t, d) -> DataFrame:
    """truck model type x {7, 30} with averages (T-A9)."""
    return _stamp(_averages(_shift_sums(t, MODEL, TRIP)), d)
