"""Retail daily aggregates (1d), their n-day and to-date roll-ups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.functions.numbers import or_zero
from tidemill.operators.dims import lookup
from tidemill.operators.horizons import horizon_wide
from tidemill.operators.todate import to_date_init, to_date_merge
from tidemill.plans.retail_dims import SKU_NAMES

PLACE = ["province_name", "area_code", "iso_code", "iso_3166_2"]
AMOUNTS = ["order_original_amount", "activity_reduce_amount", "coupon_reduce_amount", "order_total_amount"]


def _amounts() -> list:
    return [F.sum("split_original_amount").alias("order_original_amount_1d"),
            F.sum(or_zero(F.col("split_activity_amount"))).alias("activity_reduce_amount_1d"),
            F.sum(or_zero(F.col("split_coupon_amount"))).alias("coupon_reduce_amount_1d"),
            F.sum("split_total_amount").alias("order_total_amount_1d")]


def dws_interaction_sku_favor_add_1d(t, d) -> DataFrame:
    """(sku) -> favourites of the day (B11); counted before the dimension is joined."""
    counts = t["dwd_interaction_favor_add_inc"].groupBy("sku_id").agg(F.count(F.lit(1)).alias("favor_add_count_1d"))
    return lookup(counts, t["dim_sku_full"], "sku_id", "id", {c: c for c in SKU_NAMES})


def dws_tool_user_coupon_coupon_used_1d(t, d) -> DataFrame:
    """(user, coupon, day) -> uses."""
    counts = t["dwd_tool_coupon_used_inc"].groupBy(F.col("date_id").alias("ds"), "user_id", "coupon_id").agg(
        F.count(F.lit(1)).alias("used_count_1d"))
    return lookup(counts, t["dim_coupon_full"], "coupon_id", "id", {
        c: c for c in ("coupon_name", "coupon_type_code", "coupon_type_name", "benefit_rule")})


def dws_trade_province_order_1d(t, d) -> DataFrame:
    """(province, day) -> orders and amounts."""
    facts = t["dwd_trade_order_detail_inc"].groupBy("province_id", "ds").agg(
        F.count_distinct("order_id").alias("order_count_1d"), *_amounts())
    return lookup(facts, t["dim_province_full"], "province_id", "id", {c: c for c in PLACE})


def dws_trade_province_order_users_1d(t, d) -> DataFrame:
    """(province, day) -> order lines, distinct users and amounts (M6)."""
    facts = t["dwd_trade_order_detail_inc"].groupBy("province_id", "ds").agg(
        F.count(F.lit(1)).alias("order_count_1d"), F.count_distinct("user_id").alias("order_user_num_1d"), *_amounts())
    return lookup(facts, t["dim_province_full"], "province_id", "id", {c: c for c in PLACE})


def dws_trade_user_cart_add_1d(t, d) -> DataFrame:
    """(user, day) -> cart additions and items."""
    return t["dwd_trade_cart_add_inc"].groupBy("user_id", "ds").agg(
        F.count(F.lit(1)).alias("cart_add_count_1d"), F.sum("sku_num").alias("cart_add_num_1d"))


def dws_trade_user_order_1d(t, d) -> DataFrame:
    """(user, day) -> orders, items and amounts."""
    return t["dwd_trade_order_detail_inc"].groupBy("user_id", "ds").agg(
        F.count_distinct("order_id").alias("order_count_1d"), F.sum("sku_num").alias("order_num_1d"), *_amounts())


def dws_trade_user_payment_1d(t, d) -> DataFrame:
    """(user, day) -> paid orders, items and amount."""
    return t["dwd_trade_pay_detail_suc_inc"].groupBy("user_id", "ds").agg(
        F.count_distinct("order_id").alias("payment_count_1d"), F.sum("sku_num").alias("payment_num_1d"),
        F.sum("split_payment_amount").alias("payment_amount_1d"))


def dws_trade_user_pay_1d(t, d) -> DataFrame:
    """(user, day) -> payment lines, items and amount (M9)."""
    return t["dwd_trade_pay_detail_suc_inc"].groupBy("user_id", "ds").agg(
        F.sum("sku_num").alias("payment_suc_sku_num_1d"), F.count(F.lit(1)).alias("payment_suc_count_1d"),
        F.sum("split_payment_amount").alias("payment_suc_amount_1d"))


def dws_trade_user_sku_order_1d(t, d) -> DataFrame:
    """(user, sku, day) -> lines, items and amounts with category and brand names."""
    facts = t["dwd_trade_order_detail_inc"].groupBy("ds", "user_id", "sku_id").agg(
        F.count(F.lit(1)).alias("order_count_1d"), F.sum("sku_num").alias("order_num_1d"), *_amounts())
    return lookup(facts, t["dim_sku_full"], "sku_id", "id", {c: c for c in SKU_NAMES})


def dws_traffic_page_visitor_page_view_1d(t, d) -> DataFrame:
    """(visitor, page) of the day -> time and views."""
    return t["dwd_traffic_page_view_inc"].where(F.col("ds") == d).groupBy(
        "mid_id", "brand", "model", "operate_system", "page_id", "ds").agg(
        F.sum("during_time").alias("during_time_1d"), F.count(F.lit(1)).alias("view_count_1d"))


def dws_traffic_session_page_view_1d(t, d) -> DataFrame:
    """(session) -> time and pages, for every day present."""
    return t["dwd_traffic_page_view_inc"].groupBy(
        "session_id", "mid_id", "brand", "model", "operate_system", "version_code", "channel", "ds").agg(
        F.sum("during_time").alias("during_time_1d"), F.count(F.lit(1)).alias("page_count_1d"))


def dws_trade_province_order_nd(t, d) -> DataFrame:
    """province -> 7 and 30 day measures in one pass."""
    return horizon_wide(t["dws_trade_province_order_1d"], "ds", d, (7, 30), ["province_id", *PLACE],
                        {m: f"{m}_1d" for m in ["order_count", *AMOUNTS]})


def dws_trade_user_sku_order_nd(t, d) -> DataFrame:
    """(user, sku) -> 7 and 30 day measures in one pass."""
    return horizon_wide(t["dws_trade_user_sku_order_1d"], "ds", d, (7, 30), ["user_id", "sku_id", *SKU_NAMES],
                        {m: f"{m}_1d" for m in ["order_count", "order_num", *AMOUNTS]})


ORDER_TD = {"order_count_td": "order_count_1d", "order_num_td": "order_num_1d",
            "original_amount_td": "order_original_amount_1d",
            "activity_reduce_amount_td": "activity_reduce_amount_1d",
            "coupon_reduce_amount_td": "coupon_reduce_amount_1d", "total_amount_td": "order_total_amount_1d"}


def dws_trade_user_order_td(t, d) -> DataFrame:
    """Lifetime orders per user, full build."""
    return to_date_init(t["dws_trade_user_order_1d"], "user_id", "ds", "order_date_first", "order_date_last", ORDER_TD)


def dws_trade_user_order_td_merge(t, d) -> DataFrame:
    """Lifetime orders per user, one day merged into yesterday's table."""
    today = t["dws_trade_user_order_1d"].where(F.col("ds") == d)
    return to_date_merge(t["dws_trade_user_order_td"], today, d, "user_id", "order_date_first", "order_date_last",
                         ORDER_TD)


def dws_user_user_login_td(t, d) -> DataFrame:
    """user -> last login, first date, logins (B23); users who never logged in count their registration."""
    logins = t["dwd_user_login_inc"].where(F.col("ds") <= d).groupBy("user_id").agg(
        F.max("ds").alias("_last"), F.count(F.lit(1)).alias("_n"))
    born = F.substring("create_time", 1, 10)
    users = t["dim_user_zip"].select(F.col("id").alias("_u"), born.alias("login_date_first"))
    return users.join(logins, F.col("_u") == F.col("user_id"), "left").select(
        F.col("_u").alias("user_id"), F.coalesce("_last", "login_date_first").alias("login_date_last"),
        "login_date_first", F.coalesce("_n", F.lit(1)).alias("login_count_td"))


def dws_user_user_login_td_merge(t, d) -> DataFrame:
    """Yesterday's login table merged with the day's logins."""
    today = t["dwd_user_login_inc"].where(F.col("ds") == d).groupBy("user_id").agg(
        F.count(F.lit(1)).alias("login_count_1d"))
    return to_date_merge(t["dws_user_user_login_td"], today, d, "user_id", "login_date_first", "login_date_last",
                         {"login_count_td": "login_count_1d"})


def dws_trade_province_order_users_nd(t, d) -> DataFrame:
    """province -> 7/30 day sums plus distinct users from the fact (M7).

    Sums come from the daily table, users from one pass over the fact: a user is counted once per horizon.
    """
    wide = horizon_wide(t["dws_trade_province_order_users_1d"], "ds", d, (7, 30), ["province_id", *PLACE],
                        {m: f"{m}_1d" for m in ["order_count", *AMOUNTS]})
    return wide.join(province_users(t, d, {"user_count_7d": 7, "user_count_30d": 30}), "province_id")


def province_users(t, d, horizons: dict[str, int]) -> DataFrame:
    """Distinct users per province and horizon: one row per (province, user) with the last day, then counts."""
    from tidemill.functions.dates import horizon_start
    from tidemill.operators.horizons import in_last
    recent = in_last(t["dwd_trade_order_detail_inc"], "ds", d, max(horizons.values()))
    seen = recent.groupBy("province_id", "user_id").agg(F.max("ds").alias("_last"))
    return seen.groupBy("province_id").agg(*[
        F.count(F.when(F.col("_last") >= horizon_start(d, n), F.lit(1))).alias(out) for out, n in horizons.items()])
