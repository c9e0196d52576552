"""Retail reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.functions.dates import OPEN_DATE, horizon_start, seconds_between, shift
from tidemill.functions.numbers import count_if, distinct_if, ratio, sum_if
from tidemill.operators.dedup import consecutive_days
from tidemill.operators.dims import lookup
from tidemill.operators.horizons import explode_horizons, in_last, unfold_horizons
from tidemill.operators.merge import one_row
from tidemill.operators.ordered import OrderedGroups, places
from tidemill.operators.ranking import top_n
from tidemill.plans.retail_daily import PLACE, province_users

CATEGORY = [f"category{i}_{c}" for i in (1, 2, 3) for c in ("id", "name")]


def _dated(df: DataFrame, d: str) -> DataFrame:
    return df.select(F.lit(d).alias("dt"), "*")


def ads_coupon_stats(t, d) -> DataFrame:
    """coupon -> uses and using users of the day."""
    used = t["dws_tool_user_coupon_coupon_used_1d"].where(F.col("ds") == d)
    return _dated(used.groupBy("coupon_id", "coupon_name").agg(
        F.sum("used_count_1d").cast("bigint").alias("used_count"), F.count(F.lit(1)).alias("used_user_count")), d)


def ads_order_by_province(t, d) -> DataFrame:
    """province x {1, 7, 30} -> orders and amount."""
    one = t["dws_trade_province_order_1d"].where(F.col("ds") == d).select(
        F.lit(1).alias("recent_days"), "province_id", *PLACE, F.col("order_count_1d").alias("order_count"),
        F.col("order_total_amount_1d").alias("order_total_amount"))
    many = unfold_horizons(t["dws_trade_province_order_nd"], ["province_id", *PLACE], (7, 30),
                           {"order_count": "order_count", "order_total_amount": "order_total_amount"})
    return _dated(one.unionByName(many).distinct(), d)


def ads_order_continuously_user_count(t, d) -> DataFrame:
    """Users who ordered on three consecutive days of the last seven."""
    hits = consecutive_days(t["dws_trade_user_order_1d"], "user_id", d, 7, 3)
    return _dated(hits.agg(F.count(F.lit(1)).alias("order_user_count")).select(
        F.lit(7).alias("recent_days"), "order_user_count"), d)


def _order_stats(t, d, keys: list[str]) -> DataFrame:
    one = t["dws_trade_user_sku_order_1d"].where(F.col("ds") == d).select(
        F.lit(1).alias("recent_days"), "user_id", *keys, F.col("order_count_1d").alias("order_count"))
    many = unfold_horizons(t["dws_trade_user_sku_order_nd"], ["user_id", *keys], (7, 30),
                           {"order_count": "order_count"})
    return _dated(one.unionByName(many).groupBy("recent_days", *keys).agg(
        F.sum("order_count").alias("order_count"),
        distinct_if(F.col("order_count") > 0, F.col("user_id")).alias("order_user_count")), d)


def ads_order_stats_by_cate(t, d) -> DataFrame:
    """category x {1, 7, 30} -> orders and users."""
    return _order_stats(t, d, CATEGORY)


def ads_order_stats_by_tm(t, d) -> DataFrame:
    """brand x {1, 7, 30} -> orders and users."""
    return _order_stats(t, d, ["tm_id", "tm_name"])


def ads_order_to_pay_interval_avg(t, d) -> DataFrame:
    """Mean seconds from order to payment, orders paid on the day."""
    flow = t["dwd_trade_trade_flow_acc"].where(F.col("ds").isin(OPEN_DATE, d) & (F.col("payment_date_id") == d))
    wait = seconds_between(F.col("payment_time").cast("timestamp"), F.col("order_time").cast("timestamp"))
    return _dated(flow.agg(F.avg(wait).cast("bigint").alias("order_to_pay_interval_avg")), d)


def ads_page_path(t, d) -> DataFrame:
    """Transitions between consecutive pages of a session with their step number.

    A session may hold any share of the day's views; the ordered operator cuts such a session by view time.
    """
    views = t["dwd_traffic_page_view_inc"].where(F.col("ds") == d).select(
        "session_id", "page_id", "view_time")
    steps = OrderedGroups(views, ["session_id"], [F.col("view_time"), F.col("page_id")],
                          places(views, "view_time", "page_id")).step("page_id", "next_page_id", "rn")
    source = F.concat(F.lit("step-"), F.col("rn").cast("string"), F.lit(":"), "page_id")
    target = F.concat(F.lit("step-"), (F.col("rn") + 1).cast("string"), F.lit(":"), "next_page_id")
    return _dated(steps.groupBy(source.alias("source"), F.coalesce(target, F.lit("null")).alias("target")).agg(
        F.count(F.lit(1)).alias("path_count")), d)


def ads_repeat_purchase_by_tm(t, d) -> DataFrame:
    """brand -> users with two or more orders among buyers of 30 days."""
    per_user = t["dws_trade_user_sku_order_nd"].groupBy("user_id", "tm_id", "tm_name").agg(
        F.sum("order_count_30d").alias("n"))
    rate = ratio(sum_if(F.col("n") >= 2, 1), sum_if(F.col("n") >= 1, 1))
    return _dated(per_user.groupBy("tm_id", "tm_name").agg(rate.alias("order_repeat_rate")).select(
        F.lit(30).alias("recent_days"), "*"), d)


def ads_sku_cart_num_top3_by_cate(t, d) -> DataFrame:
    """The three most carted skus per category, ties included."""
    carts = t["dwd_trade_cart_full"].groupBy("sku_id").agg(F.sum("sku_num").alias("cart_num"))
    named = lookup(carts, t["dim_sku_full"], "sku_id", "id", {c: c for c in ["sku_name", *CATEGORY]})
    return _dated(top_n(named, ["category1_id", "category2_id", "category3_id"], [F.col("cart_num").desc()], 3, "rk",
                        ties=True), d)


def ads_sku_favor_count_top3_by_tm(t, d) -> DataFrame:
    """The three most favoured skus per brand, ties included."""
    favor = t["dws_interaction_sku_favor_add_1d"].select("tm_id", "tm_name", "sku_id", "sku_name",
                                                         "favor_add_count_1d")
    return _dated(top_n(favor, ["tm_id"], [F.col("favor_add_count_1d").desc()], 3, "rk", ties=True), d)


def ads_traffic_stats_by_channel(t, d) -> DataFrame:
    """channel x {1, 7, 30} -> visitors, mean seconds and pages, sessions, bounce rate."""
    sessions = explode_horizons(t["dws_traffic_session_page_view_1d"], "ds", d, (1, 7, 30))
    return _dated(sessions.groupBy("recent_days", "channel").agg(
        F.count_distinct("mid_id").alias("uv_count"),
        (F.avg("during_time_1d") / 1000).cast("bigint").alias("avg_duration_sec"),
        F.avg("page_count_1d").cast("bigint").alias("avg_page_count"),
        F.count(F.lit(1)).alias("sv_count"),
        ratio(count_if(F.col("page_count_1d") == 1), F.count(F.lit(1))).alias("bounce_rate")), d)


def ads_user_action(t, d) -> DataFrame:
    """Funnel home -> detail -> cart -> order -> payment of the day as one row."""
    pages = t["dws_traffic_page_visitor_page_view_1d"].where(F.col("ds") == d)

    def rows(df: DataFrame) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("n"))

    def of_day(name: str) -> DataFrame:
        return rows(t[name].where(F.col("ds") == d))

    return _dated(one_row({
        "home_count": rows(pages.where(F.col("page_id") == "home")),
        "good_detail_count": rows(pages.where(F.col("page_id") == "good_detail")),
        "cart_count": of_day("dws_trade_user_cart_add_1d"),
        "order_count": of_day("dws_trade_user_order_1d"),
        "payment_count": of_day("dws_trade_user_payment_1d")}), d)


def ads_user_change(t, d) -> DataFrame:
    """Churned users (last login seven days ago) and returned users (back after eight or more).

    Reads the login table of the run date and of the day before.
    """
    now, before = t["dws_user_user_login_td"], t["dws_user_user_login_td_yesterday"]
    churned = now.where(F.col("login_date_last") == shift(d, -7)).agg(F.count(F.lit(1)).alias("n"))
    previous = before.select("user_id", F.col("login_date_last").alias("_previous"))
    back = now.where(F.col("login_date_last") == d).join(previous, "user_id").where(
        F.datediff(F.col("login_date_last").cast("date"), F.col("_previous").cast("date")) >= 8)
    return _dated(one_row({"user_churn_count": churned, "user_back_count": back.agg(F.count(F.lit(1)).alias("n"))}), d)


def ads_user_retention(t, d) -> DataFrame:
    """Cohorts of the last seven days -> retained users, size, rate in percent."""
    cohorts = t["dws_user_user_login_td"].where(
        (F.col("login_date_first") >= shift(d, -7)) & (F.col("login_date_first") < d))
    retained = sum_if(F.col("login_date_last") == d, 1)
    return _dated(cohorts.groupBy(F.col("login_date_first").alias("create_date")).agg(
        retained.alias("retention_count"), F.count(F.lit(1)).alias("new_user_count"),
        ratio(retained * 100, F.count(F.lit(1))).alias("retention_rate"))
        .withColumn("retention_day", F.datediff(F.lit(d).cast("date"), F.col("create_date").cast("date"))), d)


def ads_user_stats(t, d) -> DataFrame:
    """{1, 7, 30} -> new and active users."""
    active = explode_horizons(t["dws_user_user_login_td"], "login_date_last", d, (1, 7, 30))
    starts = {n: horizon_start(d, n) for n in (1, 7, 30)}
    fresh = F.lit(False)
    for n, start in starts.items():
        fresh = fresh | ((F.col("recent_days") == n) & (F.col("login_date_first") >= start))
    return _dated(active.groupBy("recent_days").agg(
        count_if(fresh).alias("new_user_count"), F.count(F.lit(1)).alias("active_user_count")), d)


def order_to_pay_interval_1d(t, d) -> DataFrame:
    """Mean seconds from order to payment by pay date (M8)."""
    flow = t["dwd_trade_trade_flow_acc"].where(F.col("payment_time").isNotNull())
    wait = seconds_between(F.col("payment_time").cast("timestamp"), F.col("order_time").cast("timestamp"))
    return flow.groupBy(F.substring("payment_time", 1, 10).alias("ds")).agg(
        F.avg(wait).cast("bigint").alias("order_to_pay_interval_avg"))


def ads_new_user_order_stats(t, d) -> DataFrame:
    """Users with their first order in the last 1, 7 and 30 days, side by side."""
    return _dated(t["dws_trade_user_order_td"].agg(*[
        count_if(F.col("order_date_first") >= horizon_start(d, n)).alias(f"new_order_user_count_{n}d")
        for n in (1, 7, 30)]), d)


def ads_province_order_wide(t, d) -> DataFrame:
    """province -> day, week and month measures side by side (M11); provinces without orders today stay."""
    month = in_last(t["dws_trade_province_order_users_1d"], "ds", d, 30).groupBy("province_id", *PLACE).agg(
        sum_if(F.col("ds") >= horizon_start(d, 7), F.col("order_total_amount_1d")).alias("order_total_amount_1w"),
        F.sum("order_total_amount_1d").alias("order_total_amount_1m"))
    users = province_users(t, d, {"order_user_num_1w": 7, "order_user_num_1m": 30})
    today = t["dws_trade_province_order_users_1d"].where(F.col("ds") == d).select(
        "province_id", "order_user_num_1d", "order_total_amount_1d")
    return _dated(month.join(users, "province_id").join(today, "province_id", "left"), d)
