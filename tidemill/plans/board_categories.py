"""Category board: sales, item attributes, traffic and customer groups over 1, 7 and 30 days.

The 7 and 30 day figures are true trailing windows that end at the run date. ``sales_by_day`` gives
the other reading, in which every day is its own group and only the label spans the horizon.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.functions.dates import span_label
from tidemill.functions.numbers import ratio
from tidemill.operators.dims import lookup
from tidemill.operators.horizons import horizon_distinct, horizon_sums
from tidemill.operators.merge import full_outer
from tidemill.operators.ranking import rank_all

HORIZONS = (1, 7, 30)
CATEGORY = ["category_id", "category_name"]


def _labelled(df: DataFrame, d: str) -> DataFrame:
    """recent_days -> time_type (1d/7d/30d) and the covered range as text."""
    end = F.lit(d)
    value = F.when(F.col("recent_days") == 1, end)
    for n in (7, 30):
        value = value.when(F.col("recent_days") == n, span_label(end, n))
    kind = F.concat(F.col("recent_days").cast("string"), F.lit("d"))
    return df.withColumn("time_type", kind).withColumn("time_value", value).drop("recent_days")


def dwd_trade_sales_detail(t, d) -> DataFrame:
    return t["ods_sales_full"].withColumn("create_dt", F.substring("create_time", 1, 10)).drop("create_time")


def dwd_item_attribute_detail(t, d) -> DataFrame:
    return t["ods_attribute_info"].withColumn("visit_dt", F.substring("visit_time", 1, 10)).drop("visit_time")


def dwd_traffic_source_detail(t, d) -> DataFrame:
    return t["ods_traffic_detail"].withColumn("visit_dt", F.substring("visit_time", 1, 10)).drop("visit_time")


def dwd_user_behavior_detail(t, d) -> DataFrame:
    rows = t["ods_user_behavior_full"].withColumn("behavior_dt", F.substring("behavior_time", 1, 10))
    return lookup(rows.drop("behavior_time"), t["ods_user_profile"], "user_id", "user_id", {
        c: c for c in ("age", "gender", "region", "consumption_level")})


ITEM = [*CATEGORY, "item_name", "target_gmv", "last_month_rank"]


def dws_sales_analysis(t, d) -> DataFrame:
    """(category, item) x {1, 7, 30}: sales, rank in its category; month progress and contribution at 30 days."""
    rows = horizon_sums(t["dwd_trade_sales_detail"], "create_dt", d, HORIZONS, ITEM,
                        {"total_sales": "pay_amount", "total_quantity": "pay_quantity"})
    ranked = rank_all(rows, ["recent_days", "category_id"], "total_sales", "item_sales_rank")
    month = F.col("recent_days") == 30
    everything = ranked.where(month).agg(F.sum("total_sales").alias("s")).select("s").scalar()
    done = (ranked.withColumn("monthly_pay_progress", F.when(month, ratio(F.col("total_sales") * 100, F.col("target_gmv"))))
            .withColumn("monthly_pay_contribution", F.when(month, ratio(F.col("total_sales") * 100, everything))))
    return _labelled(done, d).drop("target_gmv")


def sales_by_day(t, d) -> DataFrame:
    """The literal reading: one group per day, labelled once per horizon (the figures do not differ)."""
    daily = t["dwd_trade_sales_detail"].groupBy(*ITEM, "create_dt").agg(
        F.sum("pay_amount").alias("total_sales"), F.sum("pay_quantity").alias("total_quantity"))
    ranked = rank_all(daily, ["category_id", "create_dt"], "total_sales", "item_sales_rank")
    labels = F.explode(F.array(*[F.struct(F.lit(f"{n}d").alias("time_type"), (
        F.col("create_dt") if n == 1 else span_label(F.col("create_dt"), n)).alias("time_value")) for n in HORIZONS]))
    return ranked.withColumn("_l", labels).select("*", "_l.time_type", "_l.time_value").drop("_l", "target_gmv")


def dws_attribute_analysis(t, d) -> DataFrame:
    """(category, attribute value) x {1, 7, 30}: visitors, paying share in percent, active items."""
    keys = [*CATEGORY, "attr_id", "attr_value"]
    rows = t["dwd_item_attribute_detail"]
    people = horizon_distinct(rows, "visit_dt", d, HORIZONS, keys, "visitor_id", {
        "attr_visitor_count": None, "_payers": F.col("is_pay") == 1})
    items = horizon_distinct(rows, "visit_dt", d, HORIZONS, keys, "item_id", {"active_item_count": None})
    both = full_outer([people, items], ["recent_days", *keys]).where(F.col("attr_visitor_count") > 0)
    both = both.withColumn("attr_pay_conversion", ratio(F.col("_payers") * 100, F.col("attr_visitor_count")))
    return _labelled(both.drop("_payers"), d)


def dws_traffic_analysis(t, d) -> DataFrame:
    """(category, channel, word) over 30 days: visitors, paying share, word visitors and their rank."""
    keys = [*CATEGORY, "channel", "search_word"]
    rows = horizon_distinct(t["dwd_traffic_source_detail"], "visit_dt", d, (30,), keys, "visitor_id", {
        "channel_visitor_count": None, "_payers": F.col("is_pay") == 1,
        "hot_word_visitor_count": F.col("search_word").isNotNull()})
    rows = rows.withColumn("channel_pay_conversion", ratio(F.col("_payers") * 100, F.col("channel_visitor_count")))
    ranked = rank_all(rows.drop("_payers"), ["category_id"], "hot_word_visitor_count", "hot_word_rank")
    return _labelled(ranked, d).drop("time_type")


def dws_customer_insight(t, d) -> DataFrame:
    """(category, behaviour, profile) over 30 days: people and their share of the behaviour in percent."""
    profile = ["age", "gender", "region", "consumption_level"]
    rows = t["dwd_user_behavior_detail"]
    crowd = horizon_distinct(rows, "behavior_dt", d, (30,), [*CATEGORY, "behavior_type", *profile], "user_id",
                             {"crowd_count": None})
    total = horizon_distinct(rows, "behavior_dt", d, (30,), ["category_id", "behavior_type"], "user_id",
                             {"_total": None}).drop("recent_days")
    done = crowd.join(total, ["category_id", "behavior_type"]) \
        .withColumn("crowd_ratio", ratio(F.col("crowd_count") * 100, F.col("_total")))
    return _labelled(done.drop("_total"), d).drop("time_type")


def ads_sales_analysis(t, d) -> DataFrame:
    return t["dws_sales_analysis"].drop("time_value")


def ads_attribute_analysis(t, d) -> DataFrame:
    return t["dws_attribute_analysis"].drop("time_value")


def ads_traffic_analysis(t, d) -> DataFrame:
    return t["dws_traffic_analysis"].drop("time_value")


def ads_customer_insight(t, d) -> DataFrame:
    return t["dws_customer_insight"].groupBy(*CATEGORY, "behavior_type").agg(F.sum("crowd_count").alias("crowd_count"))
