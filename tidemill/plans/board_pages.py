"""Page analysis board: clicks, visitors and guided payments of page blocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.functions.dates import horizon_start
from tidemill.functions.numbers import distinct_if, ratio
from tidemill.operators.ranking import with_group_total

# Analysed pages, channels left out of the visitor count, mark of product blocks.
PAGES = ("首页", "自定义承接页", "商品详情页")
NOT_VISITS = ("直播间", "短视频", "图文", "微详情")
PRODUCT_MARK = "%商品%"


def _behavior(t) -> DataFrame:
    """Clicks on analysed pages with the name and position of their block."""
    rows = t["ods_user_behavior"].where(F.col("page_type").isin(*PAGES))
    return rows.join(t["ods_page_structure"], ["page_type", "block_id", "ds"], "left").withColumn(
        "is_exclude_channel", F.col("channel").isin(*NOT_VISITS).cast("int"))


def dwd_user_page_behavior_detail(t, d) -> DataFrame:
    """Behaviour with the user's payments guided by the same block on the same day (one row per payment)."""
    trade = t["ods_trade_data"].select(
        "trade_id", "user_id", F.col("guide_block_id").alias("block_id"), "pay_amount", "pay_time", "ds",
        F.to_date("pay_time").alias("_day"))
    rows = _behavior(t).withColumn("_day", F.to_date("click_time"))
    joined = rows.join(trade, ["user_id", "block_id", "ds", "_day"], "left").drop("_day", "event_id")
    return joined.withColumn("pay_amount", F.coalesce("pay_amount", F.lit(0)))


def guided(t) -> DataFrame:
    """Behaviour with its payments already summed: ``weight`` rows and ``pay_amount`` stand for the detail rows.

    The statistics below are taken from this form, so the payments of a busy user and block are never paired with
    each of that user's clicks.
    """
    trade = t["ods_trade_data"].groupBy("user_id", F.col("guide_block_id").alias("block_id"), "ds",
                                        F.to_date("pay_time").alias("_day")).agg(
        F.count(F.lit(1)).alias("_n"), F.sum("pay_amount").alias("_pay"))
    rows = _behavior(t).withColumn("_day", F.to_date("click_time"))
    joined = rows.join(trade, ["user_id", "block_id", "ds", "_day"], "left")
    return (joined.withColumn("weight", F.greatest(F.coalesce("_n", F.lit(0)), F.lit(1)))
            .withColumn("pay_amount", F.coalesce("_pay", F.lit(0))).drop("_n", "_pay", "_day"))


CLICKED = "is_click"


def _clicks() -> Column:
    return F.sum(F.when(F.col(CLICKED) == 1, F.col("weight")).otherwise(0))


def dws_page_stats(t, d) -> DataFrame:
    """(page, day): visitors outside the excluded channels, clicks, clicking users."""
    return guided(t).groupBy("page_type", F.substring("click_time", 1, 10).alias("stat_date")).agg(
        distinct_if(F.col("is_exclude_channel") == 0, F.col("user_id")).alias("visitor_count"),
        _clicks().alias("click_count"), distinct_if(F.col(CLICKED) == 1, F.col("user_id")).alias("click_user_count"))


def dws_block_stats(t, d) -> DataFrame:
    """(page, block) of the day: clicks, clicking users, guided payments, clicks of the whole page."""
    rows = guided(t).where(F.col("ds") == d)
    blocks = rows.groupBy("page_type", "block_id", "block_name").agg(
        _clicks().alias("block_click_count"),
        distinct_if(F.col(CLICKED) == 1, F.col("user_id")).alias("block_click_user_count"),
        F.sum("pay_amount").alias("guide_pay_amount"))
    return with_group_total(blocks, ["page_type"], "block_click_count", "page_total_click")


def ads_page_overview_report(t, d) -> DataFrame:
    return t["dws_page_stats"].where(F.col("stat_date") == d).select(
        "page_type", "stat_date", "click_count", "click_user_count", "visitor_count")


def ads_block_click_report(t, d) -> DataFrame:
    return t["dws_block_stats"].select("page_type", "block_id", "block_name", "block_click_count",
                                       "block_click_user_count", F.col("guide_pay_amount").alias("block_guide_pay_amount"))


def ads_page_trend_report(t, d) -> DataFrame:
    return t["dws_page_stats"].where(F.col("stat_date").between(horizon_start(d, 30), d)).select(
        "page_type", "stat_date", F.col("visitor_count").alias("daily_visitor_count"),
        F.col("click_user_count").alias("daily_click_user_count"))


def ads_guide_detail_report(t, d) -> DataFrame:
    return t["dws_block_stats"].where(F.col("block_name").like(PRODUCT_MARK)).select(
        "page_type", F.col("block_id").alias("guide_product_id"), F.col("block_click_count").alias("guide_click_count"),
        F.col("block_click_user_count").alias("guide_visitor_count"))


def ads_module_detail_report(t, d) -> DataFrame:
    share = ratio(F.col("block_click_count") * 100, F.col("page_total_click"))
    return t["dws_block_stats"].select(
        "page_type", F.col("block_id").alias("module_id"), F.col("block_name").alias("module_name"),
        F.col("block_click_count").alias("module_click_count"), share.alias("module_click_ratio_percent"))


# ---------------------------------------------------------------- the same reports straight from the logs
def _rows(t) -> DataFrame:
    return t["ods_user_behavior"].where(F.col("page_type").isin(*PAGES))


def _visitors() -> Column:
    return distinct_if(~F.col("channel").isin(*NOT_VISITS), F.col("user_id"))


def direct_page_overview(t, d) -> DataFrame:
    """Every behaviour counts as a click here, clicked or not."""
    return _rows(t).where(F.col("ds") == d).groupBy("page_type", F.substring("click_time", 1, 10).alias("stat_date")).agg(
        F.count("block_id").alias("click_count"), F.count_distinct("user_id").alias("click_user_count"),
        _visitors().alias("visitor_count"))


def direct_block_click(t, d) -> DataFrame:
    rows = guided(t).where(F.col("ds") == d)
    return rows.groupBy("page_type", "block_id", "block_name").agg(
        F.sum("weight").alias("block_click_count"), F.count_distinct("user_id").alias("block_click_user_count"),
        F.sum(F.nullif("pay_amount", F.lit(0))).alias("block_guide_pay_amount"))


def direct_page_trend(t, d) -> DataFrame:
    rows = _rows(t).where(F.col("ds").between(horizon_start(d, 30), d))
    return rows.groupBy("page_type", F.substring("click_time", 1, 10).alias("stat_date")).agg(
        _visitors().alias("daily_visitor_count"), F.count_distinct("user_id").alias("daily_click_user_count"))


def direct_guide_detail(t, d) -> DataFrame:
    """Clicks on blocks that are product blocks on any page (an EXISTS test, so a semi join)."""
    named = t["ods_page_structure"].where((F.col("ds") == d) & F.col("block_name").like(PRODUCT_MARK))
    rows = _rows(t).where((F.col("ds") == d) & (F.col(CLICKED) == 1)).join(named, "block_id", "left_semi")
    return rows.groupBy("page_type", F.col("block_id").alias("guide_product_id")).agg(
        F.count(F.lit(1)).alias("guide_click_count"), F.count_distinct("user_id").alias("guide_visitor_count"))


def direct_module_detail(t, d) -> DataFrame:
    rows = _behavior(t).where(F.col("ds") == d).groupBy(
        "page_type", F.col("block_id").alias("module_id"), F.col("block_name").alias("module_name")).agg(
        F.count(F.lit(1)).alias("module_click_count"))
    rows = with_group_total(rows, ["page_type"], "module_click_count", "_all")
    return rows.withColumn("module_click_ratio_percent", ratio(F.col("module_click_count") * 100, F.col("_all"))).drop("_all")
