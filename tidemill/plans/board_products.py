"""Product ranking board: sales, traffic sources, sku stock, search words, price strength, warnings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.functions.dates import horizon_start
from tidemill.functions.numbers import mean, no_negative, ratio
from tidemill.operators.dims import lookup
from tidemill.operators.horizons import explode_horizons, horizon_distinct, horizon_rollup, horizon_sums
from tidemill.operators.ranking import top_n, with_group_total

HORIZONS = (1, 7, 30)
# How the report names its horizons.
TIME_TYPE = {1: "d", 7: "7d", 30: "30d"}


def _named(df: DataFrame, t, cols=("product_name",)) -> DataFrame:
    """Product attributes of the run date, one row per product, so nothing is multiplied."""
    return lookup(df, t["ods_product_base"], "product_id", "product_id", {f"_{c}": c for c in cols}) \
        .withColumnsRenamed({f"_{c}": c for c in cols})


def _conversion() -> Column:
    return F.when(F.col("visitor_count") == 0, F.lit(0).cast("decimal(16,4)")).otherwise(
        ratio(F.col("pay_buyer_count"), F.col("visitor_count"), 4))


def dwd_product_sales_daily(t, d) -> DataFrame:
    rows = _named(t["ods_product_sales_daily"], t, ("product_name", "product_category", "brand", "shop_id"))
    return (rows.withColumn("sales_amount", no_negative(F.col("sales_amount")))
            .withColumn("sales_quantity", no_negative(F.col("sales_quantity")))
            .withColumn("pay_conversion_rate", _conversion()))


def dwd_traffic_source_daily(t, d) -> DataFrame:
    return _named(t["ods_traffic_source_daily"], t).withColumn("pay_conversion_rate", _conversion())


def dwd_sku_sales_inventory_daily(t, d) -> DataFrame:
    """Stock days = stock / mean daily sales of the sku's last seven rows. A sku has one row per day, so its window
    is as long as the calendar and no longer."""
    w = Window.partitionBy("sku_id").orderBy("stat_date").rowsBetween(-6, 0)
    rows = _named(t["ods_sku_sales_inventory_daily"], t).withColumn("current_stock", no_negative(F.col("current_stock")))
    rows = rows.withColumn("_s", F.sum("pay_quantity").over(w)).withColumn("_n", F.count("pay_quantity").over(w))
    days = F.when(F.col("_s") == 0, F.lit(0).cast("decimal(16,2)")).otherwise(
        ratio(F.col("current_stock") * F.col("_n"), F.col("_s")))
    return (rows.withColumn("avg_daily_sales", mean(F.col("_s"), F.col("_n")).cast("int"))
            .withColumn("stock_available_days", days).drop("_s", "_n"))


def dwd_search_word_daily(t, d) -> DataFrame:
    return _named(t["ods_search_word_daily"], t)


def dwd_price_strength_daily(t, d) -> DataFrame:
    return _named(t["ods_price_strength_product"], t, ("product_name", "product_category"))


def dwd_product_warning_daily(t, d) -> DataFrame:
    return _named(t["ods_product_warning_daily"], t)


def _spanned(df: DataFrame, d: str) -> DataFrame:
    """recent_days -> time_type, start_date, end_date."""
    kind, start = F.lit(None).cast("string"), F.lit(None).cast("string")
    for n, name in TIME_TYPE.items():
        hit = F.col("recent_days") == n
        kind, start = F.when(hit, name).otherwise(kind), F.when(hit, horizon_start(d, n)).otherwise(start)
    return df.withColumn("time_type", kind).withColumn("start_date", start).withColumn("end_date", F.lit(d)) \
        .drop("recent_days")


def dws_product_sales(t, d) -> DataFrame:
    return _spanned(horizon_sums(t["dwd_product_sales_daily"], "stat_date", d, HORIZONS,
                                 ["product_name", "product_category"],
                                 {"total_sales_amount": "sales_amount", "total_sales_quantity": "sales_quantity"}), d)


def dws_traffic_source(t, d) -> DataFrame:
    """Weighted conversion: all buyers over all visitors."""
    rows = horizon_sums(t["dwd_traffic_source_daily"], "stat_date", d, HORIZONS, ["source_name"],
                        {"total_visitor_count": "visitor_count", "_buyers": "pay_buyer_count"})
    rate = ratio(F.col("_buyers"), F.col("total_visitor_count"), 4)
    return _spanned(rows.withColumn("total_pay_conversion_rate", rate).drop("_buyers"), d)


def dws_sku_sales(t, d) -> DataFrame:
    rows = horizon_rollup(t["dwd_sku_sales_inventory_daily"], "stat_date", d, HORIZONS,
                          ["sku_id", "product_name", "sku_info"], {
                              "total_pay_quantity": ("sum", "pay_quantity"), "current_stock": ("max", "current_stock"),
                              "_s": ("sum", "stock_available_days"), "_n": ("count", "stock_available_days")})
    return _spanned(rows.withColumn("stock_available_days", ratio(F.col("_s"), F.col("_n"))).drop("_s", "_n"), d)


def dws_search_word(t, d) -> DataFrame:
    return _spanned(horizon_sums(t["dwd_search_word_daily"], "stat_date", d, HORIZONS, ["search_word"],
                                 {"total_visitor_count": "visitor_count"}), d)


def dws_price_strength(t, d) -> DataFrame:
    rows = horizon_distinct(t["dwd_price_strength_daily"], "ds", d, HORIZONS,
                            ["price_strength_level", "product_category"], "product_id", {"product_count": None})
    return _spanned(rows.where(F.col("product_count") > 0), d)


def dws_product_warning(t, d) -> DataFrame:
    rows = t["dwd_product_warning_daily"].select("product_name", "warning_type", "warning_reason", "stat_date")
    # last day per warning first: a warning repeated for days is copied once per horizon, not once per day
    last = rows.where(F.col("stat_date") <= d).groupBy("product_name", "warning_type", "warning_reason").agg(
        F.max("stat_date").alias("stat_date"))
    return _spanned(explode_horizons(last, "stat_date", d, HORIZONS).drop("stat_date"), d)


def ads_product_sales_ranking(t, d) -> DataFrame:
    return t["dws_product_sales"].groupBy("product_name", "product_category", "time_type").agg(
        F.sum("total_sales_amount").alias("sales_amount"), F.sum("total_sales_quantity").alias("sales_quantity"))


def ads_traffic_source_top10(t, d) -> DataFrame:
    rows = top_n(t["dws_traffic_source"], ["time_type"], [F.col("total_visitor_count").desc(), F.col("source_name")], 10)
    return rows.select("source_name", "time_type", F.col("total_visitor_count").alias("visitor_count"),
                       F.col("total_pay_conversion_rate").alias("pay_conversion_rate"))


def ads_sku_sales_top5(t, d) -> DataFrame:
    rows = with_group_total(t["dws_sku_sales"], ["time_type"], "total_pay_quantity", "_all")
    rows = top_n(rows, ["time_type"], [F.col("total_pay_quantity").desc(), F.col("sku_id")], 5)
    return rows.select("sku_info", "time_type", F.col("total_pay_quantity").alias("pay_quantity"),
                       ratio(F.col("total_pay_quantity"), F.col("_all"), 4).alias("pay_quantity_ratio"),
                       "current_stock", "stock_available_days")


def ads_search_word_top10(t, d) -> DataFrame:
    rows = top_n(t["dws_search_word"], ["time_type"], [F.col("total_visitor_count").desc(), F.col("search_word")], 10)
    return rows.select("search_word", "time_type", F.col("total_visitor_count").alias("visitor_count"))


def ads_price_strength_overview(t, d) -> DataFrame:
    return t["dws_price_strength"].groupBy("price_strength_level", "time_type").agg(
        F.sum("product_count").alias("product_count"))


def ads_product_warning_list(t, d) -> DataFrame:
    return t["dws_product_warning"].select("product_name", "warning_type", "time_type", "warning_reason")
