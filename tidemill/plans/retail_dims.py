"""Retail dimensions and facts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.functions import masks
from tidemill.functions.dates import OPEN_DATE, as_ds, shift
from tidemill.functions.rules import activity_benefit, coupon_benefit
from tidemill.operators.dims import chain, codes_to_names, lookup
from tidemill.operators.scd2 import scd2_init, scd2_merge

SKU_NAMES = ["sku_name", "category1_id", "category1_name", "category2_id", "category2_name", "category3_id",
             "category3_name", "tm_id", "tm_name"]


def dim_activity_full(t, d) -> DataFrame:
    """Activity rules with their activity, type name and benefit text (B1)."""
    rules = t["ods_activity_rule"].withColumnsRenamed({"id": "activity_rule_id", "activity_type": "activity_type_code"})
    full = lookup(rules, t["ods_activity_info"], "activity_id", "id", {
        c: c for c in ("activity_name", "activity_desc", "start_time", "end_time", "create_time")})
    full = codes_to_names(full, t["ods_base_dic"], {"activity_type_code": ("activity_type_name", "31")})
    return full.withColumn("benefit_rule", activity_benefit(F.col("activity_type_code"))).select(
        "activity_rule_id", "activity_id", "activity_name", "activity_type_code", "activity_type_name",
        "activity_desc", "start_time", "end_time", "create_time", "condition_amount", "condition_num",
        "benefit_amount", "benefit_discount", "benefit_rule", "benefit_level")


def dim_coupon_full(t, d) -> DataFrame:
    """Coupons with type and range names and the benefit text (B2)."""
    full = codes_to_names(t["ods_coupon_info"], t["ods_base_dic"], {
        "coupon_type": ("coupon_type_name", "32"), "range_type": ("range_type_name", "33")})
    return full.withColumn("benefit_rule", coupon_benefit(F.col("coupon_type"))).select(
        "id", "coupon_name", F.col("coupon_type").alias("coupon_type_code"), "coupon_type_name",
        "condition_amount", "condition_num", "activity_id", "benefit_amount", "benefit_discount", "benefit_rule",
        "create_time", F.col("range_type").alias("range_type_code"), "range_type_name", "limit_num")


def dim_promotion_pos_full(t, d) -> DataFrame:
    return t["ods_promotion_pos"].select("id", "pos_location", "pos_type", "promotion_type", "create_time",
                                         "operate_time")


def dim_promotion_refer_full(t, d) -> DataFrame:
    return t["ods_promotion_refer"].select("id", "refer_name", "create_time", "operate_time")


def dim_province_full(t, d) -> DataFrame:
    """Provinces with their region."""
    full = lookup(t["ods_base_province"], t["ods_base_region"], "region_id", "id", {"region_name": "region_name"})
    return full.select("id", F.col("name").alias("province_name"), "area_code", "iso_code", "iso_3166_2", "region_id",
                       "region_name")


def dim_sku_full(t, d) -> DataFrame:
    """SKU snowflake with its attribute arrays (B5). Arrays are sorted, so equal rows are equal values."""
    full = chain(t["ods_sku_info"], [
        (t["ods_spu_info"], "spu_id", "id", {"spu_name": "spu_name"}),
        (t["ods_base_category3"], "category3_id", "id", {"category3_name": "name", "category2_id": "category2_id"}),
        (t["ods_base_category2"], "category2_id", "id", {"category2_name": "name", "category1_id": "category1_id"}),
        (t["ods_base_category1"], "category1_id", "id", {"category1_name": "name"}),
        (t["ods_base_trademark"], "tm_id", "id", {"tm_name": "tm_name"}),
    ])
    attrs = _attributes(t["ods_sku_attr_value"], ["attr_id", "value_id", "attr_name", "value_name"], "sku_attr_values")
    sale = _attributes(t["ods_sku_sale_attr_value"],
                       ["sale_attr_id", "sale_attr_value_id", "sale_attr_name", "sale_attr_value_name"],
                       "sku_sale_attr_values")
    full = full.join(attrs, F.col("id") == attrs["sku_id"], "left").drop("sku_id")
    return full.join(sale, F.col("id") == sale["sku_id"], "left").drop("sku_id").select(
        "id", "price", "sku_name", "sku_desc", "weight", "is_sale", "spu_id", "spu_name", "category3_id",
        "category3_name", "category2_id", "category2_name", "category1_id", "category1_name", "tm_id", "tm_name",
        "sku_attr_values", "sku_sale_attr_values", "create_time")


def _attributes(rows: DataFrame, cols: list[str], out: str) -> DataFrame:
    """A sku's attribute set. Distinct rows first: one sku has a handful of attributes however often they repeat."""
    distinct = rows.select("sku_id", *[F.col(c).cast("string").alias(c) for c in cols]).distinct()
    return distinct.groupBy("sku_id").agg(F.sort_array(F.collect_set(F.struct(*cols))).alias(out))


def masked_users(rows: DataFrame) -> DataFrame:
    return rows.select(
        "id", masks.first_letter(F.col("name")).alias("name"),
        F.when(F.col("phone_num").rlike(masks.PHONE), masks.keep_three(F.col("phone_num"))).alias("phone_num"),
        F.when(F.col("email").rlike(masks.EMAIL), masks.mail_domain(F.col("email"))).alias("email"),
        "user_level", "birthday", "gender", "create_time", "operate_time")


def dim_user_zip(t, d) -> DataFrame:
    """Masked users, all open."""
    return scd2_init(masked_users(t["ods_user_info"]), as_ds(F.col("create_time").cast("timestamp")))


def dim_user_zip_daily(t, d) -> DataFrame:
    """The changes of day d applied to the open rows (M2): old versions close at d itself."""
    opened = t["dim_user_zip"].where(F.col("end_date") == OPEN_DATE)
    changes = masked_users(t["ods_user_info_inc"].where(F.substring("operate_time", 1, 10) == d))
    return scd2_merge(opened, changes, d, "id", ["operate_time"], close_offset=0)


def dwd_interaction_favor_add_inc(t, d) -> DataFrame:
    """Favourites of the day."""
    return t["ods_favor_info"].where(F.col("ds") == d).select(
        "id", "user_id", "sku_id", as_ds(F.col("create_time").cast("timestamp")).alias("date_id"), "create_time")


def dwd_tool_coupon_used_inc(t, d) -> DataFrame:
    """Used coupons (B8): rows without a use time are only claimed."""
    return t["ods_coupon_use"].where(F.col("used_time").isNotNull()).select(
        "id", "coupon_id", "user_id", "order_id", F.substring("used_time", 1, 10).alias("date_id"),
        F.col("used_time").alias("payment_time"))


def dwd_trade_cart_full(t, d) -> DataFrame:
    """Carts still open, stamped with the day."""
    return t["ods_cart_info"].where(F.col("is_ordered") == "0").select(
        "id", "user_id", "sku_id", "sku_name", "sku_num", F.lit(d).alias("ds"))


def dwd_trade_order_detail_inc(t, d) -> DataFrame:
    """Order lines with their order's user and province, dated by the order (M3).

    Both sides shuffle on the order id; the optimizer splits an order id that is too hot.
    """
    od, oi = t["ods_order_detail"].alias("od"), t["ods_order_info"].alias("oi")
    return od.join(oi, F.col("od.order_id") == F.col("oi.id")).select(
        F.col("od.order_id"), "oi.user_id", "od.sku_id", "oi.province_id", F.col("oi.create_time"),
        "od.sku_num", "od.split_original_amount", "od.split_activity_amount", "od.split_coupon_amount",
        "od.split_total_amount", F.substring("oi.create_time", 1, 10).alias("ds"))


def dwd_trade_pay_detail_suc_inc(t, d) -> DataFrame:
    """All successful payments of order lines with the payment type name (M5, first load)."""
    return _paid_lines(t, t["ods_payment_info"], t["dwd_trade_order_detail_inc"])


def dwd_trade_payment_daily(t, d) -> DataFrame:
    """The successful payments of day d, with lines ordered on that day or the day before (M5, daily)."""
    lines = t["dwd_trade_order_detail_inc"].where(F.col("ds").isin(d, shift(d, -1)))
    return _paid_lines(t, t["ods_payment_info"].where(F.substring("callback_time", 1, 10) == d), lines)


def _paid_lines(t, payments: DataFrame, lines: DataFrame) -> DataFrame:
    paid = payments.where(F.col("payment_status") == "1602").select(
        F.col("order_id").alias("_o"), "payment_type", "callback_time")
    full = lines.join(paid, F.col("order_id") == F.col("_o")).drop("_o", "ds")
    full = codes_to_names(full, t["ods_base_dic"], {"payment_type": ("payment_type_name", "11")})
    return full.withColumnsRenamed({"payment_type": "payment_type_code",
                                    "split_total_amount": "split_payment_amount"}) \
        .withColumn("ds", F.substring("callback_time", 1, 10))
