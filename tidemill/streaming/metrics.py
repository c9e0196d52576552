"""Windowed metrics on event streams. Results are emitted once, when the watermark passes the window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.functions.dates import as_ds, as_text_time
from tidemill.functions.text import explode_words
from tidemill.operators.dims import chain, lookup
from tidemill.streaming.state import first_of_day, live, once_per_window, with_retractions


def clocked(df: DataFrame, millis: str, delay: str) -> DataFrame:
    """Event time from epoch milliseconds with a bounded delay; 0 seconds is the monotonous clock."""
    return df.withColumn("event_time", F.timestamp_millis(millis)).withWatermark("event_time", delay)


def windowed(df: DataFrame, width: str, keys: Sequence[str], *aggs: Column, time: str = "event_time") -> DataFrame:
    """Tumbling window aggregate with the window as text columns."""
    rows = df.groupBy(F.window(time, width).alias("_w"), *keys).agg(*aggs)
    return rows.select(as_text_time(F.col("_w.start")).alias("stt"), as_text_time(F.col("_w.end")).alias("edt"),
                       as_ds(F.col("_w.start")).alias("cur_date"), *[c for c in rows.columns if c != "_w"])


def processing_windows(df: DataFrame, width: str, keys: Sequence[str], *aggs: Column) -> DataFrame:
    """Tumbling window aggregate by the clock (X8): a record counts in the window in which its micro-batch starts, whatever time it states.
    A window is given out by the first batch after its end. ``df`` must not have a watermark of its own, which would hold the clock back."""
    return windowed(df.withColumn("_clock", F.current_timestamp()).withWatermark("_clock", "0 seconds"), width, keys, *aggs, time="_clock")


def distinct_in_window(df: DataFrame, width: str, keys: Sequence[str], ident: str, out: str) -> DataFrame:
    """Distinct ids per window and key (A19): one row per (window, key, id) first, then a count. No set of ids is
    ever held for a key, so the hottest key is as cheap as its ids are spread."""
    once = once_per_window(df.select(*keys, ident, "event_time").where(live(F.col(ident).isNotNull())),
                           [*keys, ident], width)
    rows = once.groupBy("_w", *keys).agg(F.count(F.lit(1)).alias(out))
    return rows.select(as_text_time(F.col("_w.start")).alias("stt"), as_text_time(F.col("_w.end")).alias("edt"),
                       as_ds(F.col("_w.start")).alias("cur_date"), *keys, out)


def keyword_views(pages: DataFrame, width: str = "3 days") -> DataFrame:
    """Words of search keywords per three-day window, windows aligned to the epoch."""
    p = F.col("page")
    searched = pages.where(live((p["last_page_id"] == "search") & (p["item_type"] == "keyword") & p["item"].isNotNull()))
    words = explode_words(searched.select(p["item"].alias("item"), "event_time"), "item", "keyword")
    rows = windowed(words, width, ["keyword"], F.count(F.lit(1)).alias("keyword_count"))
    return rows.withColumn("cur_date", F.date_format(F.col("stt").cast("timestamp"), "yyyyMMdd"))


def page_views(pages: DataFrame, width: str = "10 seconds") -> DataFrame:
    """(version, channel, area, new flag): unique visitors, sessions, views, time.

    Views, sessions and time come from every event; the visitor counts once a day, in the window and under the attributes
    of the first event of the day. Both parts meet in one window aggregate.
    """
    keys = ["vc", "ch", "ar", "is_new"]
    flat = pages.where(live(F.col("page").isNotNull())).select(
        F.col("common.mid").alias("mid"), *[F.col(f"common.{k}") for k in keys], "event_time",
        (F.coalesce(F.col("page.last_page_id"), F.lit("")) == "").cast("int").alias("sv"),
        F.coalesce("page.during_time", F.lit(0)).alias("dur"))
    visits = first_of_day(flat.select("mid", *keys, "event_time"), ["mid"], width, carry=keys)
    uv = visits.select(*keys, "event_time", F.lit(1).alias("uv_ct"), F.lit(0).alias("sv_ct"), F.lit(0).alias("pv_ct"),
                       F.lit(0).cast("bigint").alias("dur_sum"))
    views = flat.select(*keys, "event_time", F.lit(0).alias("uv_ct"), F.col("sv").alias("sv_ct"),
                        F.lit(1).alias("pv_ct"), F.col("dur").alias("dur_sum"))
    return windowed(views.unionByName(uv), width, keys, *[F.sum(c).alias(c) for c in (
        "uv_ct", "sv_ct", "pv_ct", "dur_sum")])


def home_detail_visitors(pages: DataFrame, width: str = "5 seconds") -> DataFrame:
    """Unique visitors of the home and of the detail page."""
    rows = pages.where(live(F.col("page.page_id").isin("home", "good_detail"))).select(
        F.col("common.mid").alias("mid"), F.col("page.page_id").alias("page_id"), "event_time")
    firsts = first_of_day(rows, ["mid", "page_id"], width)
    return windowed(firsts, width, [], F.count_if(F.col("page_id") == "home").alias("home_uv_ct"),
                    F.count_if(F.col("page_id") == "good_detail").alias("good_detail_uv_ct"))


def logins(pages: DataFrame, width: str = "1 second", gap_days: int = 8) -> DataFrame:
    """Logged-in users of the day, and those who return after eight days or more."""
    uid, last = F.col("common.uid"), F.col("page.last_page_id")
    rows = pages.where(live(uid.isNotNull() & (uid != "") & (last.isNull() | (last == "") | (last == "login")))).select(
        uid.alias("uid"), "event_time")
    firsts = first_of_day(rows, ["uid"], width)
    return windowed(firsts, width, [], F.count_if(F.coalesce(F.col("gap_days") >= gap_days, F.lit(False))).alias("back_ct"),
                    F.count(F.lit(1)).alias("uu_ct"))


def registrations(users: DataFrame, width: str = "10 seconds") -> DataFrame:
    """Registered users per window."""
    return windowed(users.where(live(F.col("user_id").isNotNull())), width, [],
                    F.count(F.lit(1)).alias("register_ct"))


def cart_add_users(carts: DataFrame, width: str = "5 seconds") -> DataFrame:
    """Users who add to a cart for the first time of their day."""
    firsts = first_of_day(carts.where(live(F.col("user_id").isNotNull())), ["user_id"], width)
    return windowed(firsts, width, [], F.count(F.lit(1)).alias("cart_add_uu_ct"))


def unique_and_new_users(facts: DataFrame, prefix: str, width: str = "5 seconds") -> DataFrame:
    """Users active for the first time of their day, and for the first time ever (R18 orders, R19 payments)."""
    firsts = first_of_day(facts.where(live(F.col("user_id").isNotNull())), ["user_id"], width)
    return windowed(firsts, width, [], F.count(F.lit(1)).alias(f"{prefix}_unique_user_count"),
                    F.sum("is_first").alias(f"{prefix}_new_user_count"))


AMOUNTS = ["split_original_amount", "split_activity_amount", "split_coupon_amount", "split_total_amount"]
MONEY = "decimal(16,4)"


def _signed(col: str, out: str) -> Column:
    """Null-safe numeric retraction."""
    return F.sum(F.col("sign") * F.coalesce(F.col(col), F.lit(0).cast(MONEY))).alias(out)


def sku_orders(details: DataFrame, width: str = "5 seconds") -> DataFrame:
    """Amounts per sku; a line sent again replaces its earlier version."""
    rows = details.where(live(F.col("id").isNotNull())).select(
        "id", "event_time", "ts", "sku_id", *[F.col(a).cast(MONEY).alias(a) for a in AMOUNTS])
    signed = with_retractions(rows, "id", "ts", ["sku_id", *AMOUNTS], width)
    return windowed(signed, width, ["sku_id"], _signed(AMOUNTS[0], "original_amount"),
                    _signed(AMOUNTS[1], "activity_reduce_amount"), _signed(AMOUNTS[2], "coupon_reduce_amount"),
                    _signed(AMOUNTS[3], "order_amount"))


def with_sku_names(batch: DataFrame, t) -> DataFrame:
    """Six-step dimension chain after the window, where there are fewest rows (J22); an unknown step leaves nulls."""
    return chain(batch, [
        (t["ods_sku_info"], "sku_id", "id", {"sku_name": "sku_name", "spu_id": "spu_id", "tm_id": "tm_id",
                                             "category3_id": "category3_id"}),
        (t["ods_spu_info"], "spu_id", "id", {"spu_name": "spu_name"}),
        (t["ods_base_trademark"], "tm_id", "id", {"tm_name": "tm_name"}),
        (t["ods_base_category3"], "category3_id", "id", {"category3_name": "name", "category2_id": "category2_id"}),
        (t["ods_base_category2"], "category2_id", "id", {"category2_name": "name", "category1_id": "category1_id"}),
        (t["ods_base_category1"], "category1_id", "id", {"category1_name": "name"})])


def province_orders(details: DataFrame, width: str = "10 seconds") -> tuple[DataFrame, DataFrame]:
    """Distinct orders and amount per province (R21) as two streams of the same windows; they meet by key in the
    sink (:func:`joined_windows`)."""
    rows = details.where(live(F.col("id").isNotNull())).select(
        "id", "event_time", "ts", "province_id", "order_id", F.col("split_total_amount").cast(MONEY).alias("amount"))
    signed = with_retractions(rows.drop("order_id"), "id", "ts", ["province_id", "amount"], width)
    amounts = windowed(signed, width, ["province_id"], _signed("amount", "order_amount"))
    return amounts, distinct_in_window(rows, width, ["province_id"], "order_id", "order_count")


def joined_windows(parts: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Window results of several streams side by side: one shuffle, one row per window and key."""
    from tidemill.operators.merge import full_outer
    return full_outer(parts, ["stt", "edt", "cur_date", *keys])


def refunds(refund_facts: DataFrame, sku: DataFrame, width: str = "5 seconds") -> DataFrame:
    """Distinct refunded orders per (brand, category, user) (R22); the sku is looked up before the window because
    the window is keyed by it."""
    keyed = lookup(refund_facts.where(live(F.col("order_id").isNotNull())), sku, "sku_id", "id",
                   {"trademark_id": "tm_id", "category3_id": "category3_id"})
    return distinct_in_window(keyed, width, ["trademark_id", "category3_id", "user_id"], "order_id", "refund_count")


def with_refund_names(batch: DataFrame, t) -> DataFrame:
    return chain(batch, [
        (t["ods_base_trademark"], "trademark_id", "id", {"trademark_name": "tm_name"}),
        (t["ods_base_category3"], "category3_id", "id", {"category3_name": "name", "category2_id": "category2_id"}),
        (t["ods_base_category2"], "category2_id", "id", {"category2_name": "name", "category1_id": "category1_id"}),
        (t["ods_base_category1"], "category1_id", "id", {"category1_name": "name"})])


def sku_visitors(details: DataFrame, width: str = "1 hour") -> DataFrame:
    """Distinct buyers per sku name and hour (R23); the caller sets the five-minute delay."""
    return distinct_in_window(details, width, ["sku_name"], "user_id", "uv_cnt")
