"""Fact streams joined from change records. All times are event times; join state is bounded by the watermark."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.functions.dates import ms_to_ds
from tidemill.operators.dims import lookup
from tidemill.streaming.sources import after, before, keep_columns, live_payload, moved
from tidemill.streaming.state import live

ROUTES = 10_000  # a config table of so many rows is broadcast
SPREAD = 8  # copies of the one-row-per-order side, so the lines of one order share out over as many tasks


def table(changes: DataFrame, name: str, *conditions: Column) -> DataFrame:
    """Records of a source table; the filter stays above the watermark."""
    cond = F.col("source")["table"] == name
    for c in conditions:
        cond = cond & F.coalesce(c, F.lit(False))
    return changes.where(live(cond))


def near(left: str, right: str, before_s: int, after_s: int) -> Column:
    """right within [left - before, left + after] seconds."""
    return (F.col(right) >= F.col(left) - F.expr(f"INTERVAL {before_s} SECONDS")) & (
        F.col(right) <= F.col(left) + F.expr(f"INTERVAL {after_s} SECONDS"))


def join_order(lines: DataFrame, orders: DataFrame, key: str, time: str, window_s: int, back_s: int | None = None,
               spread: int = SPREAD) -> DataFrame:
    """Lines joined to their order within ``window_s`` seconds either way.

    ``orders`` has columns ``_o`` (order id) and ``_ot`` (time). In a stream join each order is copied ``spread`` times and each line
    takes one copy by its id, so a single order with a huge share of the lines does not land on one task; a batch join needs no copies, as
    adaptive execution splits such an order.
    """
    if not lines.isStreaming:
        return lines.join(orders, (F.col(key) == F.col("_o")) & near(time, "_ot", back_s or window_s, window_s), "inner").drop("_o", "_ot")
    salted = lines.withColumn("_s", F.pmod(F.xxhash64("id"), F.lit(spread)).cast("int"))
    copies = orders.withColumn("_c", F.explode(F.sequence(F.lit(0), F.lit(spread - 1))))
    cond = (F.col(key) == F.col("_o")) & (F.col("_s") == F.col("_c")) & near(time, "_ot", back_s or window_s, window_s)
    return salted.join(copies, cond, "inner").drop("_o", "_ot", "_s", "_c")


def order_detail(changes: DataFrame, ttl_s: int = 10) -> DataFrame:
    """Order lines with user and province, activity and coupon when there are any.

    Inner join to the order, left joins to activity and coupon, each within the state lifetime. A line is emitted
    once, when it can no longer change -- not emitted, retracted and emitted again.
    """
    od = table(changes, "order_detail").select(
        after("id").alias("id"), after("order_id").alias("order_id"), after("sku_id").alias("sku_id"),
        after("sku_name").alias("sku_name"), after("create_time").alias("create_time"),
        after("sku_num").alias("sku_num"),
        (after("sku_num").cast("decimal(16,2)") * after("order_price").cast("decimal(16,2)")).cast("decimal(16,2)")
        .cast("string").alias("split_original_amount"),
        after("split_activity_amount").alias("split_activity_amount"),
        after("split_coupon_amount").alias("split_coupon_amount"),
        after("split_total_amount").alias("split_total_amount"), F.col("ts_ms").alias("ts"), "event_time")
    oi = table(changes, "order_info", F.col("op") == "r").select(
        after("id").alias("_o"), after("user_id").alias("user_id"), after("province_id").alias("province_id"),
        F.col("event_time").alias("_ot"))
    act = table(changes, "order_detail_activity").select(
        after("order_detail_id").alias("_a"), after("activity_id").alias("activity_id"),
        after("activity_rule_id").alias("activity_rule_id"), F.col("event_time").alias("_at"))
    cou = table(changes, "order_detail_coupon").select(
        after("order_detail_id").alias("_u"), after("coupon_id").alias("coupon_id"),
        F.col("event_time").alias("_ut"))
    rows = join_order(od, oi, "order_id", "event_time", ttl_s)
    rows = rows.join(act, (F.col("id") == F.col("_a")) & near("event_time", "_at", ttl_s, ttl_s), "left_outer") \
               .drop("_a", "_at")
    rows = rows.join(cou, (F.col("id") == F.col("_u")) & near("event_time", "_ut", ttl_s, ttl_s), "left_outer") \
               .drop("_u", "_ut")
    return rows.withColumn("date_id", ms_to_ds(F.col("create_time")))


def order_cancel(changes: DataFrame, detail: DataFrame, ttl_s: int = 1805) -> DataFrame:
    """Lines of orders that went from created to cancelled (R7), up to half an hour after the line."""
    gone = table(changes, "order_info", F.col("op") == "u", moved("order_status", "1001", "1003")).select(
        after("id").alias("_o"), after("operate_time").alias("cancel_time"), F.col("ts_ms").alias("_ts"),
        F.col("event_time").alias("_ot"))
    rows = join_order(detail.drop("date_id", "create_time"), gone, "order_id", "event_time", ttl_s)
    return rows.drop("ts").withColumnRenamed("_ts", "ts").withColumn("date_id", ms_to_ds(F.col("cancel_time")))


def payment_success(changes: DataFrame, detail: DataFrame, bound_s: int = 5) -> DataFrame:
    """Successful payments interval-joined to order lines, five seconds either way."""
    paid = table(changes, "payment_info", F.col("op") == "u", after("payment_status") == "1602").select(
        after("order_id").alias("_o"), F.md5(after("payment_type")).alias("payment_type_code"),
        after("callback_time").alias("callback_time"), F.col("ts_ms").alias("_ts"), F.col("event_time").alias("_ot"))
    rows = join_order(detail.drop("date_id", "create_time"), paid, "order_id", "event_time", bound_s)
    return rows.drop("ts").withColumnsRenamed({
        "_ts": "ts", "id": "order_detail_id", "split_total_amount": "split_payment_amount"})


def order_refund(changes: DataFrame, ttl_s: int = 10) -> DataFrame:
    """Refund requests of orders in state 1005."""
    ri = table(changes, "order_refund_info").select(
        after("id").alias("id"), after("user_id").alias("user_id"), after("order_id").alias("order_id"),
        after("sku_id").alias("sku_id"), F.md5(after("refund_type")).alias("refund_type_code"),
        after("refund_num").alias("refund_num"), after("refund_amount").alias("refund_amount"),
        F.md5(after("refund_reason_type")).alias("refund_reason_type_code"),
        after("refund_reason_txt").alias("refund_reason_txt"), after("create_time").alias("create_time"),
        F.col("ts_ms").alias("ts"), "event_time")
    oi = table(changes, "order_info", moved("order_status", None, "1005")).select(
        after("id").alias("_o"), after("province_id").alias("province_id"), F.col("event_time").alias("_ot"))
    return join_order(ri, oi, "order_id", "event_time", ttl_s).withColumn("date_id", ms_to_ds(F.col("create_time")))


def refund_payment(changes: DataFrame, ttl_s: int = 5) -> DataFrame:
    """Refund payments with the refunded quantity of an accepted refund and the closed order."""
    rp = table(changes, "refund_payment", F.col("op") == "u", moved("refund_status", None, "1602")).select(
        after("id").alias("id"), after("order_id").alias("order_id"), after("sku_id").alias("sku_id"),
        F.md5(after("payment_type")).alias("payment_type_code"), after("callback_time").alias("callback_time"),
        after("total_amount").alias("refund_amount"), F.col("ts_ms").alias("ts"), "event_time")
    ri = table(changes, "order_refund_info", F.col("op") == "u", moved("refund_status", None, "0705")).select(
        after("order_id").alias("_r"), after("sku_id").alias("_k"), after("refund_num").alias("refund_num"),
        F.col("event_time").alias("_rt"))
    oi = table(changes, "order_info", F.col("op") == "u", moved("order_status", None, "1006")).select(
        after("id").alias("_o"), after("user_id").alias("user_id"), after("province_id").alias("province_id"),
        F.col("event_time").alias("_ot"))
    rows = rp.join(ri, (F.col("order_id") == F.col("_r")) & (F.col("sku_id") == F.col("_k"))
                   & near("event_time", "_rt", ttl_s, ttl_s), "inner").drop("_r", "_k", "_rt")
    rows = join_order(rows, oi, "order_id", "event_time", ttl_s)
    return rows.withColumn("date_id", ms_to_ds(F.col("callback_time")))


def order_detail_for_board(changes: DataFrame, ttl_s: int = 10) -> DataFrame:
    """Order lines with their order, ready for the sku dimensions."""
    od = table(changes, "order_detail").select(
        after("id").alias("id"), after("order_id").alias("order_id"), after("sku_id").alias("sku_id"),
        after("sku_num").alias("sku_num"), after("split_total_amount").alias("split_total_amount"),
        F.col("ts_ms").alias("ts"), "event_time")
    oi = table(changes, "order_info", F.col("op") == "r").select(
        after("id").alias("_o"), after("user_id").alias("user_id"), after("province_id").alias("province_id"),
        F.col("event_time").alias("_ot"))
    return join_order(od, oi, "order_id", "event_time", ttl_s)


def with_sku(batch: DataFrame, sku: DataFrame) -> DataFrame:
    """Sku names and category of a batch, nulls when unknown."""
    return lookup(batch, sku, "sku_id", "id", {"sku_name": "sku_name", "category3_id": "category3_id",
                                              "tm_id": "tm_id"})


def comments(changes: DataFrame) -> DataFrame:
    """Comment records (R4); the rating code is hashed like the dictionary key."""
    return table(changes, "comment_info").select(
        after("id").alias("id"), after("user_id").alias("user_id"), after("sku_id").alias("sku_id"),
        F.md5(after("appraise")).alias("appraise"), after("comment_txt").alias("comment_txt"),
        F.col("ts_ms").alias("ts"), "event_time")


def with_names(batch: DataFrame, dic: DataFrame, roles: dict[str, str]) -> DataFrame:
    """Processing-time dictionary lookup (J21): the current table, inner, one pass per role. ``roles``: hashed code
    column -> name column."""
    keyed = dic.select(F.md5("dic_code").alias("dic_key"), "dic_name")
    for code, out in roles.items():
        batch = lookup(batch, keyed, code, "dic_key", {out: "dic_name"}, "inner")
    return batch


def cart_adds(changes: DataFrame) -> DataFrame:
    """Cart additions (R5): the quantity of a snapshot row, the increase of an update."""
    num, was = after("sku_num").cast("int"), before("sku_num").cast("int")
    grown = (F.col("op") == "u") & was.isNotNull() & (num > was)
    return table(changes, "cart_info", (F.col("op") == "r") | grown).select(
        after("id").alias("id"), after("user_id").alias("user_id"), after("sku_id").alias("sku_id"),
        F.when(F.col("op") == "r", num).otherwise(num - was).alias("sku_num"), F.col("ts_ms").alias("ts"), "event_time")


def counted(config: DataFrame) -> DataFrame:
    """A config table, to be broadcast if it has ``ROUTES`` rows at most, which is counted. The optimizer does not know the size of a table that
    lies in a database or comes from the driver: it would sort and shuffle every record by its source table instead."""
    return F.broadcast(config) if config.limit(ROUTES + 1).count() <= ROUTES else config


def routed(batch: DataFrame, config: DataFrame, match_op: bool) -> DataFrame:
    """Change records sent to the sink their config row names, restricted to its columns.

    ``config`` is the current config table: it is read again for every batch, so a changed row takes effect with
    the next one. Its rows are counted before it is broadcast.
    """
    c = config.select(F.col("source_table").alias("_t"), "sink_table", "sink_columns",
                      *([F.col("op").alias("_op")] if match_op else []), *(["sink_row_key"] if not match_op else []))
    cond = F.col("source")["table"] == F.col("_t")
    if match_op:
        cond = cond & (F.col("op") == F.col("_op"))
    return batch.join(counted(c), cond).withColumn("payload", keep_columns(live_payload(), F.col("sink_columns")))


#: Changes of the routing table, as records of their own: c, r and u set a route, d removes it.
CONFIG_CHANGE = "change string, source_table string, sink_table string, sink_columns string, op string, changed_ms bigint"


def config_history(config_log: DataFrame, keys: list[str]) -> DataFrame:
    """The routes with the time in which each is valid: from its change to the next one of its key.

    Of changes at the same time the last by name wins; a removed route ends and nothing begins. The log is one of configuration: its
    keys have few versions each, so a window per key is small."""
    per_key = Window.partitionBy(*keys).orderBy("changed_ms", "change", "sink_table", "sink_columns")
    timed = config_log.withColumn("valid_to", F.lead("changed_ms").over(per_key)).withColumnRenamed("changed_ms", "valid_from")
    return timed.where((F.col("change") != "d") & (F.col("valid_to").isNull() | (F.col("valid_to") > F.col("valid_from"))))


def fact_routes_as_of(batch: DataFrame, history: DataFrame) -> DataFrame:
    """(topic, value) of change records, each by the route that was valid at its time.

    One running query calls this for every micro-batch with the history as it stands then: what is there at the start is preloaded, a later
    change takes effect from its own time on, and a record that comes late is still routed by the table of its time."""
    c = history.select(F.col("source_table").alias("_t"), F.col("op").alias("_op"), "sink_table", "sink_columns", "valid_from", "valid_to")
    at = F.col("ts_ms")
    cond = (F.col("source")["table"] == F.col("_t")) & (F.col("op") == F.col("_op")) & (at >= F.col("valid_from")) & (F.col("valid_to").isNull() | (at < F.col("valid_to")))
    rows = batch.join(counted(c), cond).withColumn("payload", keep_columns(live_payload(), F.col("sink_columns")))
    body = F.map_concat("payload", F.create_map(F.lit("ts"), at.cast("string")))
    return rows.select(F.col("sink_table").alias("topic"), F.to_json(body).alias("value"))


def prefixed_merge(left: DataFrame, right: DataFrame, left_key: str, right_key: str, prefix: str, within_s: int) -> DataFrame:
    """Two records as one: a row of ``left`` with each row of ``right`` of its key at most ``within_s`` seconds away, whose columns get
    the prefix (J20). A key with many left rows is spread as in :func:`join_order`; the time is the left row's."""
    named = right.select(F.col(right_key).alias("_o"), F.col("event_time").alias("_ot"), *[F.col(c).alias(f"{prefix}{c}") for c in right.columns if c != "event_time"])
    return join_order(left, named, left_key, "event_time", within_s)


def fact_routes(batch: DataFrame, config: DataFrame) -> DataFrame:
    """(topic, value): whitelisted columns plus the change time."""
    rows = routed(batch, config, match_op=True)
    body = F.map_concat("payload", F.create_map(F.lit("ts"), F.col("ts_ms").cast("string")))
    return rows.select(F.col("sink_table").alias("topic"), F.to_json(body).alias("value"))


def dim_routes(batch: DataFrame, config: DataFrame) -> DataFrame:
    """Dimension upserts (R2/S21): deletes are ignored, the key is the MD5 of the configured row key."""
    rows = routed(batch.where(F.col("op") != "d"), config, match_op=False)
    return rows.select("sink_table", F.md5(F.element_at("after", F.col("sink_row_key"))).alias("row_key"),
                       F.to_json("payload").alias("value"), "ts_ms")
