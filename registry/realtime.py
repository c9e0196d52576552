"""Real-time queries. Feeds are written from the given tables as JSON lines (plus one heartbeat that lets the last
windows close), read as streams, run to the end of the data, and compared with the batch definition in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from registry.core import REG, Tables
from tidemill.functions.text import moderated
from tidemill.session import fresh_path, settings, shuffles_removed
from tidemill.sources.upsert import KeyedTable
from tidemill.streaming import facts, logs, metrics
from tidemill.streaming.bloom import bloom_deduplicated
from tidemill.streaming.closing import Part, Stream, closed_results
from tidemill.streaming.sinks import drain, files_writer, run_to_table
from tidemill.streaming.sources import LOG, change_log, json_lines
from tidemill.streaming.state import live, only_newer

T = REG.tables
_FEEDS: dict[tuple[str, str, str], str] = {}
_ORDERED: dict[str, int] = {}  # paths of feeds cut by time, and the files of every slice
BEAT_MS = 4 * 86_400_000


ROWS_A_FILE = 250_000  # of the given orders, lines and events, about
FILES_A_BATCH = 16  # files of that size are a slice of time, which a stream reads as one batch
SLICE = "slice"
FEED = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}
# Parquet for long texts that are written once; a small row group, as a task holds one in memory
PACKED = {"parquet.compression.codec.zstd.level": "9", "parquet.page.size": str(4 << 20), "parquet.block.size": str(32 << 20)}


def feed(t: Tables, name: str, build: Callable[[Tables], DataFrame]) -> str:
    """Path of a feed, written once per session and data folder. ``build`` gives ``value`` and, as ``at``, the time of the record.

    The lines repeat their column names, so they are compressed: a fifth of the space, and the source reads them as they are. A large
    feed with times is cut by them into slices that follow each other, as a topic does: what a stream reads slice by slice is never
    late, and its state holds one slice and the lifetime, not everything. Every task writes its own file of a slice, so cutting
    moves no lines between tasks, and the shuffles of the build are removed with its end."""
    key = (t.spark.sparkContext.applicationId, t.sf_dir, name)
    if key not in _FEEDS:
        path = fresh_path(t.spark, f"feed-{name}")
        with shuffles_removed(t.spark):
            rows = build(t)
            slices = -(-sum(t[b].count() for b in ("orders", "lineitem", "events")) // (ROWS_A_FILE * FILES_A_BATCH)) if "at" in rows.columns else 1
            if slices > 1:
                cuts = rows.agg(F.percentile_approx("at", [i / slices for i in range(1, slices)], 10_000).alias("c")).first().c or []
                number = sum((F.coalesce(F.col("at") > c, F.lit(False)).cast("int") for c in sorted(set(cuts))), F.lit(0))
                rows.select("value", number.alias(SLICE)).write.options(**FEED).partitionBy(SLICE).text(path)
                files = in_order(t.spark, path)
                if files:
                    _ORDERED[path] = files
            else:
                rows.select("value").write.options(**FEED).text(path)
        _FEEDS[key] = path
    return _FEEDS[key]


def in_order(spark, path: str) -> int:
    """Date the files of the slices by the numbers of these, as a stream takes files by age, and give every slice the same number of files (empty
    ones fill up), which is returned: so many are a batch. 0 if the store keeps dates of its own."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    folder = hadoop(path)
    store = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    slices = sorted((f.getPath() for f in store.listStatus(folder) if f.getPath().getName().startswith(f"{SLICE}=")), key=lambda p: int(p.getName().split("=")[1]))
    most = max(len(store.listStatus(s)) for s in slices)
    for s in slices:
        for i in range(len(store.listStatus(s)), most):
            store.create(hadoop(s, f"part-empty-{i}.txt")).close()
    last = max(f.getModificationTime() for s in slices for f in store.listStatus(s))
    for i, s in enumerate(slices):
        for f in store.listStatus(s):
            store.setTimes(f.getPath(), last - (len(slices) - i) * 1000, -1)
    dated = [[f.getModificationTime() for f in store.listStatus(s)] for s in slices]
    return most if all(max(a) < min(b) for a, b in zip(dated, dated[1:])) else 0


def _json(*cols) -> Column:
    return F.to_json(F.struct(*cols)).alias("value")


def _beat(df: DataFrame, ts: str, lines: DataFrame, out: str = "ts") -> DataFrame:
    """Add the heartbeat: a record with nothing but a time four days after everything else."""
    return lines.unionByName(df.agg((F.max(ts) + BEAT_MS).alias(out)).select(_json(out), F.col(out).alias("at")))


def _common() -> Column:
    return F.struct("mid", "uid", "vc", "ch", "ar", "is_new").alias("common")


def _page() -> Column:
    return F.struct("page_id", "last_page_id", "item", "item_type", "during_time").alias("page")


def raw_log(t: Tables) -> DataFrame:
    kind = F.col("kind")
    pairs = [F.create_map(F.lit("item"), F.lit(f"a{i}"), F.lit("pos"), F.lit(str(i))) for i in (1, 2)]
    line = F.to_json(F.struct(
        _common(), F.when(kind != "signup", _page()).alias("page"),
        F.when(kind == "signup", F.create_map(F.lit("entry"), F.lit("icon"))).alias("start"),
        F.when(kind == "error", F.create_map(F.lit("code"), F.col("k").cast("string"))).alias("err"),
        F.when(kind == "view", F.array(*pairs)).alias("displays"),
        F.when(kind == "click", F.array(F.create_map(F.lit("action_id"), F.lit("fav")))).alias("actions"), "ts"))
    broken = F.concat(F.lit("broken "), F.col("event_id").cast("string"))
    return t["log_events"].select(F.when(F.col("k") == 13, broken).otherwise(line).alias("value"))


def page_topic(t: Tables) -> DataFrame:
    rows = t["log_events"].where(F.col("kind") != "signup")
    return _beat(rows, "ts", rows.select(_json(_common(), _page(), "ts"), F.col("ts").alias("at")))


def _record(table: str, columns: dict[str, Column], op: Column, was: dict[str, Column], ts_ms: Column) -> Column:
    def known(values: dict[str, Column]) -> Column:  # fields that are null are not written
        return F.struct(*[v.cast("string").alias(c) for c, v in values.items()])

    old = [known(was).alias("before")] if was else []
    return _json(op.alias("op"), *old, known(columns).alias("after"), F.struct(F.lit(table).alias("table")).alias("source"), ts_ms.alias("ts_ms"))


def _envelope(df: DataFrame, table: str, columns: list[str], op: Column, was: dict[str, Column]) -> DataFrame:
    return df.select(_record(table, {c: F.col(c) for c in columns}, op, was, F.col("ts_ms")), F.col("ts_ms").alias("at"))


DETAIL = ["id", "order_id", "sku_id", "sku_name", "create_time", "sku_num", "order_price", "split_activity_amount",
          "split_coupon_amount", "split_total_amount"]


def change_topic(t: Tables) -> DataFrame:
    r, u = F.lit("r"), F.lit("u")
    od = t["chg_order_detail"]
    oi = t["chg_order_info"].withColumnRenamed("status", "order_status").withColumn(
        "operate_time", F.col("ts_ms").cast("string"))
    # a line's own record and those of its activity and coupon come from one pass over the joined lines
    act = {"order_detail_id": F.col("id"), "activity_id": F.col("sku_id"), "activity_rule_id": F.lit("7")}
    cou = {"order_detail_id": F.col("id"), "coupon_id": F.col("sku_id")}

    late = F.explode(F.array_compact(F.array(F.lit(0), F.when(F.col("l_discount") > 0.05, 1000), F.when(F.col("l_tax") > 0.04, 2000))))
    of_line = od.withColumn("late", late).withColumn("at", F.col("ts_ms") + F.col("late"))

    def line(table: str, columns: dict[str, Column]) -> Column:
        return _record(table, columns, r, {}, F.col("at"))

    detail = F.when(F.col("late") == 0, line("order_detail", {c: F.col(c) for c in DETAIL})).when(
        F.col("late") == 1000, line("order_detail_activity", act)).otherwise(line("order_detail_coupon", cou))
    ri = t["chg_refund_info"].withColumn("refund_status", F.lit("0705"))
    rp = t["chg_refund_payment"].withColumn("refund_status", F.lit("1602"))
    cart = t["chg_cart_info"]
    parts = [
        _envelope(oi, "order_info", ["id", "user_id", "province_id", "order_status", "operate_time"], F.col("op"),
                  {"order_status": F.col("was")}),
        of_line.select(detail.alias("value"), "at"),
        _envelope(t["chg_payment_info"], "payment_info", ["user_id", "order_id", "payment_type", "payment_status",
                                                          "callback_time"], u, {"payment_status": F.lit("1601")}),
        _envelope(ri, "order_refund_info", ["id", "user_id", "order_id", "sku_id", "refund_type", "refund_reason_type",
                                            "refund_reason_txt", "refund_num", "refund_amount", "create_time",
                                            "refund_status"], u, {"refund_status": F.lit("0701")}),
        _envelope(rp, "refund_payment", ["id", "order_id", "sku_id", "payment_type", "callback_time", "total_amount",
                                         "refund_status"], u, {"refund_status": F.lit("1601")}),
        _envelope(t["chg_comment_info"], "comment_info", ["id", "user_id", "sku_id", "appraise", "comment_txt"], r, {}),
        _envelope(cart, "cart_info", ["id", "user_id", "sku_id", "sku_num"], F.col("op"), {"sku_num": F.col("was")}),
    ]
    lines = parts[0]
    for p in parts[1:]:
        lines = lines.unionByName(p)
    return _beat(t["chg_cart_info"], "ts_ms", lines, "ts_ms")


def _flat_topic(name: str, cols: list[str], ts: str):
    def build(t: Tables) -> DataFrame:
        rows = t[name].withColumn("ts", F.col(ts))
        return _beat(rows, "ts", rows.select(_json(*cols, "ts"), F.col("ts").alias("at")))
    return build


def lines(t: Tables, name: str, build, timed: bool = False) -> DataFrame:
    """A feed as a stream; ``timed``: in several batches that follow each other in time, when it is large and cut that way."""
    path = feed(t, name, build)
    return json_lines(t.spark, path, _ORDERED.get(path) if timed else None).select("value")


def pages(t: Tables, delay: str = "3 seconds") -> DataFrame:
    rec = F.from_json("value", LOG).alias("r")
    return metrics.clocked(lines(t, "page", page_topic).select(rec).select("r.*"), "ts", delay)


def changes(t: Tables, delay: str = "5 seconds", timed: bool = False) -> DataFrame:
    return change_log(lines(t, "change", change_topic, timed)).withWatermark("event_time", delay)


def flat(t: Tables, topic: str, build, schema: str, delay: str, timed: bool = False) -> DataFrame:
    rec = F.from_json("value", schema + ", ts bigint").alias("r")
    return metrics.clocked(lines(t, topic, build, timed).select(rec).select("r.*"), "ts", delay)


VERSION_COLS = ["id", "order_id", "user_id", "sku_id", "sku_name", "province_id", "split_original_amount",
                "split_activity_amount", "split_coupon_amount", "split_total_amount"]


def details(t: Tables, delay: str, timed: bool = True) -> DataFrame:
    return flat(t, "detail", _flat_topic("dwd_detail_versions", VERSION_COLS, "ts"),
                ", ".join(f"{c} string" for c in VERSION_COLS), delay, timed)


def micro(df: DataFrame, label: str, transform: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Apply a batch transform to every micro-batch and return everything written."""
    spark = df.sparkSession
    out, ckpt = fresh_path(spark, label), fresh_path(spark, f"{label}-ckpt")
    shape = transform(spark.createDataFrame([], df.schema)).schema

    def run(batch: DataFrame, batch_id: int) -> None:
        transform(batch).write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    drain(df.writeStream.foreachBatch(run).option("checkpointLocation", ckpt))
    return spark.read.schema(shape).parquet(f"{out}/*")


def done(df: DataFrame, label: str) -> DataFrame:
    """Run to the end; the event time only served the joins and windows."""
    return run_to_table(df.drop("event_time"), label)


def records(t: Tables, *tables: str) -> Stream:
    """The change log in the order of time; of other tables only the times."""
    return Stream(changes(t, timed=True), 5, F.col("source")["table"].isin(*tables))


def joined(streams: list[Stream], job: Callable[..., DataFrame], label: str, ahead_s: float, back_s: float | None = None) -> DataFrame:
    """Rows joined to others at most so many seconds after and before them."""
    return closed_results(streams, [Part(job, ahead_s, ahead_s if back_s is None else back_s)], label)[0]


def window_part(job: Callable[..., DataFrame], back_s: float) -> Part:
    """Window results, each closed at its end; ``back_s`` is the reach of a window, with the lifetime before it."""
    return Part(job, 0, back_s, F.col("edt").cast("timestamp"))


# ---------------------------------------------------------------- R1 log splitter
def r1(t: Tables) -> DataFrame:
    out, memory = fresh_path(t.spark, "split"), fresh_path(t.spark, "memory")
    drain(lines(t, "raw", raw_log).writeStream.foreachBatch(logs.split_batches(out, memory))
          .option("checkpointLocation", fresh_path(t.spark, "split-ckpt")))
    rows = t.spark.read.schema("value string, route string, batch int").option("basePath", out).parquet(f"{out}/batch=*")
    j = F.get_json_object
    return rows.select(
        "route", F.when(F.col("route") == "dirty", F.col("value")).alias("line"), j("value", "$.common.mid").alias("mid"),
        j("value", "$.common.is_new").alias("is_new"), j("value", "$.page.page_id").alias("page_id"),
        j("value", "$.display.pos").alias("pos"), j("value", "$.action.action_id").alias("action"),
        j("value", "$.err.code").alias("code"), j("value", "$.start.entry").alias("entry"),
        j("value", "$.ts").cast("bigint").alias("ts"))


T["log_good"] = """
select e.*, strftime(make_timestamp_ms(ts), '%Y-%m-%d') as day,
  case when is_new = '1' and strftime(make_timestamp_ms(ts), '%Y-%m-%d') <> first_day then '0' else is_new end as fixed
from log_events e join (select mid, strftime(make_timestamp_ms(min(ts)), '%Y-%m-%d') as first_day from log_events
  where k <> 13 group by 1) f using (mid) where k <> 13"""
N = "cast(null as varchar)"
REG.query("R1_log_split", r1, f"""
select 'dirty' as route, 'broken ' || event_id as line, {N} as mid, {N} as is_new, {N} as page_id, {N} as pos,
  {N} as action, {N} as code, {N} as entry, cast(null as bigint) as ts from log_events where k = 13
union all select 'err', null, mid, fixed, null, null, null, cast(k as varchar), null, ts from log_good where kind = 'error'
union all select 'start', null, mid, fixed, null, null, null, null, 'icon', ts from log_good where kind = 'signup'
union all select 'display', null, mid, fixed, page_id, pos, null, null, null, ts from log_good,
  (values ('1'), ('2')) p(pos) where kind = 'view'
union all select 'action', null, mid, fixed, page_id, null, 'fav', null, null, ts from log_good where kind = 'click'
union all select 'page', null, mid, fixed, page_id, null, null, null, null, ts from log_good where kind <> 'signup'""")


# ---------------------------------------------------------------- R2, R3 routers
def dim_config(t: Tables) -> DataFrame:
    return t.spark.createDataFrame([("order_info", "dim_order", "id,province_id", "id"),
                                    ("comment_info", "dim_comment", "id,appraise", "id")],
                                   "source_table string, sink_table string, sink_columns string, sink_row_key string")


def fact_config(t: Tables) -> DataFrame:
    return t.spark.createDataFrame([("cart_info", "dwd_cart", "id,sku_num", "u"),
                                    ("order_detail_coupon", "dwd_coupon", "order_detail_id,coupon_id", "r")],
                                   "source_table string, sink_table string, sink_columns string, op string")


def r2(t: Tables) -> DataFrame:
    table = KeyedTable(t.spark, fresh_path(t.spark, "dims"), ["sink_table", "row_key"])

    def run(batch: DataFrame, batch_id: int) -> None:
        table.merge(facts.dim_routes(batch, dim_config(t)), ["ts_ms", "value"])

    drain(changes(t).drop("event_time").writeStream.foreachBatch(run)
          .option("checkpointLocation", fresh_path(t.spark, "dims-ckpt")))
    j = F.get_json_object
    return table.read().select("sink_table", "row_key", j("value", "$.id").alias("id"), F.coalesce(
        j("value", "$.province_id"), j("value", "$.appraise")).alias("attr"),
        j("value", "$.order_status").alias("not_listed"), "ts_ms")


def raw_copy(t: Tables) -> DataFrame:
    """The router's other output: the change log as it came, forwarded to a topic of its own and read back.

    The copy is as long as the log, so it is packed harder than the feed: Parquet pages of 4 MB, in which zstd finds the names and values that
    neighbouring records share; gzip looks back 32 KB only."""
    path = fresh_path(t.spark, "raw-changes")
    writer = files_writer(lines(t, "change", change_topic).select("value"), path, fresh_path(t.spark, "raw-changes-ckpt"))
    with settings(t.spark, PACKED):  # the file sink takes them from the session, not from its options
        drain(writer.option("compression", "zstd"))
    j = F.get_json_object
    rows = t.spark.read.schema("value string").parquet(path).select(
        j("value", "$.source.table").alias("source_table"), j("value", "$.op").alias("op"), j("value", "$.ts_ms").cast("bigint").alias("ts_ms"))
    return rows.where(F.col("source_table").isNotNull())


REG.query("R2_raw_copy", raw_copy, """
select 'order_info' as source_table, op, ts_ms from chg_order_info
union all select 'order_detail', 'r', ts_ms from chg_order_detail
union all select 'order_detail_activity', 'r', ts_ms + 1000 from chg_order_detail where l_discount > 0.05
union all select 'order_detail_coupon', 'r', ts_ms + 2000 from chg_order_detail where l_tax > 0.04
union all select 'payment_info', 'u', ts_ms from chg_payment_info
union all select 'order_refund_info', 'u', ts_ms from chg_refund_info
union all select 'refund_payment', 'u', ts_ms from chg_refund_payment
union all select 'cart_info', op, ts_ms from chg_cart_info
union all select 'comment_info', 'r', ts_ms from chg_comment_info""")
REG.query("R2_dim_router", r2, """
select 'dim_order' as sink_table, md5(id) as row_key, id, province_id as attr, cast(null as varchar) as not_listed,
  max(ts_ms) as ts_ms from chg_order_info group by id, province_id
union all select 'dim_comment', md5(id), id, appraise, null, max(ts_ms) from chg_comment_info group by id, appraise""")


def r3(t: Tables) -> DataFrame:
    rows = micro(changes(t).drop("event_time"), "facts", lambda b: facts.fact_routes(b, fact_config(t)))
    j = F.get_json_object
    return rows.select("topic", F.coalesce(j("value", "$.id"), j("value", "$.order_detail_id")).alias("id"),
                       F.coalesce(j("value", "$.sku_num"), j("value", "$.coupon_id")).alias("v"),
                       j("value", "$.user_id").alias("not_listed"), j("value", "$.ts").cast("bigint").alias("ts"))


REG.query("R3_fact_router", r3, """
select 'dwd_cart' as topic, id, sku_num as v, cast(null as varchar) as not_listed, ts_ms as ts from chg_cart_info
where op = 'u'
union all select 'dwd_coupon', id, sku_id, null, ts_ms + 2000 from chg_order_detail where l_tax > 0.04""")

# ---------------------------------------------------------------- R4 - R11 facts
DICS = "(select md5(dic_code) as dic_key, dic_name from ods_base_dic)"
REG.query("R4_comment_fact", lambda t: micro(
    facts.comments(changes(t)).drop("event_time"), "comments",
    lambda b: facts.with_names(b, t["ods_base_dic"], {"appraise": "appraise_name"})), f"""
select id, user_id, sku_id, md5(appraise) as appraise, dic_name as appraise_name, comment_txt, ts_ms as ts
from chg_comment_info join {DICS} on md5(appraise) = dic_key""")
REG.query("R5_cart_add_fact", lambda t: done(facts.cart_adds(changes(t)), "carts"), """
select id, user_id, sku_id, cast(if(op = 'r', cast(sku_num as int), cast(sku_num as int) - cast(was as int)) as int)
  as sku_num, ts_ms as ts
from chg_cart_info where op = 'r' or (was is not null and cast(sku_num as int) > cast(was as int))""")
T["rt_order_detail"] = """
select d.id, d.order_id, d.sku_id, sku_name, create_time, sku_num,
  cast(cast(cast(sku_num as decimal(16,2)) * cast(order_price as decimal(16,2)) as decimal(16,2)) as varchar)
    as split_original_amount, split_activity_amount, split_coupon_amount, split_total_amount, d.ts_ms as ts,
  user_id, province_id, if(l_discount > 0.05, d.sku_id, null) as activity_id,
  if(l_discount > 0.05, '7', null) as activity_rule_id, if(l_tax > 0.04, d.sku_id, null) as coupon_id,
  strftime(make_timestamp_ms(cast(create_time as bigint)), '%Y-%m-%d') as date_id
from chg_order_detail d join chg_order_info o on d.order_id = o.id and o.op = 'r'"""
REG.query("R6_order_detail_fact", lambda t: joined(
    [records(t, "order_detail", "order_info", "order_detail_activity", "order_detail_coupon")], facts.order_detail, "detail", 10),
          "select * from rt_order_detail")
DETAIL_SCHEMA = ", ".join(f"{c} string" for c in (
    "id", "order_id", "user_id", "sku_id", "sku_name", "province_id", "sku_num", "split_original_amount",
    "split_activity_amount", "split_coupon_amount", "split_total_amount"))
Tables.jobs["rt_detail_topic"] = (lambda t, d: t["chg_order_detail"].join(
    t["chg_order_info"].where(F.col("op") == "r").select(F.col("id").alias("order_id"), "user_id", "province_id"),
    "order_id").withColumn("split_original_amount", F.col("order_price")), "order")


def detail_topic(t: Tables) -> Stream:
    cols = [c.split()[0] for c in DETAIL_SCHEMA.split(", ")]
    rows = flat(t, "detail1", _flat_topic("rt_detail_topic", cols, "ts_ms"), DETAIL_SCHEMA, "5 seconds", True)
    return Stream(rows, 5)


T["rt_detail_topic"] = """
select d.id, order_id, user_id, d.sku_id, sku_name, province_id, sku_num, order_price as split_original_amount,
  split_activity_amount, split_coupon_amount, split_total_amount, d.ts_ms as dts
from chg_order_detail d join chg_order_info o on d.order_id = o.id and o.op = 'r'"""
REG.query("R7_order_cancel_fact", lambda t: joined([records(t, "order_info"), detail_topic(t)], facts.order_cancel, "cancel", 1805), """
select d.* exclude (dts), cast(ts_ms as varchar) as cancel_time, ts_ms as ts,
  strftime(make_timestamp_ms(ts_ms), '%Y-%m-%d') as date_id
from rt_detail_topic d join (select id as oid, ts_ms from chg_order_info where status = '1003') on order_id = oid
where abs(dts - ts_ms) <= 1805000""")
REG.query("R8_payment_success_fact", lambda t: joined(
    [records(t, "payment_info"), detail_topic(t)], lambda c, d: facts.with_names(
        facts.payment_success(c, d), t["ods_base_dic"], {"payment_type_code": "payment_type_name"}), "paid", 5), f"""
select d.* exclude (dts, id, split_total_amount, user_id), d.id as order_detail_id, d.user_id,
  split_total_amount as split_payment_amount, md5(payment_type) as payment_type_code, dic_name as payment_type_name,
  callback_time, ts_ms as ts
from rt_detail_topic d join chg_payment_info p on d.order_id = p.order_id and payment_status = '1602'
  and abs(dts - ts_ms) <= 5000 join {DICS} on md5(payment_type) = dic_key""")
REG.query("R9_order_refund_fact", lambda t: joined(
    [records(t, "order_refund_info", "order_info")], lambda c: facts.with_names(facts.order_refund(c), t["ods_base_dic"], {
        "refund_type_code": "refund_type_name", "refund_reason_type_code": "refund_reason_type_name"}), "refund", 10), f"""
select r.id, r.user_id, order_id, sku_id, province_id, strftime(make_timestamp_ms(cast(create_time as bigint)), '%Y-%m-%d')
  as date_id, create_time, md5(refund_type) as refund_type_code, a.dic_name as refund_type_name,
  md5(refund_reason_type) as refund_reason_type_code, b.dic_name as refund_reason_type_name, refund_reason_txt,
  refund_num, refund_amount, r.ts_ms as ts
from chg_refund_info r join chg_order_info o on order_id = o.id and status = '1005' and abs(r.ts_ms - o.ts_ms) <= 10000
join {DICS} a on md5(refund_type) = a.dic_key join {DICS} b on md5(refund_reason_type) = b.dic_key""")
REG.query("R10_refund_payment_fact", lambda t: joined(
    [records(t, "refund_payment", "order_refund_info", "order_info")], lambda c: facts.with_names(
        facts.refund_payment(c), t["ods_base_dic"], {"payment_type_code": "payment_type_name"}), "refundpay", 5), f"""
select p.id, o.user_id, p.order_id, p.sku_id, province_id, md5(payment_type) as payment_type_code,
  dic_name as payment_type_name, strftime(make_timestamp_ms(cast(callback_time as bigint)), '%Y-%m-%d') as date_id,
  callback_time, refund_num, total_amount as refund_amount, p.ts_ms as ts
from chg_refund_payment p
join chg_refund_info r on p.order_id = r.order_id and p.sku_id = r.sku_id and abs(p.ts_ms - r.ts_ms) <= 5000
join chg_order_info o on p.order_id = o.id and status = '1006' and abs(p.ts_ms - o.ts_ms) <= 5000
join {DICS} on md5(payment_type) = dic_key""")


def _text_sku(t: Tables) -> DataFrame:
    """Sku dimension keyed the way the feeds spell ids."""
    return t["ods_sku_info"].withColumn("id", F.col("id").cast("string"))


REG.query("R11_order_detail_board", lambda t: joined(
    [records(t, "order_detail", "order_info")], lambda c: facts.with_sku(facts.order_detail_for_board(c), _text_sku(t)), "board", 10), """
select d.id, order_id, d.sku_id, sku_num, split_total_amount, d.ts_ms as ts, user_id, province_id, s.sku_name,
  category3_id, tm_id from chg_order_detail d join chg_order_info o on d.order_id = o.id and o.op = 'r'
left join ods_sku_info s on d.sku_id = cast(s.id as varchar)""")


# ---------------------------------------------------------------- R12 - R23 windows
def win(ts: str, seconds: int) -> str:
    """Window columns of a tumbling window of so many seconds."""
    start = f"({ts} // {seconds * 1000} * {seconds * 1000})"
    f = "strftime(make_timestamp_ms({}), '%Y-%m-%d %H:%M:%S')"
    return (f"{f.format(start)} as stt, {f.format(f'{start} + {seconds * 1000}')} as edt, "
            f"strftime(make_timestamp_ms({start}), '%Y-%m-%d') as cur_date")


T["page_log"] = "select * from log_events where kind <> 'signup'"
REG.query("R12_keyword_page_view", lambda t: done(metrics.keyword_views(pages(t, "5 seconds")), "keywords"), f"""
select * replace (replace(cur_date, '-', '') as cur_date) from (
  select {win('ts', 259200)}, keyword, count(*) as keyword_count from (
    select ts, unnest(string_split(lower(item), ' ')) as keyword from page_log
    where last_page_id = 'search' and item_type = 'keyword' and item is not null) group by all)""")
DAY = "ts // 86400000"
REG.query("R13_page_view_window", lambda t: done(metrics.page_views(pages(t)), "views"), f"""
select {win('ts', 10)}, vc, ch, ar, is_new, cast(sum(uv) as bigint) as uv_ct, cast(sum(sv) as bigint) as sv_ct,
  count(*) as pv_ct, cast(sum(during_time) as bigint) as dur_sum from (
  select *, if(row_number() over (partition by mid, {DAY} order by ts, vc, ch, ar, is_new) = 1, 1, 0) as uv,
    if(coalesce(last_page_id, '') = '', 1, 0) as sv from page_log) group by all""")
REG.query("R14_home_detail_page_view", lambda t: done(metrics.home_detail_visitors(pages(t)), "homes"), f"""
select {win('ts', 5)}, count(*) filter (where page_id = 'home') as home_uv_ct,
  count(*) filter (where page_id = 'good_detail') as good_detail_uv_ct from (
  select min(ts) as ts, mid, page_id from page_log where page_id in ('home', 'good_detail')
  group by mid, page_id, {DAY}) group by all""")
REG.query("R15_user_login", lambda t: done(metrics.logins(pages(t)), "logins"), f"""
select {win('ts', 1)}, count(*) filter (where d - prev >= 8) as back_ct, count(*) as uu_ct from (
  select *, lag(d) over (partition by uid order by d) as prev from (
    select uid, {DAY} as d, min(ts) as ts from page_log where uid is not null and last_page_id in ('', 'login')
    group by uid, d)) group by all""")
SIGNUPS = ("user_id bigint", ["user_id"])


def _event_topic(kind: str):
    def build(t: Tables) -> DataFrame:
        rows = t["events"].where(F.col("event_type") == kind).select(
            "user_id", F.unix_millis(F.col("ts").cast("timestamp")).alias("ts"))
        return _beat(rows, "ts", rows.select(_json("user_id", "ts"), F.col("ts").alias("at")))
    return build


REG.query("R16_user_register", lambda t: done(metrics.registrations(
    flat(t, "signup", _event_topic("signup"), "user_id bigint", "0 seconds")), "registers"), f"""
select {win('(epoch_us(ts) // 1000)', 10)}, count(*) as register_ct from events where event_type = 'signup' group by all""")
REG.query("R17_cart_add_users", lambda t: done(metrics.cart_add_users(
    flat(t, "cart", _event_topic("click"), "user_id bigint", "0 seconds")), "cartusers"), f"""
select {win('ts', 5)}, count(*) as cart_add_uu_ct from (select min(epoch_us(ts) // 1000) as ts from events
  where event_type = 'click' group by user_id, cast(ts as date)) group by all""")


def unique_new(prefix: str, table: str) -> str:
    return f"""
select {win('ts', 5)}, count(*) as {prefix}_unique_user_count,
  cast(sum(if(ts = first_ts, 1, 0)) as bigint) as {prefix}_new_user_count from (
  select user_id, min(ts) as ts, min(min(ts)) over (partition by user_id) as first_ts from {table}
  group by user_id, {DAY}) group by all"""


REG.query("R18_order_users", lambda t: done(metrics.unique_and_new_users(details(t, "5 seconds", False), "order"), "ousers"),
          unique_new("order", "dwd_detail_versions"))


def _paid(t: Tables) -> DataFrame:
    return flat(t, "pay", _flat_topic("chg_payment_info", ["user_id"], "ts_ms"), "user_id string", "3 seconds")


T["pay_times"] = "select user_id, ts_ms as ts from chg_payment_info"
REG.query("R19_payment_users", lambda t: done(metrics.unique_and_new_users(_paid(t), "payment"), "pusers"),
          unique_new("payment", "pay_times"))
AMTS = {"split_original_amount": "original_amount", "split_activity_amount": "activity_reduce_amount",
        "split_coupon_amount": "coupon_reduce_amount", "split_total_amount": "order_amount"}


#: Every version, and the version before it taken back at its time when that is at most ten seconds older.
T["signed"] = """
select ts, 1 as sign, * exclude (ts, nxt) from followed
union all select nxt, -1, * exclude (ts, nxt) from followed where nxt - ts <= 10000"""
T["followed"] = """
select ts, id, sku_id, province_id, split_original_amount, split_activity_amount, split_coupon_amount, split_total_amount,
  lead(ts) over (partition by id order by ts) as nxt from dwd_detail_versions"""


def amount(col: str, out: str) -> str:
    return f"cast(sum(sign * coalesce(cast({col} as decimal(16,4)), 0)) as double) as {out}"


def version_stream(t: Tables, delay_s: int, *cols: str) -> Stream:
    """Versions of the order lines in the order of time, with the columns that are needed."""
    return Stream(details(t, f"{delay_s} seconds").select(*cols, "event_time"), delay_s)


REG.query("R20_sku_orders", lambda t: metrics.with_sku_names(
    closed_results([version_stream(t, 0, "id", "ts", "sku_id", *AMTS)], [window_part(metrics.sku_orders, 15)], "skuorders")[0],
    t.with_tables(ods_sku_info=_text_sku(t))), f"""
select x.*, sku_name, spu_id, tm_id, category3_id, spu_name, tm_name, category3_name, category2_id, category2_name,
  category1_id, category1_name from (
  select {win('ts', 5)}, sku_id, {', '.join(amount(c, o) for c, o in AMTS.items())} from signed group by all) x
left join dim_sku_full s on x.sku_id = cast(s.id as varchar)""")


def r21(t: Tables) -> DataFrame:
    rows = version_stream(t, 0, "id", "ts", "province_id", "order_id", "split_total_amount")
    parts = [window_part(lambda d, k=k: metrics.province_orders(d)[k], 20) for k in range(2)]  # amounts, orders
    both = metrics.joined_windows(closed_results([rows], parts, "provinces"), ["province_id"])
    provinces = t["ods_base_province"].withColumn("id", F.col("id").cast("string"))
    from tidemill.operators.dims import lookup
    return lookup(both, provinces, "province_id", "id", {"province_name": "name"})


REG.query("R21_province_orders", r21, f"""
select a.*, order_count, p.name as province_name from (
  select {win('ts', 10)}, province_id, {amount('split_total_amount', 'order_amount')} from signed group by all) a
left join (select {win('ts', 10)}, province_id, count(distinct order_id) as order_count from dwd_detail_versions
  group by all) o on a.stt = o.stt and a.province_id = o.province_id
left join ods_base_province p on a.province_id = cast(p.id as varchar)""")
REFUND = ["id", "user_id", "order_id", "sku_id"]
REG.query("R22_refund_users", lambda t: micro(metrics.refunds(
    flat(t, "refund", _flat_topic("chg_refund_info", REFUND, "ts_ms"), ", ".join(f"{c} string" for c in REFUND),
         "5 seconds"), _text_sku(t)), "refunds", lambda b: metrics.with_refund_names(b, t)), f"""
select x.*, tm_name as trademark_name, category3_name, category2_id, category2_name, category1_id, category1_name from (
  select {win('r.ts_ms', 5)}, tm_id as trademark_id, category3_id, user_id, count(distinct order_id) as refund_count
  from chg_refund_info r left join ods_sku_info s on r.sku_id = cast(s.id as varchar) group by all) x
left join ods_base_trademark t on trademark_id = t.id
left join (select id, name as category3_name, category2_id from ods_base_category3) c3 on x.category3_id = c3.id
left join (select id, name as category2_name, category1_id from ods_base_category2) c2 on category2_id = c2.id
left join (select id, name as category1_name from ods_base_category1) c1 on category1_id = c1.id""")
REG.query("R23_sku_visitors", lambda t: closed_results(
    [version_stream(t, 300, "sku_name", "user_id")], [window_part(metrics.sku_visitors, 3600)], "skuuv")[0], f"""
select {win('ts', 3600)}, sku_name, count(distinct user_id) as uv_cnt from dwd_detail_versions group by all""")


# ---------------------------------------------------------------- R24 moderation, X17 - X19 duplicate filters
def words(t: Tables) -> DataFrame:
    """The listed words: every last token that two or more comments share."""
    last = F.element_at(F.split("comment_txt", ","), -1)
    return t["chg_comment_info"].groupBy(last.alias("word")).count().where("count > 1").select("word")


REG.query("R24_comment_moderation", lambda t: micro(
    facts.comments(changes(t)).select("id", "comment_txt", "ts"), "moderated",
    lambda b: moderated(b, "comment_txt", words(t))).drop("comment_txt"), """
select id, ts_ms as ts, if(w.word is null, 0, 1) as is_violation, if(w.word is null, null, 'P0') as violation_grade,
  w.word as violation_msg
from (select *, string_split(comment_txt, ',')[-1] as lst from chg_comment_info) c left join (
  select string_split(comment_txt, ',')[-1] as word from chg_comment_info group by 1 having count(*) > 1) w
on lst = w.word""")


def versions(t: Tables, timed: bool = True) -> DataFrame:
    rows = details(t, "5 seconds", timed).where(live(F.col("id").isNotNull()))
    return rows.select(F.col("order_id").alias("id"), F.col("ts").alias("ts_ms"), "event_time")


REG.query("X17_only_newer", lambda t: done(only_newer(versions(t, False)), "newer"), """
select distinct order_id as id, ts as ts_ms from dwd_detail_versions""")
REG.query("X18_exact_duplicates", lambda t: run_to_table(
    versions(t).dropDuplicates(["id", "ts_ms", "event_time"]).drop("event_time"), "exact"), """
select distinct order_id as id, ts as ts_ms from dwd_detail_versions""")
REG.query("X19_order_ts_duplicates", lambda t: run_to_table(
    versions(t).withColumn("key", F.concat_ws("_", "id", "ts_ms")).dropDuplicatesWithinWatermark(["key"])
    .select("key"), "keys"), """
select distinct order_id || '_' || ts as key from dwd_detail_versions""")
BLOOM_RATE = 0.01


def repeated(t: Tables) -> DataFrame:
    """Comments in four slices of time, each sent again in the next file, as (key, ts)."""
    path = fresh_path(t.spark, "repeated")
    rows = t["chg_comment_info"].select(F.concat_ws("_", "id", "ts_ms").alias("key"), F.col("ts_ms").alias("ts"))
    cuts = rows.agg(F.percentile_approx("ts", [0.25, 0.5, 0.75], 10_000).alias("c")).first().c or []
    edges = [None, *cuts, None]
    for low, high in zip(edges[:-1], edges[1:]):
        part = rows
        if low is not None:
            part = part.where(F.col("ts") > low)
        if high is not None:
            part = part.where(F.col("ts") <= high)
        for _ in range(2):  # one file a batch, in the order of writing
            part.coalesce(1).write.mode("append").json(path)
    return t.spark.readStream.schema("key string, ts bigint").option("maxFilesPerTrigger", 1).json(path)


def bloom(t: Tables) -> DataFrame:
    """What the filter lets through, against the exact set of keys."""
    rows = metrics.clocked(repeated(t), "ts", "2 hours")
    passed = run_to_table(bloom_deduplicated(rows, "key", "4 hours", 2_000, BLOOM_RATE), "bloom")
    seen = passed.agg(F.count(F.lit(1)).alias("passed"), F.count_distinct("key").alias("distinct_keys"))
    every = t["chg_comment_info"].select(F.count_distinct(F.concat_ws("_", "id", "ts_ms")).alias("keys"))
    both = seen.withColumn("_one", F.lit(1)).join(every.withColumn("_one", F.lit(1)), "_one")  # one row each
    return both.select("keys", (F.col("passed") - F.col("distinct_keys")).alias("repeats"), (
        F.col("keys") - F.col("distinct_keys") <= F.ceil(F.col("keys") * BLOOM_RATE)).alias("losses_within_rate"))


REG.query("X19_bloom_filter", bloom, """
select count(distinct id || '_' || ts_ms) as keys, 0::bigint as repeats, true as losses_within_rate from chg_comment_info""")
