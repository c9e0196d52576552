"""One query per operator of the library, on the given tables."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from registry.core import REG, Tables, half_up
from registry.realtime import changes, done, joined, lines, micro, pages, raw_log, records, version_stream, win
from tidemill.functions import dates, masks, numbers, rules, segment, text
from tidemill.operators import dedup, dims, horizons, merge, ranking, scd2, todate
from tidemill.operators.ordered import OrderedGroups, places
from tidemill.operators.quantiles import quantile_edges
from tidemill.plans import rfm
from tidemill.session import fresh_path, settled
from tidemill.sources import tables as src
from tidemill.sources.upsert import KeyedTable, upsert_batches
from tidemill.streaming import facts, metrics
from tidemill.streaming import sources as st
from tidemill.streaming.closing import Part, closed_results
from tidemill.streaming.sinks import batch_writer, drain, files_writer, run_to_table, to_json_value
from tidemill.streaming.state import first_of_day, live, with_retractions

q = REG.query
T = REG.tables
# small shared inputs, spelled for both engines
T["ev"] = "select *, strftime(ts, '%Y-%m-%d') as ds, cast(regexp_extract(props, '([0-9]+)', 1) as int) as k from events"
T["od"] = "select *, strftime(o_orderdate, '%Y-%m-%d') as ds, cast(o_totalprice as decimal(16,2)) as total from orders"
T["li"] = "select *, cast(l_extendedprice as decimal(16,2)) as price, cast(l_quantity as bigint) as qty from lineitem"


def ev(t: Tables) -> DataFrame:
    return t["events"].withColumn("ds", dates.as_ds(F.col("ts"))).withColumn(
        "k", F.regexp_extract("props", "([0-9]+)", 1).cast("int"))


def od(t: Tables) -> DataFrame:
    return t["orders"].withColumn("ds", dates.as_ds(F.col("o_orderdate"))).withColumn(
        "total", F.col("o_totalprice").cast("decimal(16,2)"))


def li(t: Tables) -> DataFrame:
    return t["lineitem"].withColumn("price", F.col("l_extendedprice").cast("decimal(16,2)")).withColumn(
        "qty", F.col("l_quantity").cast("bigint"))


N = "count(*) as n"
BY = "group by all"


def one():
    return F.count(F.lit(1)).alias("n")


def spend(col: str = "total") -> str:
    return f"cast(sum({col}) as double) as amount"


# ---------------------------------------------------------------- scans, sources, sinks
q("S1_partition_scan", lambda t: src.read_day(ev(t), t.d("event")).select("event_id", "user_id", "ds"),
  "select event_id, user_id, ds from ev where ds = {E.d}")
q("S2_partition_range_scan", lambda t: src.read_range(ev(t), t.d("event"), 7).groupBy("ds").agg(one()),
  f"select ds, {N} from ev where ds between {{E.d7}} and {{E.d}} {BY}")
q("S3_open_and_closed_scan", lambda t: src.read_open_and(t["dwd_trade_trade_flow"], t.d("order")).groupBy("ds").agg(one()),
  f"select ds, {N} from dwd_trade_trade_flow where ds in ('9999-12-31', {{O.d}}) {BY}")
q("S4_subquery_scan", lambda t: t.spark.sql(
    "select * from (select c_mktsegment, count(*) n, max(c_custkey) m from {c} group by c_mktsegment) t",
    c=t["customer"]), f"select c_mktsegment, {N}, max(c_custkey) as m from customer {BY}")


def csv(t: Tables) -> DataFrame:
    path = fresh_path(t.spark, "csv")
    od(t).select("o_custkey", "o_orderkey", F.when(F.col("o_orderstatus") != "P", F.date_format(
        "o_orderdate", "yyyy-MM-dd HH:mm:ss")).alias("at"), "o_totalprice").write.option("header", True).csv(path)
    rows = src.read_csv(t.spark, path, "o_custkey bigint, o_orderkey bigint, at string, o_totalprice double", ["at"], "at")
    return rows.withColumn("at", dates.as_ds(F.col("at")))


q("S5_csv_scan", csv, "select o_custkey, o_orderkey, ds as at, o_totalprice from od where o_orderstatus <> 'P'")
q("S6_json_source", lambda t: run_to_table(lines(t, "raw", raw_log).select(
    F.get_json_object("value", "$.common.mid").alias("mid"), F.get_json_object("value", "$.ts").cast("bigint").alias("ts"))
    .where(F.col("mid").isNotNull()), "s6"), "select mid, ts from log_events where k <> 13")
q("S7_null_tolerant_source", lambda t: st.not_null(ev(t).select(
    "event_id", F.when(F.col("k") % 2 == 0, F.col("event_type")).alias("value"))),
  "select event_id, event_type as value from ev where k % 2 = 0")
q("S8_change_log_source", lambda t: run_to_table(changes(t).where(F.col("op").isNotNull()).select(
    "op", F.col("source")["table"].alias("tab"), "ts_ms"), "s8").groupBy("op", "tab").agg(one()), f"""
select op, tab, {N} from (select op, 'order_info' as tab from chg_order_info
  union all select 'r', 'order_detail' from chg_order_detail
  union all select 'r', 'order_detail_activity' from chg_order_detail where l_discount > 0.05
  union all select 'r', 'order_detail_coupon' from chg_order_detail where l_tax > 0.04
  union all select 'u', 'payment_info' from chg_payment_info union all select 'u', 'order_refund_info' from chg_refund_info
  union all select 'u', 'refund_payment' from chg_refund_payment union all select 'r', 'comment_info' from chg_comment_info
  union all select op, 'cart_info' from chg_cart_info) {BY}""")
q("S9_lookup_table", lambda t: dims.lookup(t["customer"].select("c_custkey", "c_nationkey"), t["nation"], "c_nationkey",
                                          "n_nationkey", {"nation": "n_name"}),
  "select c_custkey, c_nationkey, n_name as nation from customer left join nation on c_nationkey = n_nationkey")


def written(write) -> object:
    def run(t: Tables) -> DataFrame:
        path = fresh_path(t.spark, "table")
        write(t, path)
        return t.spark.read.parquet(path).withColumn("ds", F.col("ds").cast("string")).groupBy("ds").agg(one())
    return run


def _days(t: Tables) -> DataFrame:
    return ev(t).select("event_id", "user_id", "ds")


def _s10(t, path):
    src.append(_days(t), path)
    src.append(src.read_day(_days(t), t.d("event")), path)


def _s11(t, path):
    src.append(_days(t), path)
    src.overwrite_day(_days(t).where(F.col("event_id") >= 0).drop("ds"), path, t.d("event"))


def _s12(t, path):
    src.append(_days(t).unionByName(_days(t)), path)
    src.overwrite_parts(src.read_range(_days(t), t.d("event"), 7), path)


q("S10_append", written(_s10), f"""
select ds, {N} from (select ds from ev union all select ds from ev where ds = {{E.d}}) {BY}""")
q("S11_overwrite_partition", written(_s11), f"""
select ds, if(ds = {{E.d}}, (select count(*) from ev), n) as n from (select ds, {N} from ev {BY})""")
q("S12_overwrite_dynamic", written(_s12), f"select ds, if(ds >= {{E.d7}}, n, 2 * n) as n from (select ds, {N} from ev {BY})")
q("S13_schema_aligned", lambda t: src.align_to_schema(ev(t), t.spark.createDataFrame(
    [], "ds string, user_id int, k bigint, event_id bigint").schema), "select ds, cast(user_id as int) as user_id, "
  "cast(k as bigint) as k, event_id from ev")


def json_sink(t: Tables) -> DataFrame:
    rows = pages(t).where(F.col("page").isNotNull()).select(F.col("common.mid").alias("mid"), "ts",
                                                            F.col("page.page_id").alias("topic"))
    path = fresh_path(t.spark, "topics")
    drain(files_writer(to_json_value(rows, "topic"), path, fresh_path(t.spark, "topics-ckpt"), by="topic"))
    return t.spark.read.parquet(path).select(F.col("topic").cast("string").alias("topic"), F.get_json_object(
        "value", "$.mid").alias("mid"), F.get_json_object("value", "$.ts").cast("bigint").alias("ts"))


q("S16_json_sink", lambda t: run_to_table(to_json_value(pages(t).where(F.col("page").isNotNull()).select(
    F.col("common.mid").alias("mid"), "ts")), "s16").select(F.get_json_object("value", "$.mid").alias("mid")).groupBy(
    "mid").agg(one()), f"select mid, {N} from page_log {BY}")
q("S17_dynamic_topic_sink", json_sink, "select page_id as topic, mid, ts from page_log")


def upserted(t: Tables) -> DataFrame:
    table = KeyedTable(t.spark, fresh_path(t.spark, "keyed"), ["id"])
    merge_batch = upsert_batches(table, ["ts"], at_rest=True)
    rows = settled(t["dwd_detail_versions"].select("id", "split_total_amount", "ts"), compression="zstd")  # derived once, merged three times
    merge_batch(rows.where(F.col("split_total_amount").cast("double") < 50000), 0)
    merge_batch(rows, 1)
    merge_batch(rows, 1)  # a repeated batch changes nothing
    return table.read()


q("S18_upsert", upserted, "select id, split_total_amount, ts from (select *, row_number() over (partition by id "
  "order by ts desc) as rn from dwd_detail_versions) where rn = 1")


def json_batches(t: Tables) -> DataFrame:
    path = fresh_path(t.spark, "jsonlines")
    drain(pages(t).where(F.col("page").isNotNull()).select(F.col("common.mid").alias("mid"), "ts").writeStream
          .foreachBatch(batch_writer(path)).option("checkpointLocation", fresh_path(t.spark, "jsonlines-ckpt")))
    return t.spark.read.schema("mid string, ts bigint").json(f"{path}/*")


q("S19_json_batches", json_batches, "select mid, ts from page_log")


def bucketed_files(t: Tables) -> DataFrame:
    """The log written into one folder per day, unreadable times into one of their own, and counted from the files."""
    path, k = fresh_path(t.spark, "buckets"), F.col("k")
    epoch = F.when(k == 13, F.lit("n/a")).when(k % 2 == 0, F.floor(F.col("ts") / 1000).cast("string")).otherwise(F.col("ts").cast("string"))
    src.write_bucketed_by_day(t["log_events"].select("mid", epoch.alias("epoch")), path, "epoch")
    return t.spark.read.parquet(path).groupBy(F.col("day").cast("string").alias("day")).agg(one())


q("S20_day_buckets", bucketed_files, f"""
select if(k = 13, 'error_bucket', strftime(make_timestamp_ms(ts), '%Y%m%d')) as day, {N} from log_events {BY}""")

# ---------------------------------------------------------------- projections, predicates
q("P1_projection", lambda t: od(t).select(F.lit("r1").alias("report"), F.col("o_orderkey").alias("order_id"), "ds"),
  "select 'r1' as report, o_orderkey as order_id, ds from od")
q("P2_partition_column", lambda t: t["nation"].withColumn("ds", F.lit(t.d("order"))), "select *, {O.d} as ds from nation")

def envelope(t: Tables) -> DataFrame:
    return t["customer"].select(F.create_map(
        F.lit("id"), F.col("c_custkey").cast("string"), F.lit("name"), F.col("c_name"), F.lit("seg"),
        F.col("c_mktsegment")).alias("after"))


q("P3_column_whitelist", lambda t: envelope(t).select(st.keep_columns(F.col("after"), F.lit("id,seg")).alias("m")).select(
    F.col("m")["id"].alias("id"), F.col("m")["seg"].alias("seg"), F.try_element_at("m", F.lit("name")).alias("name"),
    F.size("m").alias("n")),
  "select cast(c_custkey as varchar) as id, c_mktsegment as seg, cast(null as varchar) as name, 2 as n from customer")
q("P4_map_access", lambda t: run_to_table(st.of_table(changes(t).drop("event_time"), "cart_info", F.col("op") == "r").select(
    st.after("id").alias("id"), st.after("sku_num").alias("sku_num")), "p4"),
  "select id, sku_num from chg_cart_info where op = 'r'")
q("P5_nested_json", lambda t: run_to_table(pages(t).where(F.col("common.uid").isNotNull()).select(
    F.col("common.uid").alias("uid"), F.col("page.page_id").alias("page_id")), "p5").groupBy("uid", "page_id").agg(one()),
  f"select uid, page_id, {N} from page_log where uid is not null {BY}")
q("P6_state_transition", lambda t: run_to_table(st.of_table(changes(t).drop("event_time"), "order_info", st.moved(
    "order_status", "1001", "1003")).select(st.after("id").alias("id")), "p6"),
  "select id from chg_order_info where was = '1001' and status = '1003'")
q("P7_predicates", lambda t: t["part"].where(
    F.col("p_type").isin("PROMO", "LARGE") & ~F.col("p_brand").isin("Brand#1", "Brand#2") & F.col("p_name").like("%ring")
    & F.col("p_size").between(5, 25) & F.col("p_retailprice").isNotNull()).select("p_partkey"), """
select p_partkey from part where p_type in ('PROMO', 'LARGE') and p_brand not in ('Brand#1', 'Brand#2')
  and p_name like '%ring' and p_size between 5 and 25 and p_retailprice is not null""")
q("P8_clamp", lambda t: t["customer"].select("c_custkey", numbers.no_negative(F.col("c_acctbal")).alias("bal")),
  "select c_custkey, if(c_acctbal < 0, 0, c_acctbal) as bal from customer")
q("P9_default_trim_cut", lambda t: t["part"].select("p_partkey", text.cleaned(F.when(F.col("p_size") > 10, F.concat(
    F.lit("  "), "p_name")), "unknown", 5).alias("name")),
  "select p_partkey, left(coalesce(trim(if(p_size > 10, '  ' || p_name, null)), 'unknown'), 5) as name from part")
q("P10_fill", lambda t: t["part"].select("p_partkey", F.when(F.col("p_size") > 25, F.col("p_size")).alias("a"), F.when(
    F.col("p_size") > 30, F.col("p_type")).alias("b")).fillna({"a": -1, "b": "none"}),
  "select p_partkey, if(p_size > 25, p_size, -1) as a, if(p_size > 30, p_type, 'none') as b from part")
q("P11_metric_literals", lambda t: ev(t).where(F.col("ds") == t.d("event")).groupBy("event_type").agg(one()).withColumn(
    "time_type", F.lit("1d")).unionByName(horizons.in_last(ev(t), "ds", t.d("event"), 7).groupBy("event_type").agg(
        one()).withColumn("time_type", F.lit("7d"))), f"""
select event_type, {N}, '1d' as time_type from ev where ds = {{E.d}} {BY}
union all select event_type, count(*), '7d' from ev where ds between {{E.d7}} and {{E.d}} group by event_type""")
q("P12_wide_to_tall", lambda t: horizons.unfold_horizons(t["part"].select(
    "p_partkey", F.col("p_size").alias("x_7d"), (F.col("p_size") * 2).alias("x_30d")), ["p_partkey"], (7, 30), {"x": "x"}),
  "select p_partkey, 7 as recent_days, p_size as x from part union all select p_partkey, 30, p_size * 2 from part")
q("P13_exists", lambda t: t["customer"].join(od(t).where(F.col("total") > 400000), F.col("c_custkey") == F.col(
    "o_custkey"), "left_semi").select("c_custkey"), """
select c_custkey from customer c where exists (select 1 from od where o_custkey = c_custkey and total > 400000)""")
q("P14_unify_logs", lambda t: merge.unify({
    "order": od(t).select(F.col("o_custkey").alias("user_id"), F.col("o_orderstatus").alias("status")),
    "event": ev(t).select("user_id", "k")}, [("user_id", "bigint"), ("status", "string"), ("k", "int")]), """
select 'order' as data_type, o_custkey as user_id, o_orderstatus as status, cast(null as int) as k from od
union all select 'event', user_id, null, k from ev""")

# ---------------------------------------------------------------- joins
q("J1_inner_join", lambda t: li(t).join(od(t), F.col("l_orderkey") == F.col("o_orderkey")).join(
    t["customer"], F.col("o_custkey") == F.col("c_custkey")).groupBy("c_mktsegment").agg(
    F.sum("price").alias("amount"), one()), f"""
select c_mktsegment, {spend('price')}, {N} from li join od on l_orderkey = o_orderkey
join customer on o_custkey = c_custkey {BY}""")
q("J2_left_join", lambda t: dims.lookup(ev(t).groupBy("user_id").agg(one()), t["customer"], "user_id", "c_custkey", {
    "segment": "c_mktsegment"}), f"""
select user_id, n, c_mktsegment as segment from (select user_id, {N} from events {BY})
left join customer on user_id = c_custkey""")
q("J3_snowflake", lambda t: dims.chain(t["supplier"].select("s_suppkey", "s_nationkey"), [
    (t["nation"], "s_nationkey", "n_nationkey", {"nation": "n_name", "r": "n_regionkey"}),
    (t["region"], "r", "r_regionkey", {"region": "r_name"})]), """
select s_suppkey, s_nationkey, n_name as nation, n_regionkey as r, r_name as region from supplier
left join nation on s_nationkey = n_nationkey left join region on n_regionkey = r_regionkey""")
q("J4_self_join", lambda t: dims.lookup(t["ods_base_region_info"].select("id", "parent_id", "name"),
                                       t["ods_base_region_info"], "parent_id", "id", {"parent_name": "name"}),
  "select a.id, a.parent_id, a.name, b.name as parent_name from ods_base_region_info a "
  "left join ods_base_region_info b on a.parent_id = b.id")
q("J5_dictionary_roles", lambda t: dims.codes_to_names(
    t["tms_order_info"].select("id", "status", "payment_type"), t["ods_base_dic"],
    {"status": ("status_name", None), "payment_type": ("payment_type_name", "pay")}), """
select i.id, status, payment_type, a.dic_name as status_name, b.dic_name as payment_type_name from tms_order_info i
left join ods_base_dic a on status = a.dic_code
left join (select * from ods_base_dic where parent_code = 'pay') b on payment_type = b.dic_code""")
q("J6_region_levels", lambda t: dims.region_parents(t["dim_organ_full"].select("id", "org_level", "region_id"), t[
    "dim_region_full"], "region_id", 2).select("id", dims.by_level(F.col("org_level"), "r0_id", "r1_id").alias("city_id")),
  "select o.id, if(org_level = 1, a.id, b.id) as city_id from dim_organ_full o left join dim_region_full a on "
  "region_id = a.id left join dim_region_full b on a.parent_id = b.id")


def two_sides(t: Tables):
    return (od(t).groupBy(F.col("o_custkey").alias("key")).agg(F.count(F.lit(1)).alias("orders")),
            ev(t).groupBy(F.col("user_id").alias("key")).agg(F.count(F.lit(1)).alias("events")),
            t["customer"].select(F.col("c_custkey").alias("key"), "c_acctbal"))


T["s1"] = "select o_custkey as key, count(*) as orders from od group by 1"
T["s2"] = "select user_id as key, count(*) as events from events group by 1"
T["s3"] = "select c_custkey as key, c_acctbal from customer"
q("J7_full_outer", lambda t: merge.full_outer(two_sides(t)[:2], ["key"]),
  "select coalesce(s1.key, s2.key) as key, orders, events from s1 full join s2 on s1.key = s2.key")
q("J8_full_outer_three", lambda t: merge.full_outer(two_sides(t), ["key"]), """
select coalesce(x.key, s3.key) as key, orders, events, c_acctbal from (
  select coalesce(s1.key, s2.key) as key, orders, events from s1 full join s2 on s1.key = s2.key) x
full join s3 on x.key = s3.key""")
q("J9_many_columns", lambda t: t["ods_user_behavior"].join(t["ods_page_structure"], ["page_type", "block_id", "ds"]).groupBy(
    "page_type", "block_name").agg(one()), f"""
select u.page_type, block_name, {N} from ods_user_behavior u join ods_page_structure s on u.page_type = s.page_type
  and u.block_id = s.block_id and u.ds = s.ds {BY}""")
q("J10_old_new_merge", lambda t: todate.to_date_merge(
    todate.to_date_init(ev(t).where(F.col("ds") < t.d("event")).groupBy("user_id", "ds").agg(one()), "user_id", "ds",
                        "first", "last", {"total": "n"}),
    ev(t).where(F.col("ds") == t.d("event")).groupBy("user_id").agg(one()), t.d("event"), "user_id", "first", "last",
    {"total": "n"}), "select user_id, min(ds) as first, max(ds) as last, count(*) as total from ev group by 1")
q("J11_one_row", lambda t: merge.one_row({
    "orders": t["orders"].agg(one()), "events": t["events"].agg(one()), "parts": t["part"].agg(one())}),
  "select (select count(*) from orders) as orders, (select count(*) from events) as events, "
  "(select count(*) from part) as parts")
q("J12_share_of_total", lambda t: ranking.with_group_total(ev(t).groupBy("ds", "event_type").agg(one()), ["ds"], "n",
                                                          "al").select("ds", "event_type", numbers.ratio(
                                                              F.col("n") * 100, F.col("al")).alias("share")),
  f"select ds, event_type, {half_up('n * 100', 'al')} as share from (select *, sum(n) over (partition by ds) as al "
  f"from (select ds, event_type, {N} from ev {BY}))")
q("J13_date_range_join", lambda t: _range_join(t), """
select a.ds, cast(sum(b.n) as bigint) as week from (select ds, count(*) as n from od group by 1) a
join (select ds, count(*) as n from od group by 1) b
on cast(b.ds as date) between cast(a.ds as date) - 6 and cast(a.ds as date) group by 1""")


def _range_join(t: Tables) -> DataFrame:
    """Seven-day range self join: each day is sent to the seven days it belongs to, then it is an equi join."""
    days = od(t).groupBy("ds").agg(one())
    reach = days.select(F.explode(F.sequence(F.col("ds").cast("date"), F.date_add(F.col("ds").cast("date"), 6))).alias("to"),
                        F.col("n").alias("m"))
    return days.join(reach, F.col("ds").cast("date") == F.col("to")).groupBy("ds").agg(F.sum("m").alias("week"))


q("J14_same_day_join", lambda t: ev(t).where("event_type = 'view'").groupBy("user_id", "ds").agg(one()).join(
    ev(t).where("event_type = 'click'").groupBy("user_id", "ds").agg(F.count(F.lit(1)).alias("m")), ["user_id", "ds"],
    "left"), f"""
select a.user_id, a.ds, n, m from (select user_id, ds, {N} from ev where event_type = 'view' {BY}) a
left join (select user_id, ds, count(*) as m from ev where event_type = 'click' {BY}) b
on a.user_id = b.user_id and a.ds = b.ds""")
q("J15_semi_join", lambda t: t["part"].join(li(t).where("l_returnflag = 'R' and l_quantity > 49"), F.col("p_partkey") ==
                                           F.col("l_partkey"), "left_semi").select("p_partkey"),
  "select p_partkey from part where p_partkey in (select l_partkey from li where l_returnflag = 'R' and l_quantity > 49)")
q("J16_snapshot_self_join", lambda t: t["dws_user_user_login_td"].alias("a").join(
    t["dws_user_user_login_td_yesterday"].alias("b"), "user_id").where("a.login_date_last <> b.login_date_last").select(
    "user_id", F.col("b.login_date_last").alias("previous")), """
select a.user_id, b.login_date_last as previous from dws_user_user_login_td a
join dws_user_user_login_td_yesterday b on a.user_id = b.user_id where a.login_date_last <> b.login_date_last""")
def prefixed_details(t: Tables) -> DataFrame:
    """Order lines as one record with their order, two seconds either way, the order's columns prefixed."""
    def merged(log: DataFrame) -> DataFrame:
        orders = facts.table(log, "order_info", F.col("op") == "r").select(
            *[st.after(c).alias(c) for c in ("id", "user_id", "province_id")], "event_time")
        detail = facts.table(log, "order_detail").select(
            *[st.after(c).alias(c) for c in ("id", "order_id", "sku_id")], "event_time")
        return facts.prefixed_merge(detail, orders, "order_id", "id", "info_", 2)

    return joined([records(t, "order_detail", "order_info")], merged, "prefixed", 2)


q("J20_prefixed_merge", prefixed_details, """
select d.id, d.order_id, d.sku_id, o.id as info_id, o.user_id as info_user_id, o.province_id as info_province_id
from chg_order_detail d join chg_order_info o on d.order_id = o.id and o.op = 'r' and abs(d.ts_ms - o.ts_ms) <= 2000""")
q("J21_temporal_lookup", lambda t: micro(changes(t).where(live(F.col("source")["table"] == "comment_info")).select(
    st.after("id").alias("id"), st.after("appraise").alias("code")), "j21", lambda b: dims.lookup(
        b, t["ods_base_dic"], "code", "dic_code", {"name": "dic_name"}, "inner")),
  "select id, appraise as code, dic_name as name from chg_comment_info join ods_base_dic on appraise = dic_code")
q("J22_dimension_chain", lambda t: metrics.with_sku_names(li(t).groupBy(F.col("l_partkey").alias("sku_id")).agg(one()), t),
  f"""select l.*, sku_name, spu_id, tm_id, category3_id, spu_name, tm_name, category3_name, category2_id, category2_name,
  category1_id, category1_name from (select l_partkey as sku_id, {N} from li {BY}) l left join dim_sku_full s
  on sku_id = s.id""")
q("J23_dictionary_default", lambda t: dims.codes_to_names(t["tms_order_info"].select("id", "collect_type"), t[
    "ods_base_dic"], {"collect_type": ("name", None)}, default="N/A"),
  "select i.id, collect_type, coalesce(dic_name, 'N/A') as name from tms_order_info i left join ods_base_dic "
  "on collect_type = dic_code")

# ---------------------------------------------------------------- aggregations
q("A1_group_sum", lambda t: od(t).groupBy("ds").agg(F.sum("total").alias("amount"), one()),
  f"select ds, {spend()}, {N} from od {BY}")
q("A2_count_distinct", lambda t: li(t).groupBy("l_returnflag").agg(F.count_distinct("l_partkey").alias("n")),
  "select l_returnflag, count(distinct l_partkey) as n from li group by 1")
q("A3_conditional_sum", lambda t: li(t).groupBy("l_suppkey").agg(numbers.sum_if(F.col("l_returnflag") == "R", F.col(
    "price")).alias("amount"), F.sum(numbers.or_zero(F.when(F.col("l_tax") > 0.05, F.col("qty")))).alias("n")), """
select l_suppkey, cast(sum(if(l_returnflag = 'R', price, 0)) as double) as amount,
  cast(sum(coalesce(if(l_tax > 0.05, qty, null), 0)) as bigint) as n from li group by 1""")
q("A4_conditional_distinct", lambda t: ev(t).groupBy("ds").agg(
    numbers.count_if(F.col("event_type") == "click").alias("clicks"),
    numbers.distinct_if(F.col("event_type") == "click", F.col("user_id")).alias("clickers")), """
select ds, count(case when event_type = 'click' then 1 end) as clicks,
  count(distinct case when event_type = 'click' then user_id end) as clickers from ev group by 1""")
q("A5_many_distincts", lambda t: ev(t).groupBy("event_type").agg(
    F.count_distinct("user_id").alias("users"), F.count_distinct("k").alias("keys"), F.count_distinct("ds").alias("days")),
  "select event_type, count(distinct user_id) as users, count(distinct k) as keys, count(distinct ds) as days from ev "
  "group by 1")
q("A6_min_max_avg", lambda t: li(t).groupBy("l_linenumber").agg(
    F.min("price").alias("lo"), F.max("price").alias("hi"), numbers.mean(F.sum("qty"), F.count("qty")).alias("mean")), """
select l_linenumber, cast(min(price) as double) as lo, cast(max(price) as double) as hi,
  cast(sum(qty) as double) / count(qty) as mean from li group by 1""")
q("A7_ratio", lambda t: ev(t).groupBy("ds").agg(numbers.ratio(numbers.count_if(F.col("event_type") == "purchase"), F.count(
    F.lit(1))).alias("rate")), f"select ds, {half_up("count(*) filter (where event_type = 'purchase')", "count(*)")} "
  f"as rate from ev group by 1")
q("A8_collect_set", lambda t: t["part"].select("p_brand", "p_type", "p_name").distinct().groupBy("p_brand").agg(F.array_join(
    F.sort_array(F.collect_set(F.concat_ws(":", "p_type", "p_name"))), ",").alias("kinds")),
  "select p_brand, string_agg(distinct p_type || ':' || p_name, ',' order by p_type || ':' || p_name) as kinds "
  "from part group by 1")
q("A9_two_level", lambda t: t["dwd_trans_dispatch_detail"].groupBy("order_id", "dt").agg(F.max("amount").alias("m")).groupBy(
    "dt").agg(one(), F.sum("m").alias("amount")), """
select dt, count(*) as n, cast(sum(m) as double) as amount from (select order_id, dt, max(amount) as m
  from dwd_trans_dispatch_detail group by all) group by 1""")
q("A10_distinct_then_count", lambda t: ev(t).select("user_id", "event_type", "ds").distinct().groupBy("event_type", "ds").agg(
    one()), f"select event_type, ds, {N} from (select distinct user_id, event_type, ds from ev) {BY}")
q("A11_global", lambda t: od(t).agg(one(), F.sum("total").alias("amount")), f"select {N}, {spend()} from od")
q("A12_multi_horizon", lambda t: horizons.multi_horizon(od(t), "ds", t.d("order"), (1, 7, 30), ["o_orderstatus"], [
    one(), F.count_distinct("o_custkey").alias("users")]), """
select recent_days, o_orderstatus, count(*) as n, count(distinct o_custkey) as users from od
join (values (1, {O.d}), (7, {O.d7}), (30, {O.d30})) h(recent_days, lo) on ds between lo and {O.d} group by 1, 2""")
q("A13_wide_horizons", lambda t: horizons.horizon_wide(od(t), "ds", t.d("order"), (7, 30), ["o_orderstatus"], {
    "amount": "total"}), """
select o_orderstatus, cast(sum(if(ds >= {O.d7}, total, 0)) as double) as amount_7d, cast(sum(total) as double) as amount_30d
from od where ds between {O.d30} and {O.d} group by 1""")
q("A14_signed_union", lambda t: merge.signed_total(
    li(t).where("l_returnflag <> 'R'").groupBy("l_suppkey").agg(F.sum("qty").alias("n")),
    li(t).where("l_returnflag = 'R'").groupBy("l_suppkey").agg(F.sum("qty").alias("n")), ["l_suppkey"], ["n"]),
  "select l_suppkey, cast(sum(if(l_returnflag = 'R', -qty, qty)) as bigint) as n from li group by 1")
q("A15_average_duration", lambda t: li(t).join(od(t), F.col("l_orderkey") == F.col("o_orderkey")).where(
    "l_shipdate >= o_orderdate").groupBy("o_orderpriority").agg(F.avg(dates.seconds_between(
        F.col("l_shipdate"), F.col("o_orderdate"))).cast("bigint").alias("secs")), """
select o_orderpriority, cast(sum(date_diff('second', o_orderdate, l_shipdate)) // count(*) as bigint) as secs
from li join od on l_orderkey = o_orderkey where l_shipdate >= o_orderdate group by 1""")
q("A16_recency_frequency_amount", lambda t: rfm.rfm(t),
  "select * from rfm_table")
q("A17_segment_profile", lambda t: t["customer"].groupBy("c_mktsegment").agg(one(), numbers.mean(F.sum(F.col(
    "c_acctbal").cast("decimal(16,2)")), F.count(F.lit(1))).alias("mean")), f"""
select c_mktsegment, {N}, cast(sum(cast(c_acctbal as decimal(16,2))) as double) / count(*) as mean from customer {BY}""")
q("A18_window_reduce", lambda t: done(metrics.windowed(pages(t).where(live(F.col("page").isNotNull())), "1 hour", [], F.sum(
    "page.during_time").alias("dur")), "a18"),
  f"select {win('ts', 3600)}, cast(sum(during_time) as bigint) as dur from page_log {BY}")
q("A19_window_distinct", lambda t: done(metrics.distinct_in_window(pages(t).select(
    F.col("common.mid").alias("mid"), F.col("common.ch").alias("ch"), "event_time"), "1 hour", ["ch"], "mid", "uv"), "a19"),
  f"select {win('ts', 3600)}, ch, count(distinct mid) as uv from page_log {BY}")
q("A20_window_count", lambda t: done(metrics.windowed(pages(t).where(live(F.col("page").isNotNull())), "10 seconds", [],
                                                     F.count(F.lit(1)).alias("n")), "a20"),
  f"select {win('ts', 10)}, {N} from page_log {BY}")
q("A21_computed_key", lambda t: t["events"].groupBy(F.to_date("ts").cast("string").alias("day"), F.date_format(
    "ts", "yyyyMM").alias("month")).agg(one()),
  f"select strftime(ts, '%Y-%m-%d') as day, strftime(ts, '%Y%m') as month, {N} from events {BY}")

# ---------------------------------------------------------------- window functions, sorts, sets
q("W1_latest_per_key", lambda t: ranking.latest_per_key(od(t).select("o_custkey", "ds", "o_orderkey", "o_orderstatus"), [
    "o_custkey"], ["ds", "o_orderkey"]), """
select o_custkey, ds, o_orderkey, o_orderstatus from (select *, row_number() over (partition by o_custkey
  order by ds desc, o_orderkey desc) as rn from od) where rn = 1""")
q("W2_top_n", lambda t: ranking.top_n(od(t).select("o_custkey", "o_orderkey", "total"), ["o_custkey"], [
    F.col("total").desc(), F.col("o_orderkey")], 5), """
select o_custkey, o_orderkey, cast(total as double) as total, cast(rn as int) as rn from (select *, row_number() over (
  partition by o_custkey order by total desc, o_orderkey) as rn from od) where rn <= 5""")
q("W3_rank_with_ties", lambda t: ranking.top_n(li(t).groupBy("l_suppkey", "l_linenumber").agg(F.max("qty").alias("m")), [
    "l_suppkey"], [F.col("m").desc()], 3, "rk", ties=True), """
select * replace (cast(rk as int) as rk) from (select *, rank() over (partition by l_suppkey order by m desc) as rk from (
  select l_suppkey, l_linenumber, max(qty) as m from li group by all)) where rk <= 3""")
q("W4_rank_of_aggregate", lambda t: ranking.rank_all(li(t).groupBy("l_returnflag", "l_partkey").agg(F.sum("qty").alias("n")),
                                                    ["l_returnflag"], "n"), """
select *, rank() over (partition by l_returnflag order by n desc) as rk from (
  select l_returnflag, l_partkey, cast(sum(qty) as bigint) as n from li group by all)""")
q("W5_consecutive_days", lambda t: dedup.consecutive_days(ev(t).select("user_id", "ds").distinct(), "user_id",
                                                         t.d("event"), 7, 3), """
select distinct user_id from (select user_id, date_diff('day', cast(ds as date), cast(lead(ds, 2) over (
  partition by user_id order by ds) as date)) as g from (select distinct user_id, ds from ev
  where ds between {E.d7} and {E.d})) where g = 2""")
def next_and_number(t: Tables) -> DataFrame:
    rows = ev(t).select("event_id", "user_id", "event_type", "ts")
    return OrderedGroups(rows, ["user_id"], [F.col("ts"), F.col("event_id")], places(rows, "ts", "event_id")).step("event_type", "next", "rn").drop("ts")


q("W6_next_and_number", next_and_number, """
select event_id, user_id, event_type, lead(event_type) over w as next, row_number() over w as rn from events
window w as (partition by user_id order by ts, event_id)""")
q("W7_moving_average", lambda t: t["dwd_sku_sales_inventory_daily"].select(
    "sku_id", "stat_date", "pay_quantity", "avg_daily_sales"), """
select sku_id, stat_date, pay_quantity, cast(sum(pay_quantity) over w // count(*) over w as int) as avg_daily_sales
from ods_sku_sales_inventory_daily
window w as (partition by sku_id order by stat_date rows between 6 preceding and current row)""")
q("W8_share_over_partition", lambda t: ranking.with_group_total(li(t).groupBy("l_returnflag", "l_linestatus").agg(one()), [
    "l_returnflag"], "n", "al"), f"""
select *, cast(sum(n) over (partition by l_returnflag) as bigint) as al from (
  select l_returnflag, l_linestatus, {N} from li {BY})""")
q("W9_share_over_all", lambda t: ranking.with_grand_total(li(t).groupBy("l_returnflag").agg(one()), "n", "al"),
  f"select *, cast(sum(n) over () as bigint) as al from (select l_returnflag, {N} from li {BY})")
q("W10_quintile_edges", lambda t: quantile_edges(li(t), "qty", (0.2, 0.4, 0.6, 0.8)), """
select quantile_cont(cast(qty as double), 0.2) as q0, quantile_cont(cast(qty as double), 0.4) as q1,
  quantile_cont(cast(qty as double), 0.6) as q2, quantile_cont(cast(qty as double), 0.8) as q3 from li""")
q("T1_order_by", lambda t: t["nation"].orderBy(F.col("n_regionkey").desc(), "n_name"), "select * from nation")
q("T2_order_limit", lambda t: od(t).select("o_orderkey", "o_totalprice").orderBy(F.col("o_totalprice").desc(),
                                                                               "o_orderkey").limit(20),
  "select o_orderkey, o_totalprice from od order by o_totalprice desc, o_orderkey limit 20")
q("T3_sample_limit", lambda t: t["part"].orderBy("p_partkey").limit(200), "select * from part order by p_partkey limit 200")
q("T4_top_per_group", lambda t: ranking.top_n(t["part"].select("p_brand", "p_partkey", "p_size"), ["p_brand"], [
    F.col("p_size").desc(), F.col("p_partkey")], 10).drop("rn"), """
select p_brand, p_partkey, p_size from (select *, row_number() over (partition by p_brand order by p_size desc, p_partkey)
  as rn from part) where rn <= 10""")
q("U1_union_all", lambda t: t["customer"].select(F.col("c_nationkey").alias("n")).unionByName(t["supplier"].select(F.col(
    "s_nationkey").alias("n"))), "select c_nationkey as n from customer union all select s_nationkey from supplier")
q("U2_union_distinct", lambda t: t["customer"].select(F.col("c_nationkey").alias("n")).unionByName(t["supplier"].select(F.col(
    "s_nationkey").alias("n"))).distinct(), "select c_nationkey as n from customer union select s_nationkey from supplier")
q("U3_union_by_name", lambda t: t["customer"].select("c_custkey", "c_name").unionByName(t["supplier"].select(F.col(
    "s_name").alias("c_name"), F.col("s_suppkey").alias("c_custkey"))),
  "select c_custkey, c_name from customer union all select s_suppkey, s_name from supplier")


def appended_twice(t: Tables) -> DataFrame:
    report = od(t).groupBy("ds", "o_orderstatus").agg(one())
    once = merge.idempotent_append(report.where(F.col("ds") < t.d("order")), report)
    return merge.idempotent_append(once, report)


q("U4_idempotent_union", appended_twice, f"select ds, o_orderstatus, {N} from od {BY}")
q("C5_idempotent_append", lambda t: appended_twice(t).groupBy("o_orderstatus").agg(F.sum("n").alias("n")),
  f"select o_orderstatus, {N} from od {BY}")

# ---------------------------------------------------------------- scalar functions
PHONE = "'138' || lpad(cast(c_custkey as varchar), 8, '0')"
q("F1_text", lambda t: t["customer"].select("c_custkey", F.substring("c_name", 1, 4).alias("a"), F.get(F.split(
    "c_name", "#"), 1).alias("b"), F.col("c_name").like("%7").alias("c"), F.col("c_name").rlike("0[1-5]$").alias("d"),
    F.trim(F.concat(F.lit(" "), "c_mktsegment")).alias("e")), """
select c_custkey, left(c_name, 4) as a, split_part(c_name, '#', 2) as b, c_name like '%7' as c,
  regexp_matches(c_name, '0[1-5]$') as d, c_mktsegment as e from customer""")
q("F2_masks", lambda t: t["customer"].withColumn("p", F.concat(F.lit("138"), F.lpad(F.col("c_custkey").cast(
    "string"), 8, "0"))).select("c_custkey", masks.first_letter(F.col("c_name")).alias("name"), masks.keep_three(F.col(
        "p")).alias("p3"), masks.hashed_phone(F.col("p")).alias("ph"), masks.mail_domain(F.concat(
            "c_name", F.lit("@x.org"))).alias("mail"), F.md5("c_name").alias("h")), f"""
select c_custkey, left(c_name, 1) || '*' as name, '138*' as p3, md5({PHONE}) as ph, '*@x.org' as mail, md5(c_name) as h
from customer""")
q("F3_allowed_characters", lambda t: t["customer"].select("c_custkey", masks.only_allowed(F.col("c_name")).alias("a"),
                                                         masks.only_allowed(F.col("c_mktsegment")).alias("b")), """
select c_custkey, regexp_full_match(c_name, '[a-zA-Z0-9_]+') as a, regexp_full_match(c_mktsegment, '[a-zA-Z0-9_]+') as b
from customer""")
q("F4_date_arithmetic", lambda t: od(t).select(
    "o_orderkey", dates.as_ds(F.date_add("o_orderdate", 10)).alias("plus"), dates.as_ds(F.date_sub(
        "o_orderdate", 10)).alias("minus"), F.datediff(F.lit(t.d("order")).cast("date"), "o_orderdate").alias("age")), """
select o_orderkey, strftime(o_orderdate + interval 10 day, '%Y-%m-%d') as plus,
  strftime(o_orderdate - interval 10 day, '%Y-%m-%d') as minus,
  cast(date_diff('day', cast(o_orderdate as date), cast({O.d} as date)) as int) as age from od""")
q("F5_unix_time", lambda t: od(t).select("o_orderkey", F.unix_timestamp("ds", "yyyy-MM-dd").alias("secs"), F.from_unixtime(
    F.unix_timestamp("ds", "yyyy-MM-dd"), "yyyyMMdd").alias("day")),
  "select o_orderkey, cast(epoch(cast(ds as timestamp)) as bigint) as secs, replace(ds, '-', '') as day from od")
q("F6_epoch_ms", lambda t: t["tms_order_info"].select("id", dates.ms_to_text(F.col("estimate_arrive_time")).alias("at")),
  "select id, strftime(make_timestamp_ms(estimate_arrive_time), '%Y-%m-%d %H:%M:%S') as at from tms_order_info")
q("F7_epoch_days", lambda t: t["customer"].select("c_custkey", dates.epoch_days_to_ds(F.col("c_custkey")).alias("d")),
  "select c_custkey, strftime(date '1970-01-01' + cast(c_custkey as int), '%Y-%m-%d') as d from customer")
q("F8_iso_slice", lambda t: t["tms_order_info"].select("id", dates.iso_to_text(F.col("update_time")).alias("at")),
  "select id, left(update_time, 10) || ' ' || substr(update_time, 12, 8) as at from tms_order_info")
q("F9_null_logic", lambda t: t["part"].select("p_partkey", F.coalesce(F.nullif("p_size", F.lit(7)), F.lit(-7)).alias("a"),
                                             F.when(F.col("p_size") < 10, "s").when(F.col("p_size") < 30, "m").otherwise(
                                                 "l").alias("b")), """
select p_partkey, coalesce(nullif(p_size, 7), -7) as a, case when p_size < 10 then 's' when p_size < 30 then 'm' else 'l'
  end as b from part""")
q("F10_rule_text", lambda t: t["ods_activity_rule"].select("id", rules.activity_benefit(F.col("activity_type")).alias("rule")),
  """select id, case activity_type when '3101' then '满' || condition_amount || '元减' || benefit_amount || '元'
    when '3102' then '满' || condition_num || '件打' || benefit_discount || ' 折'
    when '3103' then '打' || benefit_discount || '折' end as rule from ods_activity_rule""")
q("F11_guarded_arithmetic", lambda t: li(t).select(
    "l_orderkey", "l_partkey", numbers.zero_guarded(F.col("qty"), F.col("l_linenumber") - 3).alias("a"), numbers.ratio(
        F.col("qty"), F.col("l_linenumber"), 4).alias("b")), f"""
select l_orderkey, l_partkey, if(l_linenumber = 3, 0, cast(qty as double) / (l_linenumber - 3)) as a,
  {half_up('qty', 'l_linenumber', 4)} as b from li""")
q("F12_arrays", lambda t: t["supplier"].select("s_suppkey", F.explode(F.array("s_nationkey", F.col(
    "s_nationkey") + 100)).alias("x"), F.array("s_nationkey", F.lit(5))[1].alias("y")),
  "select s_suppkey, s_nationkey as x, 5 as y from supplier union all select s_suppkey, s_nationkey + 100, 5 from supplier")
q("F13_struct", lambda t: t["part"].select("p_partkey", F.struct(F.col("p_brand").alias("b"), F.col("p_size").alias(
    "s")).alias("z")).select("p_partkey", "z.b", "z.s"), "select p_partkey, p_brand as b, p_size as s from part")
q("F14_json", lambda t: t["events"].select("event_id", F.from_json("props", "k int").alias("p"), F.to_json(F.struct(F.col(
    "user_id").alias("user_id"))).alias("j")).select("event_id", "p.k", "j"),
  "select event_id, k, '{\"user_id\":' || user_id || '}' as j from ev")
q("F14_snake_json", lambda t: t["events"].select("event_id", F.col("user_id").alias("userId"), F.col("event_type").alias("eventTypeName")).select(
    "event_id", text.to_snake_json(["userId", "eventTypeName"]).alias("j")),
  "select event_id, '{\"user_id\":' || user_id || ',\"event_type_name\":\"' || event_type || '\"}' as j from ev")
q("F15_fan_out", lambda t: run_to_table(lines(t, "raw", raw_log).select(F.from_json("value", st.LOG).alias("r")).select(
    F.col("r.common.mid").alias("mid"), F.explode("r.displays").alias("d")).select("mid", F.col("d")["pos"].alias("pos")),
    "f15"), "select mid, pos from log_events, (values ('1'), ('2')) p(pos) where kind = 'view' and k <> 13")
q("F16_hash_bucket", lambda t: t["customer"].select("c_custkey", masks.hash_bucket(F.col("c_name"), 100).alias("b")),
  "select c_custkey, lpad(cast(cast('0x' || right(md5(c_name), 3) as int) % 100 as varchar), 4, '0') as b from customer")
q("F17_date_spine", lambda t: dates.date_spine(t.spark, t.first("order"), t.d("order")), """
select cast(strftime(unnest(generate_series(cast(min(ds) as date), cast(max(ds) as date), interval 1 day)), '%Y%m%d') as int) as day from od""")
q("F18_range_label", lambda t: od(t).select("o_orderkey", dates.span_label(F.col("ds"), 7).alias("label")),
  "select o_orderkey, strftime(cast(ds as date) - 6, '%Y-%m-%d') || '至' || ds as label from od")

# ---------------------------------------------------------------- streaming operators in their batch and stream form
q("X5_safe_timestamp", lambda t: ev(t).select("event_id", dates.event_millis(F.when(F.col("k") % 3 == 0, F.lit(
    "oops")).when(F.col("k") % 3 == 1, F.lit("1700000000")).otherwise(F.lit("1700000000123"))).alias("ms")), """
select event_id, case k % 3 when 0 then 0 when 1 then 1700000000000 else 1700000000123 end as ms from ev""")


def tumbled(key: str, delay: str, width: str, seconds: int) -> None:
    q(key, lambda t: done(metrics.windowed(pages(t, delay).where(live(F.col("page").isNotNull())), width, [], F.count(
        F.lit(1)).alias("n")), "win"), f"select {win('ts', seconds)}, {N} from page_log {BY}")


def resent(t: Tables, delay: str, width: str) -> DataFrame:
    """Counts per window of a log in order of time, four events a second, of which each half is sent again after its end.

    Heartbeats with the last time of the half let the watermark settle before; so of the rows that come again, the ones count whose window
    ends after that time less the delay."""
    path = fresh_path(t.spark, "resent")
    rows = t["log_events"].select((F.col("event_id") * 250 + 1_700_000_000_000).alias("ts"), F.lit(True).alias("counts"))
    ends = rows.agg(F.min("ts").alias("low"), F.max("ts").alias("high")).first()
    if ends.low is None:
        return t.spark.createDataFrame([], "stt string, edt string, cur_date string, n bigint")
    middle = (ends.low + ends.high) // 2

    def sent(df: DataFrame) -> None:  # one file is one batch
        df.coalesce(1).write.mode("append").json(path)

    def beats(at: int) -> None:
        for _ in range(2):
            sent(t.spark.createDataFrame([(at, False)], "ts long, counts boolean"))

    for half, end in ((rows.where(F.col("ts") <= middle), middle), (rows.where(F.col("ts") > middle), ends.high)):
        sent(half)
        beats(end)
        sent(half)
    beats(ends.high + 4 * 86_400_000)
    reader = t.spark.readStream.schema("ts long, counts boolean").option("maxFilesPerTrigger", 1).json(path)
    return done(metrics.windowed(metrics.clocked(reader, "ts", delay).where(live(F.col("counts"))), width, [], F.count(F.lit(1)).alias("n")), "resent")


def delayed(key: str, delay: str, late_ms: int, width: str, seconds: int) -> None:
    q(key, lambda t: resent(t, delay, width), f"""
with e as (select event_id * 250 + 1700000000000 as ts from log_events), m as (select (min(ts) + max(ts)) // 2 as middle, max(ts) as high from e),
  s as (select ts, if(ts <= middle, middle, high) as fin from e, m)
select {win('ts', seconds)}, {N} from (select ts from s union all
  select ts from s where ts // {seconds * 1000} * {seconds * 1000} + {seconds * 1000} > fin - {late_ms}) {BY}""")


delayed("X1_monotonous_clock", "0 seconds", 0, "5 seconds", 5)
delayed("X2_bounded_delay", "5 minutes", 300_000, "10 seconds", 10)
delayed("X4_computed_clock", "5 seconds", 5_000, "1 hour", 3600)
delayed("X7_global_window", "3 seconds", 3_000, "10 seconds", 10)
tumbled("X9_three_day_window", "5 seconds", "3 days", 259200)
q("X6_keyed_window", lambda t: done(metrics.windowed(pages(t).where(live(F.col("page").isNotNull())).withColumn(
    "ch", F.col("common.ch")), "10 seconds", ["ch"], F.count(F.lit(1)).alias("n")), "x6"),
  f"select {win('ts', 10)}, ch, {N} from page_log {BY}")
def by_clock(t: Tables) -> DataFrame:
    """Counts by the clock: the whole log in a few batches, then heartbeats a second later that close the last window."""
    path, out, ckpt = (fresh_path(t.spark, f"clock-{x}") for x in ("in", "out", "ckpt"))
    rows = t["log_events"].select("ch", "ts")
    files = int(t.spark.conf.get("spark.sql.shuffle.partitions"))
    rows.repartition(files).write.json(path)

    def run() -> None:
        reader = t.spark.readStream.schema("ch string, ts bigint").option("maxFilesPerTrigger", -(-files // 3))
        drain(files_writer(metrics.processing_windows(reader.json(path), "1 second", ["ch"], F.count(F.lit(1)).alias("n")), out, ckpt).outputMode("append"))

    run()
    time.sleep(1.1)
    t.spark.createDataFrame([("beat", 0)], "ch string, ts bigint").write.mode("append").json(path)
    run()
    whole = F.unix_seconds(F.col("edt").cast("timestamp")) - F.unix_seconds(F.col("stt").cast("timestamp")) == 1
    return t.spark.read.parquet(out).where("ch <> 'beat'").groupBy("ch").agg(F.sum("n").alias("n"), F.every(whole).alias("whole"))


q("X8_one_second_window", by_clock, f"select ch, {N}, true as whole from log_events {BY}")
q("X10_composite_key_window", lambda t: done(metrics.windowed(pages(t).where(live(F.col("page").isNotNull())).select(
    "event_time", "common.vc", "common.ch", "common.ar", "common.is_new"), "10 seconds", ["vc", "ch", "ar", "is_new"],
    F.count(F.lit(1)).alias("n")), "x10"), f"select {win('ts', 10)}, vc, ch, ar, is_new, {N} from page_log {BY}")


def late_file(t: Tables) -> DataFrame:
    """Four batches of equally many files: the rows, two heartbeats that move the clock past every window, and the same
    rows again under the name ``late``: they come after their windows closed and must not appear."""
    path, files = fresh_path(t.spark, "late"), int(t.spark.conf.get("spark.sql.shuffle.partitions"))
    rows = t["log_events"].select("mid", "ts")
    last = rows.agg(F.max("ts").alias("last")).select("last").scalar()
    every = t.spark.range(0, files, 1, files)
    rows.repartition(files).write.json(path)
    for extra in (1, 2):
        every.select(F.lit("beat").alias("mid"), (last + 86_400_000 + extra).alias("ts")).write.mode("append").json(path)
    rows.withColumn("mid", F.lit("late")).repartition(files).write.mode("append").json(path)
    reader = t.spark.readStream.schema("mid string, ts bigint").option("maxFilesPerTrigger", files)
    clock = metrics.clocked(reader.json(path), "ts", "0 seconds").where(live(F.col("mid") != "beat"))
    return done(metrics.windowed(clock, "1 hour", [], F.count(F.lit(1)).alias("n")), "late")


q("X11_late_rows_dropped", late_file, f"select {win('ts', 3600)}, {N} from log_events {BY}")
q("X12_first_of_day", lambda t: dedup.first_of_day(t["log_events"].select("mid", F.timestamp_millis("ts").alias("ts")), "mid")
  .select("mid", "ds", F.unix_millis("ts").alias("ms")), """
select mid, strftime(make_timestamp_ms(ts), '%Y-%m-%d') as ds, min(ts) as ms from log_events group by 1, 2""")
q("X12_first_of_day_stream", lambda t: run_to_table(first_of_day(pages(t).where(live(F.col("page").isNotNull())).select(
    F.col("common.mid").alias("mid"), "event_time"), ["mid"], "10 seconds").select(
    "mid", dates.as_ds(F.col("event_time")).alias("ds")), "x12"), """
select distinct mid, strftime(make_timestamp_ms(ts), '%Y-%m-%d') as ds from page_log""")
q("X13_unique_and_new", lambda t: dedup.unique_and_new(t["log_events"].select("mid", F.timestamp_millis("ts").alias("ts")),
                                                      "mid").select("mid", "ds", "is_new_user"), """
select mid, strftime(make_timestamp_ms(ts), '%Y-%m-%d') as ds, if(ts = min(ts) over (partition by mid), 1, 0)
  as is_new_user from (select mid, min(ts) as ts from log_events group by mid, ts // 86400000)""")
q("X14_returning", lambda t: dedup.returning(t["orders"].select("o_custkey", F.col("o_orderdate").alias("ts")), "o_custkey")
  .select("o_custkey", "ds", "previous_ds", "is_back"), """
select o_custkey, ds, lag(ds) over w as previous_ds,
  coalesce(cast(date_diff('day', cast(lag(ds) over w as date), cast(ds as date)) >= 8 as int), 0) as is_back
from (select distinct o_custkey, ds from od) window w as (partition by o_custkey order by ds)""")
q("X15_new_flag_repair", lambda t: dedup.repaired_new_flag(t["log_events"].select("event_id", "mid", "is_new", F.timestamp_millis(
    "ts").alias("ts")), "mid", "ts", "is_new").select("event_id", "mid", "is_new"), """
select event_id, mid, case when is_new = '1' and ts // 86400000 <> min(ts) over (partition by mid) // 86400000 then '0'
  else is_new end as is_new from log_events""")
q("X16_retraction", lambda t: dedup.with_retractions(t["dwd_detail_versions"].select(
    "id", "sku_id", F.col("split_total_amount").cast("decimal(16,4)").alias("amount"), "ts"), "id", [F.col("ts")], F.col(
        "ts"), ["amount"]).groupBy("sku_id").agg(F.sum("amount").alias("amount"), one()), """
select sku_id, cast(sum(amount) as double) as amount, cast(sum(n) as bigint) as n from (
  select sku_id, max(cast(split_total_amount as decimal(16,4))) as amount, 2 * count(*) - 1 as n
  from dwd_detail_versions group by id, sku_id) group by 1""")
q("X16_retraction_stream", lambda t: closed_results([version_stream(t, 0, "id", "ts", "split_total_amount")], [Part(lambda d: with_retractions(
    d.where(live(F.col("id").isNotNull())).select("id", "event_time", "ts", F.col("split_total_amount").cast("decimal(16,4)").alias("amount")), "id", "ts",
    ["amount"], "5 seconds"), 0, 15)], "x16")[0].groupBy("id").agg(F.sum("sign").alias("versions"), F.sum(F.col("sign") * F.col("amount")).alias("amount")), """
select id, cast(sum(sign) as bigint) as versions, cast(sum(sign * cast(split_total_amount as decimal(16,4))) as double) as amount
from signed group by id""")
q("X20_dirty_split", lambda t: run_to_table(st.parsed_log(lines(t, "raw", raw_log)).select(F.col("_corrupt").isNotNull().alias(
    "dirty")), "x20").groupBy("dirty").agg(one()), f"select k = 13 as dirty, {N} from log_events {BY}")
q("X24_live_payload", lambda t: t["chg_cart_info"].select("id", F.when(F.col("was").isNotNull(), "d").otherwise(F.col(
    "op")).alias("op"), F.create_map(F.lit("n"), F.col("was")).alias("before"), F.create_map(F.lit("n"), F.col(
        "sku_num")).alias("after")).select("id", st.live_payload()["n"].alias("n")),
  "select id, coalesce(was, sku_num) as n from chg_cart_info")

# ---------------------------------------------------------------- routing by a configuration that changes while the stream runs
def config_changes(t: Tables) -> DataFrame:
    """The change log of the routing table: cart updates get a route, another one after a third of the time and none after two thirds."""
    ends = t["chg_cart_info"].agg(F.min("ts_ms").alias("low"), F.max("ts_ms").alias("high"))
    third = F.col("low") + (F.col("high") - F.col("low")) / 3 * F.col("k")
    steps = t.spark.createDataFrame([(0, "r", "dwd_cart", "id,sku_num"), (1, "u", "dwd_cart_v2", "id"), (2, "d", "dwd_cart_v2", "id")], "k int, change string, sink_table string, sink_columns string")
    rows = steps.crossJoin(ends)  # three rows and one
    return rows.select("change", F.lit("cart_info").alias("source_table"), "sink_table", "sink_columns", F.lit("u").alias("op"),
                       F.when(F.col("k") == 0, F.lit(0)).otherwise(F.floor(third)).cast("long").alias("changed_ms"))


def live_routes(t: Tables) -> DataFrame:
    path = fresh_path(t.spark, "config")
    config_changes(t).coalesce(1).write.json(path)
    history = lambda: facts.config_history(t.spark.read.schema(facts.CONFIG_CHANGE).json(path), ["source_table", "op"])
    rows = micro(changes(t).drop("event_time"), "live", lambda b: facts.fact_routes_as_of(b, history()))
    j = F.get_json_object
    return rows.select("topic", j("value", "$.id").alias("id"), j("value", "$.sku_num").alias("sku_num"), j("value", "$.ts").cast("bigint").alias("ts"))


q("X22_live_routes", live_routes, """
with e as (select min(ts_ms) as low, max(ts_ms) as high from chg_cart_info),
  c as (select floor(low + (high - low) / 3 * 1) as one, floor(low + (high - low) / 3 * 2) as two from e)
select if(ts_ms < one, 'dwd_cart', 'dwd_cart_v2') as topic, id, if(ts_ms < one, sku_num, null) as sku_num, ts_ms as ts
from chg_cart_info, c where op = 'u' and ts_ms < two""")

# ---------------------------------------------------------------- table functions and composite operators
q("D1_words", lambda t: text.explode_words(t["documents"].select("doc_id", "text"), "text", "word").groupBy("word").agg(one()),
  f"select word, {N} from (select unnest(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+')) as word from documents) {BY}")
def short_words(t: Tables, longest: int) -> DataFrame:
    """A dictionary from the corpus: words of two to ``longest`` letters that occur ten times or more."""
    every = t["documents"].select(F.explode(text.words(F.col("text"))).alias("word"))
    return every.where(F.length("word").between(2, longest)).groupBy("word").agg(F.count(F.lit(1)).alias("n")).where("n >= 10")


q("D1_segmented", lambda t: segment.segmented(t["benchmark"].select("item_id", "text"), "text", short_words(t, 6), 6).groupBy("item_id", "keyword").agg(one()), f"""
with recursive w as (select unnest(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+')) as word from documents),
  d as (select word, count(*) as n from w where length(word) between 2 and 6 group by word having count(*) >= 10),
  c as materialized (select word, floor(1000 * ln(sum(n) over () / n))::bigint as cost from d),
  r as materialized (select item_id, unnest(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+')) as run from benchmark),
  u as materialized (select distinct run from r),
  e as materialized (select run, pos, s as size, substr(run, pos + 1, s) as word from u, generate_series(0, length(run) - 1) a(pos), generate_series(1, 6) b(s)
        where pos + s <= length(run)),
  g as materialized (select run, pos, list({{'cost': c.cost, 'size': size}}) as ways from e join c using (word) group by run, pos),
  x as materialized (select run, pos, ways from (select run, unnest(range(length(run))) as pos from u) left join g using (run, pos)),
  p as (select run, length(run)::bigint as pos, [0::bigint] as ahead, []::bigint[] as sizes from u
        union all
        select run, x.pos, list_prepend(b.cost, ahead), list_prepend(-b.minus, sizes) from (
          select p.run, x.pos, p.ahead, p.sizes, list_min(list_concat([{{'cost': ahead[1] + 20000, 'minus': -1::bigint}}],
              list_transform(coalesce(x.ways, []), lambda y: {{'cost': y.cost + ahead[y.size], 'minus': -y.size::bigint}}))) as b
          from p join x on x.run = p.run and x.pos = p.pos - 1) x),
  f as (select run, sizes from p where pos = 0),
  k as (select run, 0::bigint as pos, '' as word, sizes from f union all
        select run, pos + sizes[pos + 1], substr(run, pos + 1, sizes[pos + 1]), sizes from k where pos < length(run))
select item_id, word as keyword, {N} from r join k using (run) where word <> '' {BY}""")
q("D2_count_aggregate", lambda t: ev(t).groupBy("ds").agg(one()), f"select ds, {N} from ev {BY}")
q("D3_word_check", lambda t: text.moderated(t["documents"].select("doc_id", "text"), "text", t["documents"].select(
    F.element_at(F.split("text", ","), -1).alias("word")).groupBy("word").count().where("count > 1").select("word"))
  .select("doc_id", "is_violation", "violation_grade"), """
select doc_id, if(c > 1, 1, 0) as is_violation, if(c > 1, 'P0', null) as violation_grade from (
  select doc_id, count(*) over (partition by string_split(text, ',')[-1]) as c from documents)""")
q("D4_segment_rules", lambda t: t["part"].select("p_partkey", rules.rfm_segment(F.col("p_size") % 5 + 1, F.col(
    "p_partkey") % 5 + 1, F.col("p_partkey") % 4 + 2).alias("segment")), """
select p_partkey, case when r >= 4 and f >= 4 and m >= 4 then '高价值客户' when r >= 3 and f >= 4 and m >= 3 then '忠诚客户'
  when r >= 4 and f <= 3 and m >= 4 then '潜力客户' when r <= 2 and f >= 3 and m >= 3 then '流失预警客户'
  when r between 3 and 4 and f between 2 and 3 and m between 2 and 3 then '一般维持客户' else '低价值客户' end as segment
from (select p_partkey, p_size % 5 + 1 as r, p_partkey % 5 + 1 as f, p_partkey % 4 + 2 as m from part)""")
q("D5_explode", lambda t: t["embeddings"].select("vec_id", F.posexplode("embedding").alias("i", "x")).groupBy("i").agg(
    numbers.count_if(F.col("x") > 0).alias("n")), """
select cast(i - 1 as int) as i, count(*) filter (where x > 0) as n from (
  select unnest(embedding) as x, generate_subscripts(embedding, 1) as i from embeddings) group by 1""")
q("C1_multi_horizon", lambda t: horizons.horizon_sums(od(t).withColumn("one", F.lit(1)), "ds", t.d("order"), (1, 7, 30), [
    "o_orderpriority"], {"n": "one", "amount": "total"}), f"""
select recent_days, o_orderpriority, {N}, {spend()} from od
join (values (1, {{O.d}}), (7, {{O.d7}}), (30, {{O.d30}})) h(recent_days, lo) on ds between lo and {{O.d}} {BY}""")
q("C2_horizon_wide", lambda t: horizons.horizon_wide(od(t).withColumn("n", F.lit(1)), "ds", t.d("order"), (7, 30), [
    "o_custkey"], {"n": "n"}), """
select o_custkey, cast(sum(if(ds >= {O.d7}, 1, 0)) as bigint) as n_7d, count(*) as n_30d from od
where ds between {O.d30} and {O.d} group by 1""")
q("C3_to_date_init", lambda t: todate.to_date_init(od(t).withColumn("n", F.lit(1)), "o_custkey", "ds", "first", "last", {
    "orders": "n", "amount": "total"}), f"""
select o_custkey, min(ds) as first, max(ds) as last, count(*) as orders, {spend()} from od group by 1""")


def folded(t: Tables) -> DataFrame:
    """Build up to five days ago, then merge five days one by one: equals the full build."""
    daily, d = od(t).groupBy("o_custkey", "ds").agg(one(), F.sum("total").alias("a")), t.d("order")
    sums = {"orders": "n", "amount": "a"}
    start = dates.shift(d, -5)
    table = todate.to_date_init(daily.where(F.col("ds") <= start), "o_custkey", "ds", "first", "last", sums)
    for i in range(1, 6):
        day = dates.shift(start, i)
        table = todate.to_date_merge(table, daily.where(F.col("ds") == day), day, "o_custkey", "first", "last", sums)
    return table


q("C4_to_date_merge", folded, REG.sql["C3_to_date_init"])
q("C6_scd2_init", lambda t: scd2.scd2_init(t["customer"].select("c_custkey", "c_mktsegment"), t.d("order")),
  "select c_custkey, c_mktsegment, {O.d} as start_date, '9999-12-31' as end_date from customer")


def zipped(t: Tables) -> DataFrame:
    d = t.d("order")
    base = scd2.scd2_init(t["customer"].select("c_custkey", F.col("c_mktsegment").alias("level")), "1995-01-01")
    change = horizons.in_last(od(t), "ds", d, 30).select(F.col("o_custkey").alias("c_custkey"), F.col(
        "o_orderpriority").alias("level"), "ds", "o_orderkey")
    return scd2.scd2_merge(base, change, d, "c_custkey", ["ds", "o_orderkey"], close_offset=1)


q("C7_scd2_merge", zipped, """
with c as (select * from (select o_custkey as c_custkey, o_orderpriority as level, row_number() over (
  partition by o_custkey order by ds desc, o_orderkey desc) as rn from od where ds between {O.d30} and {O.d}) where rn = 1)
select c_custkey, level, {O.d} as start_date, '9999-12-31' as end_date from c
union all select u.c_custkey, c_mktsegment, '1995-01-01', if(c.c_custkey is null, '9999-12-31', {O.y})
from customer u left join c on u.c_custkey = c.c_custkey""")
q("C12_codes_to_names", lambda t: dims.codes_to_names(t["ods_coupon_info"].select("id", "coupon_type", "range_type"), t[
    "ods_base_dic"], {"coupon_type": ("a", "32"), "range_type": ("b", "33")}), """
select c.id, coupon_type, range_type, x.dic_name as a, y.dic_name as b from ods_coupon_info c
left join (select * from ods_base_dic where parent_code = '32') x on coupon_type = x.dic_code
left join (select * from ods_base_dic where parent_code = '33') y on range_type = y.dic_code""")
q("C13_period_snapshot", lambda t: t["dwd_trade_cart_full"].groupBy("ds").agg(one(), F.sum("sku_num").alias("items")),
  f"select ds, {N}, cast(sum(sku_num) as bigint) as items from dwd_trade_cart_full {BY}")
q("C15_split_shared_measure", lambda t: merge.share_between(t["ods_transport_task"].select(
    "driver1_emp_id", "driver1_name", "driver2_emp_id", "driver2_name", "actual_distance"),
    [("driver1_emp_id", "driver1_name"), ("driver2_emp_id", "driver2_name")], ["actual_distance"], ("driver", "name"))
  .groupBy("driver", "name").agg(F.sum("actual_distance").alias("distance"), one()), """
select driver, name, cast(sum(share) as double) as distance, count(*) as n from (
  select driver1_emp_id as driver, driver1_name as name, actual_distance * if(driver2_emp_id is null, 1.0, 0.5) as share
  from ods_transport_task
  union all select driver2_emp_id, driver2_name, actual_distance * 0.5 from ods_transport_task
  where driver2_emp_id is not null) group by 1, 2""")
