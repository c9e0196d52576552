"""Retail queries: jobs over the derived inputs, and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry.core import REG, Tables, half_up
from tidemill.operators.snapshots import snapshot_init, snapshot_merge
from tidemill.plans import retail_daily as daily
from tidemill.plans import retail_dims as dims
from tidemill.plans import retail_reports as reports

T = REG.tables
KEEP = ["user_id", "province_id", "order_time"]

# ---------------------------------------------------------------- dimensions
T["dim_activity_full"] = """
select r.id as activity_rule_id, activity_id, activity_name, r.activity_type as activity_type_code,
  dic_name as activity_type_name, activity_desc, start_time, end_time, create_time, condition_amount, condition_num,
  benefit_amount, benefit_discount,
  case r.activity_type
    when '3101' then '满' || condition_amount || '元减' || benefit_amount || '元'
    when '3102' then '满' || condition_num || '件打' || benefit_discount || ' 折'
    when '3103' then '打' || benefit_discount || '折' end as benefit_rule, benefit_level
from ods_activity_rule r left join ods_activity_info i on r.activity_id = i.id
left join (select * from ods_base_dic where parent_code = '31') on r.activity_type = dic_code"""
REG.job("B1_dim_activity_full", dims.dim_activity_full, "order",
        "select * replace (cast(condition_amount as double) as condition_amount) from dim_activity_full")

T["dim_coupon_full"] = """
select c.id, coupon_name, coupon_type as coupon_type_code, a.dic_name as coupon_type_name, condition_amount,
  condition_num, activity_id, benefit_amount, benefit_discount,
  case coupon_type
    when '3201' then '满' || condition_amount || '元减' || benefit_amount || '元'
    when '3202' then '满' || condition_num || '件打' || benefit_discount || ' 折'
    when '3203' then '减' || benefit_amount || '元' end as benefit_rule,
  create_time, range_type as range_type_code, b.dic_name as range_type_name, limit_num
from ods_coupon_info c
left join (select * from ods_base_dic where parent_code = '32') a on c.coupon_type = a.dic_code
left join (select * from ods_base_dic where parent_code = '33') b on c.range_type = b.dic_code"""
REG.job("B2_dim_coupon_full", dims.dim_coupon_full, "order",
        "select * replace (cast(condition_amount as double) as condition_amount) from dim_coupon_full")
REG.job("B3_dim_promotion_pos_full", dims.dim_promotion_pos_full, "order", "select * from ods_promotion_pos")
REG.job("B3_dim_promotion_refer_full", dims.dim_promotion_refer_full, "order", "select * from ods_promotion_refer")
T["dim_province_full"] = """
select p.id, name as province_name, area_code, iso_code, iso_3166_2, region_id, region_name
from ods_base_province p left join ods_base_region r on p.region_id = r.id"""
REG.job("B4_dim_province_full", dims.dim_province_full, "order", "select * from dim_province_full")
T["dim_sku_full"] = """
select s.id, price, sku_name, sku_desc, weight, is_sale, spu_id, spu_name, category3_id, c3.name as category3_name,
  category2_id, c2.name as category2_name, category1_id, c1.name as category1_name, tm_id, tm_name, create_time
from ods_sku_info s left join ods_spu_info p on spu_id = p.id
left join ods_base_category3 c3 on category3_id = c3.id left join ods_base_category2 c2 on category2_id = c2.id
left join ods_base_category1 c1 on category1_id = c1.id left join ods_base_trademark t on tm_id = t.id"""
REG.job("B5_dim_sku_full", dims.dim_sku_full, "order", """
select s.* replace (cast(price as double) as price), attrs as sku_attr_values, sale as sku_sale_attr_values
from dim_sku_full s
left join (select sku_id, string_agg(distinct attr_id || ':' || value_id || ':' || attr_name || ':' || value_name, ','
             order by attr_id || ':' || value_id || ':' || attr_name || ':' || value_name) as attrs
           from ods_sku_attr_value group by 1) a on s.id = a.sku_id
left join (select sku_id, string_agg(distinct sale_attr_id || ':' || sale_attr_value_id || ':' || sale_attr_name || ':'
             || sale_attr_value_name, ',' order by sale_attr_id || ':' || sale_attr_value_id || ':' || sale_attr_name
             || ':' || sale_attr_value_name) as sale
           from ods_sku_sale_attr_value group by 1) b on s.id = b.sku_id""",
        final=lambda df: df.withColumns({c: F.array_join(F.transform(c, lambda s: F.concat_ws(
            ":", *[s[f] for f in df.schema[c].dataType.elementType.names])), ",")
            for c in ("sku_attr_values", "sku_sale_attr_values")}))
MASKED = """id, left(name, 1) || '*' as name,
  case when regexp_matches(phone_num, '^(13[0-9]|14[01456879]|15[0-35-9]|16[2567]|17[0-8]|18[0-9]|19[0-35-9])[0-9]{8}$')
    then left(phone_num, 3) || '*' end as phone_num,
  case when regexp_matches(email, '^[a-zA-Z0-9_-]+@[a-zA-Z0-9_-]+([.][a-zA-Z0-9_-]+)+$')
    then '*@' || split_part(email, '@', 2) end as email, user_level, birthday, gender, create_time, operate_time"""
T["dim_user_zip"] = f"""
select {MASKED}, left(create_time, 10) as start_date, '9999-12-31' as end_date from ods_user_info"""
REG.job("B6_dim_user_zip", dims.dim_user_zip, "order", "select * from dim_user_zip")


REG.job("M2_dim_user_zip_daily", dims.dim_user_zip_daily, "order", f"""
with inc as (select * from (select *, row_number() over (partition by id order by operate_time desc) as rn
             from ods_user_info_inc where left(operate_time, 10) = {{O.d}}) where rn = 1)
select {MASKED}, {{O.d}} as start_date, '9999-12-31' as end_date from inc
union all
select z.* replace (case when i.id is null then z.end_date else {{O.d}} end as end_date)
from dim_user_zip z left join (select id from inc) i on z.id = i.id""", table="dim_user_zip_daily")
REG.job("M1_dim_sku_di", lambda t, d: t["dim_sku_full"].select(
    "id", F.col("price").cast("double").alias("price"), F.col("weight").cast("double").alias("weight"), "sku_name",
    "category3_id", "tm_id"), "order",
    "select id, cast(price as double) as price, cast(weight as double) as weight, sku_name, category3_id, tm_id "
    "from dim_sku_full", table="dim_sku_di")
REG.job("M1_dim_province_df", lambda t, d: t["dim_province_full"].drop("region_name"), "order",
        "select * exclude (region_name) from dim_province_full", table="dim_province_df")

# ---------------------------------------------------------------- facts
T["dwd_interaction_favor_add_inc"] = """
select id, user_id, sku_id, left(create_time, 10) as date_id, create_time from ods_favor_info where ds = {E.d}"""
REG.job("B7_dwd_interaction_favor_add_inc", dims.dwd_interaction_favor_add_inc, "event",
        "select * from dwd_interaction_favor_add_inc")
T["dwd_tool_coupon_used_inc"] = """
select id, coupon_id, user_id, order_id, left(used_time, 10) as date_id, used_time as payment_time
from ods_coupon_use where used_time is not null"""
REG.job("B8_dwd_tool_coupon_used_inc", dims.dwd_tool_coupon_used_inc, "order",
        "select * from dwd_tool_coupon_used_inc")
T["dwd_trade_cart_full"] = """
select id, user_id, sku_id, sku_name, sku_num, {O.d} as ds from ods_cart_info where is_ordered = '0'"""
REG.job("B9_dwd_trade_cart_full", dims.dwd_trade_cart_full, "order", "select * from dwd_trade_cart_full")
T["dwd_trade_order_detail_inc"] = """
select order_id, user_id, sku_id, province_id, create_time, sku_num, split_original_amount, split_activity_amount,
  split_coupon_amount, split_total_amount, left(create_time, 10) as ds
from ods_order_detail od join ods_order_info oi on od.order_id = oi.id"""
AMT = ["split_original_amount", "split_activity_amount", "split_coupon_amount", "split_total_amount"]


def doubles(cols) -> str:
    return ", ".join(f"cast({c} as double) as {c}" for c in cols)


REG.job("M3_dwd_trade_order_di", dims.dwd_trade_order_detail_inc, "order",
        f"select * replace ({doubles(AMT)}) from dwd_trade_order_detail_inc")
T["dwd_trade_pay_detail_suc_inc"] = """
select od.* exclude (ds, split_total_amount), split_total_amount as split_payment_amount,
  payment_type as payment_type_code, dic_name as payment_type_name, callback_time, left(callback_time, 10) as ds
from dwd_trade_order_detail_inc od join ods_payment_info p on od.order_id = p.order_id and payment_status = '1602'
left join (select * from ods_base_dic where parent_code = '11') on payment_type = dic_code"""
REG.job("M5_dwd_trade_payment", dims.dwd_trade_pay_detail_suc_inc, "order",
        f"select * replace ({doubles([*AMT[:3], 'split_payment_amount'])}) from dwd_trade_pay_detail_suc_inc",
        table="dwd_trade_pay_detail_suc_inc")
REG.job("M5_dwd_trade_payment_daily", dims.dwd_trade_payment_daily, "order",
        f"select * replace ({doubles([*AMT[:3], 'split_payment_amount'])}) from dwd_trade_pay_detail_suc_inc where ds = {{O.d}}",
        table="dwd_trade_payment_daily")

MILES = ("payment_time", "delivery_time", "closed_time", "finished_time")
T["miles"] = """
select order_id, min(case when order_status = '1002' then create_time end) as payment_time,
  min(case when order_status = '1004' then create_time end) as delivery_time,
  min(case when order_status = '1005' then create_time end) as closed_time,
  min(case when order_status = '1006' then create_time end) as finished_time
from ods_order_status_log where left(create_time, 10) <= {O.d} group by order_id"""
T["dwd_trade_trade_flow"] = """
select o.*, payment_time, delivery_time, closed_time, finished_time,
  case when payment_time is null then 0 else total_amount end as payment_amount,
  coalesce(left(coalesce(closed_time, finished_time), 10), '9999-12-31') as ds
from order_snapshot o left join miles m on o.order_id = m.order_id"""
FLOW_SQL = ("select * replace (cast(total_amount as double) as total_amount, cast(payment_amount as double) as "
            "payment_amount) from dwd_trade_trade_flow")


def _until(df, d: str):
    return df.where(F.substring("create_time", 1, 10) <= d)


def trade_flow_init(t: Tables, d: str):
    return snapshot_init(t["order_snapshot"], _until(t["ods_order_status_log"], d), KEEP)


def trade_flow_daily(t: Tables, d: str):
    """Everything up to the day before, then one more day merged: must equal the full build."""
    from tidemill.functions.dates import OPEN_DATE, shift
    eve = shift(d, -1)
    orders, log = t["order_snapshot"], t["ods_order_status_log"]
    old = snapshot_init(orders.where(F.substring("order_time", 1, 10) <= eve), _until(log, eve), KEEP)
    merged = snapshot_merge(old.where(F.col("ds") == OPEN_DATE),
                            orders.where(F.substring("order_time", 1, 10) == d),
                            log.where(F.substring("create_time", 1, 10) == d), KEEP)
    return old.where(F.col("ds") != OPEN_DATE).unionByName(merged)


REG.job("M4_dwd_trade_order_flow_init", trade_flow_init, "order", FLOW_SQL, table="dwd_trade_trade_flow")
REG.job("M4_dwd_trade_order_flow_daily", trade_flow_daily, "order", FLOW_SQL)
T["dwd_trade_trade_flow_acc"] = "select *, left(payment_time, 10) as payment_date_id from dwd_trade_trade_flow"
Tables.jobs["dwd_trade_trade_flow_acc"] = (lambda t, d: t["dwd_trade_trade_flow"].withColumn(
    "payment_date_id", F.substring("payment_time", 1, 10)), "order")

# ---------------------------------------------------------------- daily aggregates
SKU = ", ".join(dims.SKU_NAMES)
PLACE = ", ".join(daily.PLACE)
SUMS = """sum(split_original_amount) as order_original_amount_1d,
  sum(coalesce(split_activity_amount, 0)) as activity_reduce_amount_1d,
  sum(coalesce(split_coupon_amount, 0)) as coupon_reduce_amount_1d, sum(split_total_amount) as order_total_amount_1d"""
A1D = [f"{a}_1d" for a in daily.AMOUNTS]


def final(table: str, money=(), ints=()) -> str:
    casts = [f"cast({c} as double) as {c}" for c in money] + [f"cast({c} as bigint) as {c}" for c in ints]
    return f"select * replace ({', '.join(casts)}) from {table}" if casts else f"select * from {table}"


T["dws_interaction_sku_favor_add_1d"] = f"""
select f.sku_id, favor_add_count_1d, {SKU} from
(select sku_id, count(*) as favor_add_count_1d from dwd_interaction_favor_add_inc group by 1) f
left join dim_sku_full s on f.sku_id = s.id"""
REG.job("B11_dws_interaction_sku_favor_add_1d", daily.dws_interaction_sku_favor_add_1d, "event",
        "select * from dws_interaction_sku_favor_add_1d")
T["dws_tool_user_coupon_coupon_used_1d"] = """
select u.*, coupon_name, coupon_type_code, coupon_type_name, benefit_rule from
(select date_id as ds, user_id, coupon_id, count(*) as used_count_1d from dwd_tool_coupon_used_inc group by all) u
left join dim_coupon_full c on u.coupon_id = c.id"""
REG.job("B12_dws_tool_user_coupon_coupon_used_1d", daily.dws_tool_user_coupon_coupon_used_1d, "order",
        "select * from dws_tool_user_coupon_coupon_used_1d")
T["dws_trade_province_order_1d"] = f"""
select o.*, {PLACE} from (select province_id, ds, count(distinct order_id) as order_count_1d, {SUMS}
  from dwd_trade_order_detail_inc group by province_id, ds) o
left join dim_province_full p on o.province_id = p.id"""
REG.job("B13_dws_trade_province_order_1d", daily.dws_trade_province_order_1d, "order",
        final("dws_trade_province_order_1d", A1D))
T["dws_trade_province_order_users_1d"] = f"""
select o.*, {PLACE} from (select province_id, ds, count(*) as order_count_1d,
  count(distinct user_id) as order_user_num_1d, {SUMS} from dwd_trade_order_detail_inc group by province_id, ds) o
left join dim_province_full p on o.province_id = p.id"""
REG.job("M6_dws_trade_province_order_1d", daily.dws_trade_province_order_users_1d, "order",
        final("dws_trade_province_order_users_1d", A1D))
T["dws_trade_user_cart_add_1d"] = """
select user_id, ds, count(*) as cart_add_count_1d, cast(sum(sku_num) as bigint) as cart_add_num_1d
from dwd_trade_cart_add_inc group by all"""
REG.job("B14_dws_trade_user_cart_add_1d", daily.dws_trade_user_cart_add_1d, "event",
        "select * from dws_trade_user_cart_add_1d")
T["dws_trade_user_order_1d"] = f"""
select user_id, ds, count(distinct order_id) as order_count_1d, cast(sum(sku_num) as bigint) as order_num_1d, {SUMS}
from dwd_trade_order_detail_inc group by user_id, ds"""
REG.job("B15_dws_trade_user_order_1d", daily.dws_trade_user_order_1d, "order", final("dws_trade_user_order_1d", A1D))
REG.query("M9_dws_trade_user_order_1d", lambda t: t["dws_trade_user_order_1d"].where(F.col("ds") == t.d("order")),
          final("dws_trade_user_order_1d", A1D) + " where ds = {O.d}")
T["dws_trade_user_payment_1d"] = """
select user_id, ds, count(distinct order_id) as payment_count_1d, cast(sum(sku_num) as bigint) as payment_num_1d,
  cast(sum(split_payment_amount) as double) as payment_amount_1d from dwd_trade_pay_detail_suc_inc group by all"""
REG.job("B16_dws_trade_user_payment_1d", daily.dws_trade_user_payment_1d, "order",
        "select * from dws_trade_user_payment_1d")
REG.job("M9_dws_trade_user_pay_1d", daily.dws_trade_user_pay_1d, "order", """
select user_id, ds, cast(sum(sku_num) as bigint) as payment_suc_sku_num_1d, count(*) as payment_suc_count_1d,
  cast(sum(split_payment_amount) as double) as payment_suc_amount_1d from dwd_trade_pay_detail_suc_inc group by all""")
T["dws_trade_user_sku_order_1d"] = f"""
select o.*, {SKU} from (select ds, user_id, sku_id, count(*) as order_count_1d,
  cast(sum(sku_num) as bigint) as order_num_1d, {SUMS} from dwd_trade_order_detail_inc group by ds, user_id, sku_id) o
left join dim_sku_full s on o.sku_id = s.id"""
REG.job("B17_dws_trade_user_sku_order_1d", daily.dws_trade_user_sku_order_1d, "order",
        final("dws_trade_user_sku_order_1d", A1D))
T["dws_traffic_page_visitor_page_view_1d"] = """
select mid_id, brand, model, operate_system, page_id, ds, cast(sum(during_time) as bigint) as during_time_1d,
  count(*) as view_count_1d from dwd_traffic_page_view_inc where ds = {E.d} group by all"""
REG.job("B18_dws_traffic_page_visitor_page_view_1d", daily.dws_traffic_page_visitor_page_view_1d, "event",
        "select * from dws_traffic_page_visitor_page_view_1d")
T["dws_traffic_session_page_view_1d"] = """
select session_id, mid_id, brand, model, operate_system, version_code, channel, ds,
  cast(sum(during_time) as bigint) as during_time_1d, count(*) as page_count_1d
from dwd_traffic_page_view_inc group by all"""
REG.job("B19_dws_traffic_session_page_view_1d", daily.dws_traffic_session_page_view_1d, "event",
        "select * from dws_traffic_session_page_view_1d")


def wide(stems, clock: str) -> str:
    seven = ", ".join(f"sum(case when ds >= {{{clock}.d7}} then {s}_1d else 0 end) as {s}_7d" for s in stems)
    return seven + ", " + ", ".join(f"sum({s}_1d) as {s}_30d" for s in stems)


CNT_AMT = ["order_count", *daily.AMOUNTS]
T["dws_trade_province_order_nd"] = f"""
select province_id, {PLACE}, {wide(CNT_AMT, 'O')} from dws_trade_province_order_1d
where ds between {{O.d30}} and {{O.d}} group by all"""


def nd_final(table: str, ints) -> str:
    return final(table, [f"{a}_{n}d" for a in daily.AMOUNTS for n in (7, 30)], [f"{i}_{n}d" for i in ints
                                                                              for n in (7, 30)])


REG.job("B20_dws_trade_province_order_nd", daily.dws_trade_province_order_nd, "order",
        nd_final("dws_trade_province_order_nd", ["order_count"]))
T["dws_trade_user_sku_order_nd"] = f"""
select user_id, sku_id, {SKU}, {wide(['order_count', 'order_num', *daily.AMOUNTS], 'O')}
from dws_trade_user_sku_order_1d where ds between {{O.d30}} and {{O.d}} group by all"""
REG.job("B21_dws_trade_user_sku_order_nd", daily.dws_trade_user_sku_order_nd, "order",
        nd_final("dws_trade_user_sku_order_nd", ["order_count", "order_num"]))
T["dws_trade_user_order_td"] = """
select user_id, min(ds) as order_date_first, max(ds) as order_date_last, sum(order_count_1d) as order_count_td,
  sum(order_num_1d) as order_num_td, sum(order_original_amount_1d) as original_amount_td,
  sum(activity_reduce_amount_1d) as activity_reduce_amount_td, sum(coupon_reduce_amount_1d) as coupon_reduce_amount_td,
  sum(order_total_amount_1d) as total_amount_td from dws_trade_user_order_1d group by user_id"""
TD = final("dws_trade_user_order_td", ["original_amount_td", "activity_reduce_amount_td", "coupon_reduce_amount_td",
                                       "total_amount_td"], ["order_count_td", "order_num_td"])
REG.job("B22_dws_trade_user_order_td_init", daily.dws_trade_user_order_td, "order", TD,
        table="dws_trade_user_order_td")


def _td_merged(t: Tables, d: str):
    days = t["dws_trade_user_order_1d"]
    old = daily.dws_trade_user_order_td(t.with_tables(dws_trade_user_order_1d=days.where(F.col("ds") < d)), d)
    return daily.dws_trade_user_order_td_merge(t.with_tables(dws_trade_user_order_td=old), d)


REG.job("B22_dws_trade_user_order_td_merge", _td_merged, "order", TD, table="order_td_merged")


def login_td(until: str, op: str = "<=") -> str:
    return f"""
select u.id as user_id, coalesce(last_ds, left(create_time, 10)) as login_date_last,
  left(create_time, 10) as login_date_first, coalesce(n, 1) as login_count_td
from dim_user_zip u left join (select user_id, max(ds) as last_ds, count(*) as n from dwd_user_login_inc
  where ds {op} {until} group by 1) l on u.id = l.user_id"""


T["dws_user_user_login_td"] = login_td("{E.d}")
T["dws_user_user_login_td_yesterday"] = login_td("{E.y}")
REG.job("B23_dws_user_user_login_td_init", daily.dws_user_user_login_td, "event",
        "select * from dws_user_user_login_td", table="dws_user_user_login_td")


def _yesterday(t: Tables, d: str):
    from tidemill.functions.dates import shift
    return daily.dws_user_user_login_td(t, shift(d, -1))


Tables.jobs["dws_user_user_login_td_yesterday"] = (_yesterday, "event")
REG.job("B23_dws_user_user_login_td_merge", lambda t, d: daily.dws_user_user_login_td_merge(
    t.with_tables(dws_user_user_login_td=t["dws_user_user_login_td_yesterday"]), d), "event", """
select coalesce(o.user_id, n.user_id) as user_id, coalesce(login_date_first, {E.d}) as login_date_first,
  case when n.user_id is not null then {E.d} else login_date_last end as login_date_last,
  coalesce(login_count_td, 0) + coalesce(c, 0) as login_count_td
from dws_user_user_login_td_yesterday o full join
  (select user_id, count(*) as c from dwd_user_login_inc where ds = {E.d} group by 1) n on o.user_id = n.user_id""",
        table="login_td_merged")
USERS_ND = """select province_id, count(distinct case when ds >= {O.d7} then user_id end) as u7,
  count(distinct user_id) as u30 from dwd_trade_order_detail_inc where ds between {O.d30} and {O.d} group by 1"""
T["users_nd"] = USERS_ND
T["province_order_users_nd"] = f"""
select w.*, u7 as user_count_7d, u30 as user_count_30d from (
  select province_id, {PLACE}, {wide(CNT_AMT, 'O')} from dws_trade_province_order_users_1d
  where ds between {{O.d30}} and {{O.d}} group by all) w join users_nd u on w.province_id = u.province_id"""
REG.job("M7_dws_trade_province_order_nd", daily.dws_trade_province_order_users_nd, "order",
        nd_final("province_order_users_nd", ["order_count"]))

# ---------------------------------------------------------------- reports
REG.job("B24_ads_coupon_stats", reports.ads_coupon_stats, "order", """
select {O.d} as dt, coupon_id, coupon_name, cast(sum(used_count_1d) as bigint) as used_count,
  count(*) as used_user_count from dws_tool_user_coupon_coupon_used_1d where ds = {O.d} group by all""")
REG.job("B25_ads_order_by_province", reports.ads_order_by_province, "order", f"""
select {{O.d}} as dt, 1 as recent_days, province_id, {PLACE}, cast(order_count_1d as bigint) as order_count,
  cast(order_total_amount_1d as double) as order_total_amount from dws_trade_province_order_1d where ds = {{O.d}}
union select {{O.d}}, 7, province_id, {PLACE}, cast(order_count_7d as bigint), cast(order_total_amount_7d as double)
from dws_trade_province_order_nd
union select {{O.d}}, 30, province_id, {PLACE}, cast(order_count_30d as bigint), cast(order_total_amount_30d as double)
from dws_trade_province_order_nd""")
REG.job("B26_ads_order_continuously_user_count", reports.ads_order_continuously_user_count, "order", """
select {O.d} as dt, 7 as recent_days, count(distinct user_id) as order_user_count from (
  select user_id, date_diff('day', cast(ds as date), cast(lead(ds, 2, '9999-12-31')
    over (partition by user_id order by ds) as date)) as diff
  from dws_trade_user_order_1d where ds between {O.d7} and {O.d}) where diff = 2""")


def by_group(cols: str) -> str:
    return f"""
select {{O.d}} as dt, recent_days, {cols}, cast(sum(n) as bigint) as order_count,
  count(distinct case when n > 0 then user_id end) as order_user_count from (
  select 1 as recent_days, user_id, {cols}, order_count_1d as n from dws_trade_user_sku_order_1d where ds = {{O.d}}
  union all select 7, user_id, {cols}, order_count_7d from dws_trade_user_sku_order_nd
  union all select 30, user_id, {cols}, order_count_30d from dws_trade_user_sku_order_nd) group by all"""


REG.job("B27_ads_order_stats_by_cate", reports.ads_order_stats_by_cate, "order",
        by_group(", ".join(reports.CATEGORY)))
REG.job("B28_ads_order_stats_by_tm", reports.ads_order_stats_by_tm, "order", by_group("tm_id, tm_name"))
SECS = "date_diff('second', cast(order_time as timestamp), cast(payment_time as timestamp))"
REG.job("B29_ads_order_to_pay_interval_avg", reports.ads_order_to_pay_interval_avg, "order", f"""
select {{O.d}} as dt, cast(sum({SECS}) // count(*) as bigint) as order_to_pay_interval_avg
from dwd_trade_trade_flow_acc where ds in ('9999-12-31', {{O.d}}) and payment_date_id = {{O.d}}""")
REG.job("B30_ads_page_path", reports.ads_page_path, "event", """
select {E.d} as dt, 'step-' || rn || ':' || page_id as source,
  coalesce('step-' || (rn + 1) || ':' || nxt, 'null') as target, count(*) as path_count from (
  select page_id, lead(page_id) over w as nxt, row_number() over w as rn from dwd_traffic_page_view_inc
  where ds = {E.d} window w as (partition by session_id order by view_time, page_id)) group by all""")
REG.job("B31_ads_repeat_purchase_by_tm", reports.ads_repeat_purchase_by_tm, "order", f"""
select {{O.d}} as dt, 30 as recent_days, tm_id, tm_name, {half_up('sum(cast(n >= 2 as int))',
                                                                   'sum(cast(n >= 1 as int))')} as order_repeat_rate
from (select user_id, tm_id, tm_name, sum(order_count_30d) as n from dws_trade_user_sku_order_nd group by all)
group by all""")
REG.job("B32_ads_sku_cart_num_top3_by_cate", reports.ads_sku_cart_num_top3_by_cate, "order", f"""
select * from (select {{O.d}} as dt, sku_id, cart_num, sku_name, {', '.join(reports.CATEGORY)},
  cast(rank() over (partition by category1_id, category2_id, category3_id order by cart_num desc) as int) as rk
  from (select sku_id, cast(sum(sku_num) as bigint) as cart_num from dwd_trade_cart_full group by 1) c
  left join dim_sku_full s on c.sku_id = s.id) where rk <= 3""")
REG.job("B33_ads_sku_favor_count_top3_by_tm", reports.ads_sku_favor_count_top3_by_tm, "event", """
select * from (select {E.d} as dt, tm_id, tm_name, sku_id, sku_name, favor_add_count_1d,
  cast(rank() over (partition by tm_id order by favor_add_count_1d desc) as int) as rk
  from dws_interaction_sku_favor_add_1d) where rk <= 3""")
REG.job("B34_ads_traffic_stats_by_channel", reports.ads_traffic_stats_by_channel, "event", f"""
select {{E.d}} as dt, recent_days, channel, count(distinct mid_id) as uv_count,
  cast(floor(avg(during_time_1d) / 1000) as bigint) as avg_duration_sec,
  cast(floor(avg(page_count_1d)) as bigint) as avg_page_count, count(*) as sv_count,
  {half_up('sum(cast(page_count_1d = 1 as int))', 'count(*)')} as bounce_rate
from dws_traffic_session_page_view_1d join (values (1, {{E.d}}), (7, {{E.d7}}), (30, {{E.d30}})) h(recent_days, lo)
on ds >= lo group by all""")
T["funnel_order_1d"] = "select * from funnel_order"


def _funnel(t: Tables, d: str):
    return reports.ads_user_action(t.with_tables(
        dws_trade_user_order_1d=t["funnel_order"], dws_trade_user_payment_1d=t["funnel_pay"]), d)


REG.job("B35_ads_user_action", _funnel, "event", """
select {E.d} as dt,
  (select count(*) from dws_traffic_page_visitor_page_view_1d where page_id = 'home') as home_count,
  (select count(*) from dws_traffic_page_visitor_page_view_1d where page_id = 'good_detail') as good_detail_count,
  (select count(*) from dws_trade_user_cart_add_1d where ds = {E.d}) as cart_count,
  (select count(*) from funnel_order where ds = {E.d}) as order_count,
  (select count(*) from funnel_pay where ds = {E.d}) as payment_count""", table="ads_user_action")
REG.job("B36_ads_user_change", reports.ads_user_change, "event", """
select {E.d} as dt, (select count(*) from dws_user_user_login_td where login_date_last = {E.w}) as user_churn_count,
  (select count(*) from dws_user_user_login_td a join dws_user_user_login_td_yesterday b on a.user_id = b.user_id
   where a.login_date_last = {E.d}
     and date_diff('day', cast(b.login_date_last as date), cast(a.login_date_last as date)) >= 8) as user_back_count""")
REG.job("B37_ads_user_retention", reports.ads_user_retention, "event", f"""
select {{E.d}} as dt, login_date_first as create_date,
  cast(date_diff('day', cast(login_date_first as date), cast({{E.d}} as date)) as int) as retention_day,
  cast(sum(cast(login_date_last = {{E.d}} as int)) as bigint) as retention_count, count(*) as new_user_count,
  {half_up('100 * sum(cast(login_date_last = {E.d} as int))', 'count(*)')} as retention_rate
from dws_user_user_login_td where login_date_first >= {{E.w}} and login_date_first < {{E.d}} group by login_date_first""")
REG.job("B38_ads_user_stats", reports.ads_user_stats, "event", """
select {E.d} as dt, recent_days, count(*) filter (where login_date_first >= lo) as new_user_count,
  count(*) as active_user_count
from dws_user_user_login_td join (values (1, {E.d}), (7, {E.d7}), (30, {E.d30})) h(recent_days, lo)
on login_date_last between lo and {E.d} group by recent_days""")
REG.job("M8_dws_trade_order_to_pay_interval_1d", reports.order_to_pay_interval_1d, "order", f"""
select left(payment_time, 10) as ds, cast(sum({SECS}) // count(*) as bigint) as order_to_pay_interval_avg
from dwd_trade_trade_flow_acc where payment_time is not null group by 1""")
REG.job("M10_ads_new_user_order_count", reports.ads_new_user_order_stats, "order", """
select {O.d} as dt, count(*) filter (where order_date_first >= {O.d}) as new_order_user_count_1d,
  count(*) filter (where order_date_first >= {O.d7}) as new_order_user_count_7d,
  count(*) filter (where order_date_first >= {O.d30}) as new_order_user_count_30d from dws_trade_user_order_td""")
REG.job("M11_ads_province_order", reports.ads_province_order_wide, "order", f"""
select {{O.d}} as dt, m.* , u7 as order_user_num_1w, u30 as order_user_num_1m, order_user_num_1d,
  cast(order_total_amount_1d as double) as order_total_amount_1d
from (select province_id, {PLACE},
    cast(sum(case when ds >= {{O.d7}} then order_total_amount_1d else 0 end) as double) as order_total_amount_1w,
    cast(sum(order_total_amount_1d) as double) as order_total_amount_1m
  from dws_trade_province_order_users_1d where ds between {{O.d30}} and {{O.d}} group by all) m
join users_nd u on m.province_id = u.province_id
left join (select province_id, order_user_num_1d, order_total_amount_1d from dws_trade_province_order_users_1d
  where ds = {{O.d}}) t on m.province_id = t.province_id""")
