"""Dashboard queries: jobs over the derived inputs, and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry.core import REG, Tables, half_up
from tidemill.plans import board_categories as cats
from tidemill.plans import board_pages as pages
from tidemill.plans import board_products as prods
from tidemill.plans import board_stores as stores
from tidemill.plans import rfm

T = REG.tables


def dbl(*cols: str) -> str:
    return ", ".join(f"cast({c} as double) as {c}" for c in cols)


def big(*cols: str) -> str:
    return ", ".join(f"cast({c} as bigint) as {c}" for c in cols)


# ---------------------------------------------------------------- product ranking
CONV = f"case when visitor_count = 0 then 0 else {half_up('pay_buyer_count', 'visitor_count', 4)} end"
NAMED = "left join ods_product_base b on x.product_id = b.product_id"
T["dwd_product_sales_daily"] = f"""
select x.* replace (case when sales_amount < 0 then 0 else sales_amount end as sales_amount,
  case when sales_quantity < 0 then 0 else sales_quantity end as sales_quantity), product_name, product_category, brand,
  shop_id, cast({CONV} as double) as pay_conversion_rate from ods_product_sales_daily x {NAMED}"""
REG.job("G1_dwd_product_sales_daily", prods.dwd_product_sales_daily, "order",
        f"select * replace ({dbl('sales_amount')}) from dwd_product_sales_daily")
T["dwd_traffic_source_daily"] = f"""
select x.*, product_name, cast({CONV} as double) as pay_conversion_rate from ods_traffic_source_daily x {NAMED}"""
REG.job("G1_dwd_traffic_source_daily", prods.dwd_traffic_source_daily, "order",
        "select * from dwd_traffic_source_daily")
T["dwd_sku_sales_inventory_daily"] = f"""
select * exclude (s, n) replace (case when current_stock < 0 then 0 else current_stock end as current_stock),
  cast(s // n as int) as avg_daily_sales,
  cast(case when s = 0 then 0 else {half_up('(case when current_stock < 0 then 0 else current_stock end) * n', 's')} end
    as double) as stock_available_days
from (select x.*, product_name, sum(pay_quantity) over w as s, count(pay_quantity) over w as n
  from ods_sku_sales_inventory_daily x {NAMED}
  window w as (partition by sku_id order by stat_date rows between 6 preceding and current row))"""
REG.job("G1_dwd_sku_sales_inventory_daily", prods.dwd_sku_sales_inventory_daily, "order",
        f"select * replace ({dbl('sales_amount')}) from dwd_sku_sales_inventory_daily")
T["dwd_search_word_daily"] = f"select x.*, product_name from ods_search_word_daily x {NAMED}"
REG.job("G1_dwd_search_word_daily", prods.dwd_search_word_daily, "order", "select * from dwd_search_word_daily")
T["dwd_price_strength_daily"] = f"""
select x.*, product_name, product_category from ods_price_strength_product x {NAMED}"""
REG.job("G1_dwd_price_strength_daily", prods.dwd_price_strength_daily, "order",
        f"select * replace ({dbl('coupon_price')}) from dwd_price_strength_daily")
T["dwd_product_warning_daily"] = f"select x.*, product_name from ods_product_warning_daily x {NAMED}"
REG.job("G1_dwd_product_warning_daily", prods.dwd_product_warning_daily, "order",
        "select * from dwd_product_warning_daily")

SPANS = "(values ('d', {O.d}), ('7d', {O.d7}), ('30d', {O.d30})) h(time_type, start_date)"


def spans(cols: str, table: str, day: str = "stat_date") -> str:
    return f"""
select time_type, start_date, {{O.d}} as end_date, {cols} from {table} join {SPANS}
on {day} between start_date and {{O.d}} group by all"""


T["dws_product_sales"] = spans(
    "product_name, product_category, cast(sum(sales_amount) as double) as total_sales_amount, "
    "cast(sum(sales_quantity) as bigint) as total_sales_quantity", "dwd_product_sales_daily")
REG.job("G2_dws_product_sales", prods.dws_product_sales, "order", "select * from dws_product_sales")
T["dws_traffic_source"] = spans(
    f"source_name, cast(sum(visitor_count) as bigint) as total_visitor_count, "
    f"{half_up('sum(pay_buyer_count)', 'sum(visitor_count)', 4)} as total_pay_conversion_rate",
    "dwd_traffic_source_daily")
REG.job("G2_dws_traffic_source", prods.dws_traffic_source, "order", "select * from dws_traffic_source")
T["dws_sku_sales"] = spans(
    "sku_id, product_name, sku_info, cast(sum(pay_quantity) as bigint) as total_pay_quantity, "
    "cast(max(current_stock) as bigint) as current_stock, "
    + half_up("sum(cast(stock_available_days as decimal(16,2)))", "count(*)") + " as stock_available_days",
    "dwd_sku_sales_inventory_daily")
REG.job("G2_dws_sku_sales", prods.dws_sku_sales, "order", "select * from dws_sku_sales")
T["dws_search_word"] = spans("search_word, cast(sum(visitor_count) as bigint) as total_visitor_count",
                             "dwd_search_word_daily")
REG.job("G2_dws_search_word", prods.dws_search_word, "order", "select * from dws_search_word")
T["dws_price_strength"] = spans("price_strength_level, product_category, count(distinct product_id) as product_count",
                                "dwd_price_strength_daily", "ds")
REG.job("G2_dws_price_strength", prods.dws_price_strength, "order", "select * from dws_price_strength")
T["dws_product_warning"] = spans("product_name, warning_type, warning_reason", "dwd_product_warning_daily")
REG.job("G2_dws_product_warning", prods.dws_product_warning, "order", "select * from dws_product_warning")
REG.job("G3_ads_product_sales_ranking", prods.ads_product_sales_ranking, "order", """
select product_name, product_category, time_type, sum(total_sales_amount) as sales_amount,
  cast(sum(total_sales_quantity) as bigint) as sales_quantity from dws_product_sales group by all""")
REG.job("G3_ads_traffic_source_top10", prods.ads_traffic_source_top10, "order", """
select source_name, time_type, total_visitor_count as visitor_count, total_pay_conversion_rate as pay_conversion_rate
from (select *, row_number() over (partition by time_type order by total_visitor_count desc, source_name) as rn
  from dws_traffic_source) where rn <= 10""")
REG.job("G3_ads_sku_sales_top5", prods.ads_sku_sales_top5, "order", f"""
select sku_info, time_type, total_pay_quantity as pay_quantity, {half_up('total_pay_quantity', 'al', 4)}
  as pay_quantity_ratio, current_stock, stock_available_days
from (select *, sum(total_pay_quantity) over (partition by time_type) as al,
  row_number() over (partition by time_type order by total_pay_quantity desc, sku_id) as rn
  from dws_sku_sales) where rn <= 5""")
REG.job("G3_ads_search_word_top10", prods.ads_search_word_top10, "order", """
select search_word, time_type, total_visitor_count as visitor_count
from (select *, row_number() over (partition by time_type order by total_visitor_count desc, search_word) as rn
  from dws_search_word) where rn <= 10""")
REG.job("G3_ads_price_strength_overview", prods.ads_price_strength_overview, "order", """
select price_strength_level, time_type, cast(sum(product_count) as bigint) as product_count from dws_price_strength
group by all""")
REG.job("G3_ads_product_warning_list", prods.ads_product_warning_list, "order", """
select product_name, warning_type, time_type, warning_reason from dws_product_warning""")

# ---------------------------------------------------------------- categories
T["dwd_trade_sales_detail"] = "select * exclude (create_time), left(create_time, 10) as create_dt from ods_sales_full"
REG.job("G4_dwd_trade_sales_detail", cats.dwd_trade_sales_detail, "order",
        f"select * replace ({dbl('pay_amount')}) from dwd_trade_sales_detail")
T["dwd_item_attribute_detail"] = "select * exclude (visit_time), left(visit_time, 10) as visit_dt from ods_attribute_info"
REG.job("G4_dwd_item_attribute_detail", cats.dwd_item_attribute_detail, "event",
        "select * from dwd_item_attribute_detail")
T["dwd_traffic_source_detail"] = "select * exclude (visit_time), left(visit_time, 10) as visit_dt from ods_traffic_detail"
REG.job("G4_dwd_traffic_source_detail", cats.dwd_traffic_source_detail, "event",
        "select * from dwd_traffic_source_detail")
T["dwd_user_behavior_detail"] = """
select b.* exclude (behavior_time), left(behavior_time, 10) as behavior_dt, age, gender, region, consumption_level
from ods_user_behavior_full b left join ods_user_profile u on b.user_id = u.user_id"""
REG.job("G4_dwd_user_behavior_detail", cats.dwd_user_behavior_detail, "event",
        "select * from dwd_user_behavior_detail")


def label(kind: str, start: str, end: str) -> str:
    return f"case when {kind} = '1d' then {end} else {start} || '至' || {end} end as time_value"


def trailing(clock: str) -> str:
    return (f"(values ('1d', {{{clock}.d}}), ('7d', {{{clock}.d7}}), ('30d', {{{clock}.d30}})) h(time_type, lo)")


T["dws_sales_analysis"] = f"""
select category_id, category_name, item_name, last_month_rank, cast(total_sales as double) as total_sales,
  cast(total_quantity as bigint) as total_quantity,
  rank() over (partition by time_type, category_id order by total_sales desc) as item_sales_rank,
  case when time_type = '30d' then {half_up('total_sales * 100', 'target_gmv')} end as monthly_pay_progress,
  case when time_type = '30d' then {half_up('total_sales * 100', 'al')} end as monthly_pay_contribution,
  time_type, {label('time_type', 'lo', '{O.d}')}
from (select *, sum(total_sales) over (partition by time_type) as al from (
  select time_type, lo, category_id, category_name, item_name, target_gmv, last_month_rank, sum(pay_amount) as total_sales,
    sum(pay_quantity) as total_quantity
  from dwd_trade_sales_detail join {trailing('O')} on create_dt between lo and {{O.d}} group by all))"""
REG.job("G5_dws_sales_analysis", cats.dws_sales_analysis, "order", "select * from dws_sales_analysis")
REG.job("G5_dws_sales_by_day", cats.sales_by_day, "order", """
select category_id, category_name, item_name, last_month_rank, create_dt, cast(total_sales as double) as total_sales,
  cast(total_quantity as bigint) as total_quantity,
  rank() over (partition by category_id, create_dt, time_type order by total_sales desc) as item_sales_rank, time_type,
  case when n = 0 then create_dt else strftime(cast(create_dt as date) - n, '%Y-%m-%d') || '至' || create_dt end
    as time_value
from (select category_id, category_name, item_name, target_gmv, last_month_rank, create_dt,
    sum(pay_amount) as total_sales, sum(pay_quantity) as total_quantity from dwd_trade_sales_detail group by all),
  (values ('1d', 0), ('7d', 6), ('30d', 29)) h(time_type, n)""", table="sales_by_day")
T["dws_attribute_analysis"] = f"""
select category_id, category_name, attr_id, attr_value, time_type, {label('time_type', 'lo', '{E.d}')},
  count(distinct visitor_id) as attr_visitor_count,
  {half_up('count(distinct case when is_pay = 1 then visitor_id end) * 100', 'count(distinct visitor_id)')}
    as attr_pay_conversion, count(distinct item_id) as active_item_count
from dwd_item_attribute_detail join {trailing('E')} on visit_dt between lo and {{E.d}} group by all"""
REG.job("G5_dws_attribute_analysis", cats.dws_attribute_analysis, "event", "select * from dws_attribute_analysis")
T["dws_traffic_analysis"] = f"""
select *, rank() over (partition by category_id order by hot_word_visitor_count desc) as hot_word_rank from (
  select category_id, category_name, channel, search_word, {{E.d30}} || '至' || {{E.d}} as time_value,
    count(distinct visitor_id) as channel_visitor_count,
    {half_up('count(distinct case when is_pay = 1 then visitor_id end) * 100', 'count(distinct visitor_id)')}
      as channel_pay_conversion,
    count(distinct case when search_word is not null then visitor_id end) as hot_word_visitor_count
  from dwd_traffic_source_detail where visit_dt between {{E.d30}} and {{E.d}} group by all)"""
REG.job("G5_dws_traffic_analysis", cats.dws_traffic_analysis, "event", "select * from dws_traffic_analysis")
T["dws_customer_insight"] = f"""
select c.*, {half_up('crowd_count * 100', 'tot')} as crowd_ratio from (
  select category_id, category_name, behavior_type, age, gender, region, consumption_level,
    {{E.d30}} || '至' || {{E.d}} as time_value, count(distinct user_id) as crowd_count
  from dwd_user_behavior_detail where behavior_dt between {{E.d30}} and {{E.d}} group by all) c
join (select category_id, behavior_type, count(distinct user_id) as tot from dwd_user_behavior_detail
  where behavior_dt between {{E.d30}} and {{E.d}} group by all) x
on c.category_id = x.category_id and c.behavior_type = x.behavior_type"""
REG.job("G5_dws_customer_insight", cats.dws_customer_insight, "event", "select * from dws_customer_insight")
REG.job("G6_ads_sales_analysis", cats.ads_sales_analysis, "order",
        "select * exclude (time_value) from dws_sales_analysis")
REG.job("G6_ads_attribute_analysis", cats.ads_attribute_analysis, "event",
        "select * exclude (time_value) from dws_attribute_analysis")
REG.job("G6_ads_traffic_analysis", cats.ads_traffic_analysis, "event",
        "select * exclude (time_value) from dws_traffic_analysis")
REG.job("G6_ads_customer_insight", cats.ads_customer_insight, "event", """
select category_id, category_name, behavior_type, cast(sum(crowd_count) as bigint) as crowd_count
from dws_customer_insight group by all""")

# ---------------------------------------------------------------- pages
PAGES = "('首页', '自定义承接页', '商品详情页')"
OUT = "('直播间', '短视频', '图文', '微详情')"
T["page_detail"] = f"""
select u.user_id, click_time, u.page_type, u.block_id, block_name, block_position, channel, is_click,
  if(channel in {OUT}, 1, 0) as is_exclude_channel, trade_id, coalesce(pay_amount, 0) as pay_amount, pay_time, u.ds
from ods_user_behavior u left join ods_page_structure s on u.page_type = s.page_type and u.block_id = s.block_id
  and u.ds = s.ds
left join ods_trade_data t on u.user_id = t.user_id and u.block_id = t.guide_block_id
  and left(click_time, 10) = left(pay_time, 10) and u.ds = t.ds where u.page_type in {PAGES}"""
REG.job("G7_dwd_user_page_behavior_detail", pages.dwd_user_page_behavior_detail, "event",
        f"select * replace ({dbl('pay_amount')}) from page_detail")
T["dws_page_stats"] = """
select page_type, left(click_time, 10) as stat_date,
  count(distinct case when is_exclude_channel = 0 then user_id end) as visitor_count,
  count(case when is_click = 1 then 1 end) as click_count,
  count(distinct case when is_click = 1 then user_id end) as click_user_count from page_detail group by all"""
REG.job("G8_dws_page_stats", pages.dws_page_stats, "event", "select * from dws_page_stats")
T["dws_block_stats"] = """
select *, cast(sum(block_click_count) over (partition by page_type) as bigint) as page_total_click from (
  select page_type, block_id, block_name, count(case when is_click = 1 then 1 end) as block_click_count,
    count(distinct case when is_click = 1 then user_id end) as block_click_user_count,
    cast(sum(pay_amount) as double) as guide_pay_amount from page_detail where ds = {E.d} group by all)"""
REG.job("G8_dws_block_stats", pages.dws_block_stats, "event", "select * from dws_block_stats")
REG.job("G9_ads_page_overview_report", pages.ads_page_overview_report, "event",
        "select page_type, stat_date, click_count, click_user_count, visitor_count from dws_page_stats "
        "where stat_date = {E.d}")
REG.job("G9_ads_block_click_report", pages.ads_block_click_report, "event",
        "select page_type, block_id, block_name, block_click_count, block_click_user_count, guide_pay_amount as "
        "block_guide_pay_amount from dws_block_stats")
REG.job("G9_ads_page_trend_report", pages.ads_page_trend_report, "event", """
select page_type, stat_date, visitor_count as daily_visitor_count, click_user_count as daily_click_user_count
from dws_page_stats where stat_date between {E.d30} and {E.d}""")
REG.job("G9_ads_guide_detail_report", pages.ads_guide_detail_report, "event", """
select page_type, block_id as guide_product_id, block_click_count as guide_click_count,
  block_click_user_count as guide_visitor_count from dws_block_stats where block_name like '%商品%'""")
REG.job("G9_ads_module_detail_report", pages.ads_module_detail_report, "event", f"""
select page_type, block_id as module_id, block_name as module_name, block_click_count as module_click_count,
  {half_up('block_click_count * 100', 'page_total_click')} as module_click_ratio_percent from dws_block_stats""")
RAW = f"from ods_user_behavior u where u.page_type in {PAGES}"
REG.job("G10_direct_page_overview", pages.direct_page_overview, "event", f"""
select page_type, left(click_time, 10) as stat_date, count(block_id) as click_count,
  count(distinct user_id) as click_user_count,
  count(distinct case when channel not in {OUT} then user_id end) as visitor_count
{RAW} and ds = {{E.d}} group by all""")
REG.job("G10_direct_block_click", pages.direct_block_click, "event", """
select page_type, block_id, block_name, count(*) as block_click_count,
  count(distinct user_id) as block_click_user_count,
  cast(sum(nullif(pay_amount, 0)) as double) as block_guide_pay_amount from page_detail where ds = {E.d} group by all""")
REG.job("G10_direct_page_trend", pages.direct_page_trend, "event", f"""
select page_type, left(click_time, 10) as stat_date,
  count(distinct case when channel not in {OUT} then user_id end) as daily_visitor_count,
  count(distinct user_id) as daily_click_user_count {RAW} and ds between {{E.d30}} and {{E.d}} group by all""")
REG.job("G10_direct_guide_detail", pages.direct_guide_detail, "event", f"""
select page_type, block_id as guide_product_id, count(*) as guide_click_count,
  count(distinct user_id) as guide_visitor_count {RAW} and is_click = 1 and ds = {{E.d}}
  and exists (select 1 from ods_page_structure s where s.block_id = u.block_id and block_name like '%商品%'
    and s.ds = {{E.d}}) group by all""")
REG.job("G10_direct_module_detail", pages.direct_module_detail, "event", f"""
select page_type, block_id as module_id, block_name as module_name, n as module_click_count,
  {half_up('n * 100', 'al')} as module_click_ratio_percent from (
  select *, sum(n) over (partition by page_type) as al from (
    select u.page_type, u.block_id, block_name, count(*) as n from ods_user_behavior u
    left join ods_page_structure s on u.page_type = s.page_type and u.block_id = s.block_id and s.ds = u.ds
    where u.page_type in {PAGES} and u.ds = {{E.d}} group by all))""")

# ---------------------------------------------------------------- stores
T["unified"] = """
select 'wireless_instore' as data_type, visitor_id, store_id, page_type, cast(null as varchar) as page_category,
  cast(null as varchar) as page_subtype, cast(null as varchar) as source_page, cast(null as varchar) as target_page,
  visit_time, is_buy, cast(null as int) as stay_time, dt from ods_wireless_instore_log
union all select 'page_visit', visitor_id, store_id, null, page_category, page_subtype, null, null, visit_time, null,
  stay_time, dt from ods_page_visit_log where stay_time > 0
union all select 'instore_flow', visitor_id, store_id, null, null, null, source_page, target_page, jump_time, null,
  null, dt from ods_instore_flow_log where source_page is not null and target_page is not null
union all select 'pc_entry', visitor_id, store_id, null, null, null, source_page, null, visit_time, null, null, dt
from ods_pc_entry_log"""
REG.job("G11_dwd_traffic_unified_detail", stores.dwd_traffic_unified_detail, "event", "select * from unified")
T["dws_wireless_pc_summary"] = """
select dt, store_id, page_type, cast(null as varchar) as source_page, count(distinct visitor_id) as wireless_uv,
  count(distinct case when is_buy = 1 then visitor_id end) as wireless_buyer_num, cast(null as bigint) as pc_uv
from unified where data_type = 'wireless_instore' group by all
union all select dt, store_id, null, source_page, null, null, count(distinct visitor_id) from unified
where data_type = 'pc_entry' group by dt, store_id, source_page"""
REG.job("G12_dws_wireless_pc_summary", stores.dws_wireless_pc_summary, "event",
        "select * from dws_wireless_pc_summary")
T["dws_page_visit_summary"] = f"""
select dt, store_id, page_category, page_subtype, count(distinct visitor_id) as page_uv, count(*) as page_pv,
  {half_up('sum(stay_time)', 'count(stay_time)')} as avg_stay_time from unified where data_type = 'page_visit'
group by all"""
REG.job("G12_dws_page_visit_summary", stores.dws_page_visit_summary, "event",
        "select * from dws_page_visit_summary")
T["dws_instore_flow_summary"] = """
select *, cast(sum(flow_uv) over (partition by dt, store_id) as bigint) as total_store_flow from (
  select dt, store_id, source_page, target_page, count(visitor_id) as flow_uv from unified
  where data_type = 'instore_flow' group by all)"""
REG.job("G12_dws_instore_flow_summary", stores.dws_instore_flow_summary, "event",
        "select * from dws_instore_flow_summary")
REG.job("G13_ads_wireless_instore_analysis", stores.ads_wireless_instore_analysis, "event", f"""
select dt, store_id, page_type, wireless_uv as total_uv, wireless_buyer_num as total_buyer_num,
  {half_up('wireless_buyer_num', 'wireless_uv', 4)} as conversion_rate from dws_wireless_pc_summary
where page_type is not null""")
REG.job("G13_ads_page_visit_rank", stores.ads_page_visit_rank, "event", """
select *, row_number() over (partition by dt, store_id order by page_uv desc, page_category, page_subtype) as rank_num
from dws_page_visit_summary""")
REG.job("G13_ads_instore_flow_analysis", stores.ads_instore_flow_analysis, "event", f"""
select * exclude (total_store_flow), {half_up('flow_uv', 'total_store_flow', 4)} as source_ratio
from dws_instore_flow_summary""")
REG.job("G13_ads_pc_entry_analysis", stores.ads_pc_entry_analysis, "event", f"""
select dt, store_id, source_page, pc_uv as source_uv, {half_up('pc_uv', 'al', 4)} as source_ratio,
  cast(rn as int) as top_rank
from (select *, sum(pc_uv) over (partition by dt, store_id) as al,
  row_number() over (partition by dt, store_id order by pc_uv desc, source_page) as rn from dws_wireless_pc_summary
  where source_page is not null) where rn <= 20""")


def month(fn):
    from tidemill.functions.dates import horizon_start

    def run(t: Tables):
        d = t.d("event")
        return fn(t, horizon_start(d, 30), d)
    return run


IN30 = "where dt between {E.d30} and {E.d}"
REG.query("G14_direct_wireless", month(stores.direct_wireless), f"""
select store_id, page_type, count(distinct visitor_id) as uv,
  count(distinct case when is_buy = 1 then visitor_id end) as buyer_num from ods_wireless_instore_log {IN30}
group by all""")
REG.query("G14_direct_page_visits", month(stores.direct_page_visits), f"""
select store_id, page_category, page_subtype, count(distinct visitor_id) as page_uv, count(*) as page_pv,
  {half_up('sum(stay_time)', 'count(stay_time)')} as avg_stay_time from ods_page_visit_log {IN30} group by all""")
REG.query("G14_direct_flow", month(stores.direct_flow), f"""
select store_id, source_page, target_page, flow_uv, {half_up('flow_uv', 'al', 4)} as source_ratio from (
  select *, sum(flow_uv) over (partition by store_id) as al from (
    select store_id, source_page, target_page, count(distinct visitor_id) as flow_uv from ods_instore_flow_log {IN30}
    group by all))""")
REG.query("G14_direct_pc_entries", month(stores.direct_pc_entries), f"""
select store_id, source_page, source_uv, {half_up('source_uv', 'al', 4)} as source_uv_ratio from (
  select *, sum(source_uv) over (partition by store_id) as al from (
    select store_id, source_page, count(distinct visitor_id) as source_uv from ods_pc_entry_log {IN30} group by all))
order by source_uv desc, store_id, source_page limit 20""")

# ---------------------------------------------------------------- customer value
T["rfm_table"] = """
select customer_id, count(transaction_id) as frequency, cast(sum(transaction_amount) as double) as monetary,
  cast(date_diff('day', max(cast(left(transaction_date, 10) as date)),
    (select max(cast(left(transaction_date, 10) as date)) from transactions) + 1) as int) as recency
from transactions group by 1"""


def score(col: str, down: bool = False) -> str:
    bins = " ".join(f"when {col} <= (select quantile_cont(cast({col} as double), {p}) from rfm_table) then "
                    f"{6 - i if down else i}" for i, p in ((1, 0.2), (2, 0.4), (3, 0.6), (4, 0.8)))
    return f"case {bins} else {1 if down else 5} end"


T["rfm_scored"] = f"""
select *, cast({score('recency', True)} as int) as r_score, cast({score('frequency')} as int) as f_score,
  cast({score('monetary')} as int) as m_score from rfm_table"""
T["rfm_scores"] = """
select *, r_score + f_score + m_score as rfm_total_score, case
  when r_score >= 4 and f_score >= 4 and m_score >= 4 then '高价值客户'
  when r_score >= 3 and f_score >= 4 and m_score >= 3 then '忠诚客户'
  when r_score >= 4 and f_score <= 3 and m_score >= 4 then '潜力客户'
  when r_score <= 2 and f_score >= 3 and m_score >= 3 then '流失预警客户'
  when r_score between 3 and 4 and f_score between 2 and 3 and m_score between 2 and 3 then '一般维持客户'
  else '低价值客户' end as segment from rfm_scored"""
REG.job("G15_rfm", rfm.rfm, "order", "select * from rfm_table")
REG.job("G15_rfm_scores", rfm.rfm_scores, "order", "select * from rfm_scores")
REG.job("G15_segment_profile", rfm.segment_profile, "order", """
select segment, count(*) as customers, cast(sum(r_score) as double) / count(*) as avg_r_score,
  cast(sum(f_score) as double) / count(*) as avg_f_score, cast(sum(m_score) as double) / count(*) as avg_m_score
from rfm_scores group by 1""")
