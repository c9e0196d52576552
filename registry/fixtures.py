"""The warehouse inputs derived from the given tables.

Only the *inputs* of the jobs are defined here, once for both engines: the two dialects differ in a few functions.
What the jobs compute from them is written twice, as Spark jobs in ``tidemill`` and as SQL in ``registry.sql_*``.
"""

from __future__ import annotations

from dataclasses import dataclass

BASE = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
        "conversations").split()


@dataclass(frozen=True)
class Dialect:
    spark: bool

    def ds(self, x: str) -> str:
        return f"date_format({x},'yyyy-MM-dd')" if self.spark else f"strftime({x},'%Y-%m-%d')"

    def tm(self, x: str) -> str:
        return f"date_format({x},'yyyy-MM-dd HH:mm:ss')" if self.spark else f"strftime({x},'%Y-%m-%d %H:%M:%S')"

    def ms(self, x: str) -> str:
        return f"unix_millis(cast({x} as timestamp))" if self.spark else f"(epoch_us({x}) // 1000)"

    def hours(self, x: str, h: str) -> str:
        return f"({x} + make_dt_interval(0, cast({h} as int), 0, 0))" if self.spark else f"({x} + to_hours({h}))"

    def div(self, a: str, b: str) -> str:
        return f"({a} div {b})" if self.spark else f"({a} // {b})"

    def dec(self, x: str, s: int = 2) -> str:
        return f"cast({x} as decimal(16,{s}))"

    def k(self) -> str:
        return "cast(regexp_extract(props, '([0-9]+)', 1) as int)"

    def page(self) -> str:
        return ("case event_type when 'view' then '首页' when 'click' then '自定义承接页' "
                "when 'purchase' then '商品详情页' else '其他' end")

    def t0(self) -> str:
        """A time of day for every order: the order table only has days."""
        return f"({self.ms('o_orderdate')} + o_orderkey % 86400 * 1000)"

    def line_id(self) -> str:
        return ("cast(l_orderkey as string) || '-' || cast(l_partkey as string) || '-' || cast(l_suppkey as string) "
                "|| '-' || cast(l_linenumber as string) || '-' || cast(cast(l_extendedprice as decimal(16,2)) as string)")


def sources(dialect: Dialect) -> dict[str, str]:
    """name -> SELECT over the given tables (``{orders}`` style references)."""
    q = dialect
    price, disc, tax = q.dec("l_extendedprice"), "cast(l_discount as decimal(4,2))", "cast(l_tax as decimal(4,2))"
    out = {
        # ---- retail
        "ods_base_region": "select r_regionkey as id, r_name as region_name from {region}",
        "ods_base_province": """
            select n_nationkey as id, n_name as name, n_regionkey as region_id,
                   cast(10 + n_nationkey as string) as area_code, 'N' || cast(n_nationkey as string) as iso_code,
                   'X-' || cast(n_nationkey as string) as iso_3166_2 from {nation}""",
        "ods_sku_info": f"""
            select p_partkey as id, {q.dec('p_retailprice')} as price, p_name as sku_name,
                   p_name || ' ' || p_type as sku_desc, p_size as weight, 1 as is_sale, p_name as spu_id,
                   p_type || '/' || cast(p_size as string) as category3_id, p_brand as tm_id,
                   '1995-01-01 00:00:00' as create_time from {{part}}""",
        "ods_spu_info": "select distinct p_name as id, upper(p_name) as spu_name from {part}",
        "ods_base_category3": f"""
            select distinct p_type || '/' || cast(p_size as string) as id, 'size ' || cast(p_size as string) as name,
                   p_type || '-' || cast({q.div('p_size', '10')} as string) as category2_id from {{part}}""",
        "ods_base_category2": f"""
            select distinct p_type || '-' || cast({q.div('p_size', '10')} as string) as id,
                   'tens ' || cast({q.div('p_size', '10')} as string) as name, p_type as category1_id from {{part}}""",
        "ods_base_category1": "select distinct p_type as id, lower(p_type) as name from {part}",
        "ods_base_trademark": "select distinct p_brand as id, 'TM ' || p_brand as tm_name from {part}",
        "ods_sku_attr_value": """
            select p_partkey as sku_id, 1 as attr_id, p_size as value_id, 'size' as attr_name,
                   cast(p_size as string) as value_name from {part}
            union all
            select p_partkey, 2, length(p_type), 'type', p_type from {part}""",
        "ods_sku_sale_attr_value": """
            select l_partkey as sku_id, 7 as sale_attr_id, l_linenumber as sale_attr_value_id, 'line' as sale_attr_name,
                   l_returnflag as sale_attr_value_name from {lineitem}""",
        "ods_activity_info": """
            select n_nationkey as id, 'Act ' || n_name as activity_name, n_name as activity_desc,
                   '1995-01-01 00:00:00' as start_time, '2001-12-31 00:00:00' as end_time,
                   '1994-12-01 00:00:00' as create_time from {nation}""",
        "ods_activity_rule": f"""
            select s_suppkey as id, s_nationkey as activity_id, cast(3101 + s_suppkey % 4 as string) as activity_type,
                   {q.dec('s_acctbal')} as condition_amount, s_nationkey + 1 as condition_num,
                   cast(s_nationkey + 2 as int) as benefit_amount, cast(s_nationkey % 10 as int) as benefit_discount,
                   cast(s_suppkey % 3 + 1 as int) as benefit_level from {{supplier}}""",
        "ods_coupon_info": f"""
            select p_partkey as id, 'Coupon ' || p_name as coupon_name, cast(3201 + p_size % 4 as string) as coupon_type,
                   {q.dec('p_retailprice')} as condition_amount, p_size as condition_num,
                   p_size % 25 as activity_id, p_size * 2 as benefit_amount, p_size % 10 as benefit_discount,
                   '1995-01-01 00:00:00' as create_time, cast(3301 + p_size % 3 as string) as range_type,
                   p_size as limit_num from {{part}}""",
        "ods_promotion_pos": """
            select n_nationkey as id, n_name as pos_location, 'banner' as pos_type, 'activity' as promotion_type,
                   '1995-01-01 00:00:00' as create_time, cast(null as string) as operate_time from {nation}""",
        "ods_promotion_refer": """
            select r_regionkey as id, r_name as refer_name, '1995-01-01 00:00:00' as create_time,
                   cast(null as string) as operate_time from {region}""",
        "ods_base_dic": """
            select * from (values ('3101','spend','31'),('3102','buy','31'),('3103','discount','31'),
                ('3201','spend','32'),('3202','buy','32'),('3203','cash','32'),('3301','category','33'),
                ('3302','brand','33'),('1101','card','11'),('1102','wallet','11'),('1201','good','12'),
                ('1202','fair','12'),('1203','bad','12'),('60020','received','600'),('60050','moving','600'),
                ('60080','signed','600'),('A','accepted','cargo'),('N','normal','cargo'),('R','returned','cargo'),
                ('1501','quality','15'),('1502','other','15'),('HIGH','quick','pay'),('LOW','slow','pay'))
            as dic(dic_code, dic_name, parent_code)""",
        "ods_user_info": f"""
            select c_custkey as id, c_name as name, '13' || lpad(cast(c_custkey as string), 9, '0') as phone_num,
                   case when c_custkey % 7 = 0 then 'broken' else 'u' || cast(c_custkey as string) || '@mail.example'
                   end as email, c_mktsegment as user_level, '1980-01-01' as birthday,
                   case when c_custkey % 3 = 0 then 'F' when c_custkey % 3 = 1 then 'M' end as gender,
                   '2024-01-' || lpad(cast(c_custkey % 30 + 1 as string), 2, '0') || ' 08:00:00' as create_time,
                   cast(null as string) as operate_time from {{customer}}""",
        "ods_user_info_inc": f"""
            select c_custkey as id, c_name as name, '13' || lpad(cast(c_custkey as string), 9, '0') as phone_num,
                   'new' || cast(c_custkey as string) || '@mail.example' as email, o_orderpriority as user_level,
                   '1980-01-01' as birthday, 'M' as gender,
                   '2024-01-' || lpad(cast(c_custkey % 30 + 1 as string), 2, '0') || ' 08:00:00' as create_time,
                   {q.tm('o_orderdate')} || lpad(cast(o_orderkey as string), 12, '0') as operate_time
            from {{orders}} join {{customer}} on o_custkey = c_custkey""",
        "ods_order_info": f"""
            select o_orderkey as id, o_custkey as user_id, c_nationkey as province_id,
                   {q.tm('o_orderdate')} as create_time from {{orders}} join {{customer}} on o_custkey = c_custkey""",
        "ods_order_detail": f"""
            select l_orderkey as order_id, l_partkey as sku_id, cast(l_quantity as bigint) as sku_num,
                   {price} as split_original_amount, {price} * {disc} as split_activity_amount,
                   case when l_tax > 0 then {price} * {tax} end as split_coupon_amount,
                   {price} * (1 - {disc}) as split_total_amount from {{lineitem}}""",
        "ods_payment_info": f"""
            select o_orderkey as order_id, case when o_orderstatus = 'P' then '1601' else '1602' end as payment_status,
                   cast(1101 + o_custkey % 3 as string) as payment_type,
                   {q.tm(q.hours('o_orderdate', 'o_custkey % 48'))} as callback_time from {{orders}}""",
        "order_snapshot": f"""
            select o_orderkey as order_id, o_custkey as user_id, c_nationkey as province_id,
                   {q.tm('o_orderdate')} as order_time, {q.dec('o_totalprice')} as total_amount
            from {{orders}} join {{customer}} on o_custkey = c_custkey""",
        "ods_order_status_log": f"""
            select o_orderkey as order_id, '1002' as order_status,
                   {q.tm(q.hours('o_orderdate', 'o_custkey % 48'))} as create_time from {{orders}}
            where o_orderstatus <> 'P'
            union all select o_orderkey, '1004', {q.tm(q.hours('o_orderdate', '48 + o_custkey % 24'))} from {{orders}}
            where o_orderstatus = 'F'
            union all select o_orderkey, '1005', {q.tm(q.hours('o_orderdate', '72'))} from {{orders}}
            where o_orderstatus = 'P' and o_orderpriority = '5-LOW'
            union all select o_orderkey, '1006', {q.tm(q.hours('o_orderdate', '96 + o_custkey % 24'))} from {{orders}}
            where o_orderstatus = 'F' and o_orderpriority <> '1-URGENT'""",
        "ods_favor_info": f"""
            select event_id as id, user_id, {q.k()} as sku_id, {q.tm('ts')} as create_time, {q.ds('ts')} as ds
            from {{events}} where event_type = 'view'""",
        "ods_coupon_use": f"""
            select l_orderkey * 10 + l_linenumber as id, l_partkey as coupon_id, o_custkey as user_id,
                   l_orderkey as order_id, case when l_tax > 0.04 then {q.tm('o_orderdate')} end as used_time
            from {{lineitem}} join {{orders}} on l_orderkey = o_orderkey where l_tax > 0""",
        "ods_cart_info": f"""
            select l_orderkey * 10 + l_linenumber as id, o_custkey as user_id, l_partkey as sku_id, p_name as sku_name,
                   cast(l_quantity as bigint) as sku_num, case when l_linestatus = 'O' then '0' else '1' end as is_ordered
            from {{lineitem}} join {{orders}} on l_orderkey = o_orderkey join {{part}} on l_partkey = p_partkey""",
        "dwd_trade_cart_add_inc": f"""
            select event_id as id, user_id, {q.k()} as sku_id, {q.k()} % 7 + 1 as sku_num, {q.ds('ts')} as ds
            from {{events}} where event_type = 'click'""",
        "dwd_traffic_page_view_inc": f"""
            select 'c' || cast(user_id % 5 as string) as channel, 'b' || cast(user_id % 4 as string) as brand,
                   'm' || cast(user_id % 6 as string) as model, 'os' || cast(user_id % 2 as string) as operate_system,
                   'v' || cast(user_id % 3 as string) as version_code, user_id as mid_id,
                   case event_type when 'view' then 'home' when 'click' then 'good_detail' when 'purchase' then 'payment'
                        else event_type end as page_id,
                   cast(ts as string) as view_time, cast(user_id as string) || '@' || {q.ds('ts')} as session_id,
                   cast({q.dec('value')} * 1000 as bigint) as during_time, {q.ds('ts')} as ds from {{events}}""",
        "dwd_user_login_inc": f"""
            select user_id, {q.tm('ts')} as login_time, {q.ds('ts')} as ds from {{events}}
            where event_type = 'signup'""",
        # daily tables of the funnel, all from the event log
        "funnel_order": f"select distinct user_id, {q.ds('ts')} as ds from {{events}} where event_type = 'purchase'",
        "funnel_pay": f"select distinct user_id, {q.ds('ts')} as ds from {{events}} where event_type = 'signup'",
        # ---- logistics
        "ods_base_region_info": """
            select r_regionkey + 1 as id, 0 as parent_id, r_name as name, 'P' || r_name as dict_code,
                   left(r_name, 2) as short_name, '0' as is_deleted from {region}
            union all select n_nationkey + 100, n_regionkey + 1, 'City ' || cast(n_nationkey as string),
                   'C' || n_name, left(n_name, 2), '0' from {nation}
            union all select distinct 1000 + c_nationkey * 10 + ascii(c_mktsegment) % 10, c_nationkey + 100,
                   'District ' || cast(c_nationkey as string) || c_mktsegment, 'D' || c_mktsegment,
                   left(c_mktsegment, 2), '0' from {customer}""",
        "ods_base_organ": """
            select n_nationkey + 100 as id, 'Center ' || cast(n_nationkey as string) as org_name, 1 as org_level,
                   n_nationkey + 100 as region_id, cast(null as int) as org_parent_id, '0' as is_deleted from {nation}
            union all select distinct 1000 + c_nationkey * 10 + ascii(c_mktsegment) % 10,
                   'Station ' || cast(c_nationkey as string) || c_mktsegment, 2,
                   1000 + c_nationkey * 10 + ascii(c_mktsegment) % 10, c_nationkey + 100, '0' from {customer}""",
        "tms_order_info": f"""
            select o_orderkey as id, 'NO' || cast(o_orderkey as string) as order_no,
                   case when o_orderstatus = 'F' then '60080' when o_orderstatus = 'O' then '60050'
                        when o_orderpriority = '5-LOW' then '60999' else '60020' end as status,
                   cast(1201 + o_custkey % 4 as string) as collect_type, o_custkey as user_id,
                   o_custkey % 50 as receiver_complex_id, 1 + (c_nationkey + 1) % 5 as receiver_province_id,
                   100 + (c_nationkey + 1) % 25 as receiver_city_id,
                   1000 + (c_nationkey + 1) % 25 * 10 + ascii(c_mktsegment) % 10 as receiver_district_id,
                   c_name as receiver_name, o_custkey % 40 as sender_complex_id,
                   1 + c_nationkey % 5 as sender_province_id, 100 + c_nationkey as sender_city_id,
                   1000 + c_nationkey * 10 + ascii(c_mktsegment) % 10 as sender_district_id, c_name as sender_name,
                   case when left(o_orderpriority, 1) < '3' then 'HIGH' else 'LOW' end as payment_type,
                   o_custkey % 9 + 1 as cargo_num, {q.dec('o_totalprice')} as amount,
                   {q.ms(q.hours('o_orderdate', '120'))} as estimate_arrive_time,
                   {q.dec('o_custkey % 1000')} as distance,
                   {q.ds(q.hours('o_orderdate', '24 * cast(left(o_orderpriority, 1) as int)'))} || 'T10:20:30Z'
                     as update_time, {q.ds('o_orderdate')} || 'T08:00:00Z' as create_time
            from {{orders}} join {{customer}} on o_custkey = c_custkey""",
        "tms_order_cargo": f"""
            select l_orderkey * 10 + l_linenumber as id, l_orderkey as order_id, l_returnflag as cargo_type,
                   l_linenumber as volume_length, cast(l_quantity as int) as volume_width,
                   l_linenumber + 1 as volume_height, {q.dec('l_quantity')} as weight,
                   {q.ds('o_orderdate')} || 'T08:00:00Z' as create_time
            from {{lineitem}} join {{orders}} on l_orderkey = o_orderkey""",
        "ods_order_org_bound": f"""
            select l_orderkey * 10 + l_linenumber as id, l_orderkey as order_id,
                   case when l_linestatus = 'O' then 100 + s_nationkey
                        else 1000 + s_nationkey * 10 + (case l_linenumber % 5 when 0 then 5 when 1 then 6 when 2 then 0
                             when 3 then 2 else 7 end) end as org_id,
                   {q.ms('l_shipdate')} as inbound_time,
                   case when l_returnflag <> 'R' then {q.ms(q.hours('l_shipdate', '5'))} end as outbound_time,
                   case when l_quantity >= 5 then {q.ms(q.hours('l_shipdate', '2'))} end as sort_time,
                   {q.ms('l_shipdate')} as create_time, l_suppkey as inbound_emp_id, l_suppkey + 1 as outbound_emp_id,
                   l_suppkey + 2 as sorter_emp_id
            from {{lineitem}} join {{supplier}} on l_suppkey = s_suppkey""",
        "ods_transport_task": f"""
            select l_orderkey * 10 + l_linenumber as id, l_suppkey as shift_id, s_nationkey as line_id,
                   100 + s_nationkey as start_org_id, 'Center ' || cast(s_nationkey as string) as start_org_name,
                   100 + (s_nationkey + 1) % 25 as end_org_id,
                   'Center ' || cast((s_nationkey + 1) % 25 as string) as end_org_name, l_linenumber as order_num,
                   l_suppkey * 2 as driver1_emp_id, s_name as driver1_name,
                   case when l_linestatus = 'O' then l_suppkey * 2 + 1 end as driver2_emp_id,
                   case when l_linestatus = 'O' then 'Co ' || s_name end as driver2_name, l_suppkey as truck_id,
                   'T' || cast(l_suppkey as string) as truck_no, {q.ms('l_shipdate')} as actual_start_time,
                   {q.ms(q.hours('l_shipdate', 'cast(l_quantity as int)'))} as actual_end_time,
                   {q.dec('l_extendedprice')} as actual_distance
            from {{lineitem}} join {{supplier}} on l_suppkey = s_suppkey""",
        "ods_line_base_shift": """
            select s_suppkey as id, s_nationkey as line_id, '08:00' as start_time, s_suppkey * 2 as driver1_emp_id,
                   s_suppkey * 2 + 1 as driver2_emp_id, s_suppkey as truck_id, s_suppkey + 1 as pair_shift_id
            from {supplier}""",
        "ods_line_base_info": f"""
            select n_nationkey as id, 'Line ' || cast(n_nationkey as string) as name,
                   'L' || cast(n_nationkey as string) as line_no, n_nationkey % 2 + 1 as line_level,
                   100 + n_nationkey as org_id, case n_nationkey % 2 when 0 then 'A' else 'N' end
                   as transport_line_type_id, 100 + n_nationkey as start_org_id, n_name as start_org_name,
                   100 + (n_nationkey + 1) % 25 as end_org_id, 'Center' as end_org_name,
                   (n_nationkey + 1) % 25 as pair_line_id, {q.dec('n_nationkey * 10')} as distance,
                   {q.dec('n_nationkey * 3')} as cost, (n_nationkey + 1) * 60 as estimated_time from {{nation}}""",
        "ods_express_courier": """
            select s_suppkey as id, s_suppkey + 500 as emp_id, 100 + s_nationkey as org_id, s_name as working_phone,
                   cast(1201 + s_suppkey % 3 as string) as express_type from {supplier}""",
        "ods_express_courier_complex": """
            select s_suppkey + 500 as courier_emp_id, s_nationkey as complex_id, '0' as is_deleted from {supplier}""",
        "ods_base_complex": """
            select n_nationkey as id, 'Complex ' || n_name as complex_name, n_regionkey + 1 as province_id,
                   n_nationkey + 100 as city_id, n_nationkey * 10 + 1000 as district_id, n_name as district_name,
                   '0' as is_deleted from {nation}""",
        "ods_truck_team": """
            select n_nationkey as id, 'Team ' || n_name as name, 'TN' || cast(n_nationkey as string) as team_no,
                   100 + n_nationkey as org_id, n_nationkey * 7 as manager_emp_id from {nation}""",
        "ods_truck_model": """
            select n_nationkey as id, 'Model ' || n_name as model_name, cast(1201 + n_nationkey % 3 as string)
                   as model_type, 'MN' || cast(n_nationkey as string) as model_no,
                   case n_nationkey % 2 when 0 then '1501' else '1502' end as brand, n_nationkey + 5 as load_weight,
                   n_nationkey + 80 as max_speed from {nation}""",
        "ods_truck_info": """
            select s_suppkey as id, s_nationkey as team_id, 'T' || cast(s_suppkey as string) as truck_no,
                   (s_nationkey + 3) % 25 as truck_model_id, 'GPS' || cast(s_suppkey as string) as device_gps_id,
                   1 as is_enabled from {supplier}""",
        "ods_truck_driver": """
            select s_suppkey as id, s_suppkey * 2 as emp_id, 100 + s_nationkey as org_id, s_nationkey as team_id,
                   'A' || cast(s_suppkey % 3 as string) as license_type, '2000-01-01' as init_license_date,
                   '2030-01-01' as expire_date, 'LN' || cast(s_suppkey as string) as license_no, 1 as is_enabled
            from {supplier}""",
        "tms_user_info": f"""
            select c_custkey as id, c_name as login_name, lower(c_name) as nick_name, 'pw' || c_name as passwd,
                   c_name as real_name, case when c_custkey % 5 = 0 then '99' else '13' end ||
                     lpad(cast(c_custkey as string), 9, '0') as phone_num,
                   case when c_custkey % 7 = 0 then 'broken' else 'u' || cast(c_custkey as string) || '@mail.example'
                   end as email, c_mktsegment as user_level, c_custkey as birthday, 'M' as gender,
                   cast(788918400000 as bigint) + c_custkey * 1000 as create_time from {{customer}}""",
        "tms_user_info_inc": f"""
            select c_custkey as id, c_name as login_name, lower(c_name) as nick_name, 'pw2' || c_name as passwd,
                   c_name as real_name, '13' || lpad(cast(c_custkey as string), 9, '0') as phone_num,
                   'n' || cast(c_custkey as string) || '@mail.example' as email, o_orderpriority as user_level,
                   c_custkey as birthday, 'M' as gender, {q.ds('o_orderdate')} as dt, o_orderkey as seq
            from {{orders}} join {{customer}} on o_custkey = c_custkey""",
        "tms_user_address": f"""
            select c_custkey as id, c_custkey as user_id, '13' || lpad(cast(c_custkey as string), 9, '0') as phone,
                   1 + c_nationkey % 5 as province_id, 100 + c_nationkey as city_id,
                   1000 + c_nationkey * 10 as district_id, c_custkey % 50 as complex_id, c_name as address,
                   c_custkey % 2 as is_default, cast(788918400000 as bigint) + c_custkey * 1000 as create_time
            from {{customer}}""",
        "tms_user_address_inc": f"""
            select c_custkey as id, c_custkey as user_id, case when o_orderkey % 2 = 0 then '13' else '99' end ||
                     lpad(cast(c_custkey as string), 9, '0') as phone,
                   1 + c_nationkey % 5 as province_id, 100 + c_nationkey as city_id,
                   1000 + c_nationkey * 10 as district_id, c_custkey % 50 as complex_id,
                   'moved ' || c_name as address, 1 as is_default, {q.ds('o_orderdate')} as dt, o_orderkey as seq
            from {{orders}} join {{customer}} on o_custkey = c_custkey""",
        # ---- product ranking board
        "ods_product_base": """
            select p_partkey as product_id, p_name as product_name, p_type as product_category, p_brand as brand,
                   p_size as shop_id from {part}""",
        "ods_product_sales_daily": f"""
            select l_partkey as product_id, {q.ds('o_orderdate')} as stat_date,
                   sum(case when l_returnflag = 'R' then -{price} else {price} end) as sales_amount,
                   cast(sum(case when l_returnflag = 'R' then -l_quantity else l_quantity end) as bigint)
                     as sales_quantity, cast(sum(l_linenumber - 1) as bigint) as visitor_count,
                   count(*) as pay_buyer_count, cast(sum(l_linenumber) as bigint) as add_cart_count
            from {{lineitem}} join {{orders}} on l_orderkey = o_orderkey
            group by l_partkey, {q.ds('o_orderdate')}""",
        "ods_traffic_source_daily": f"""
            select l_partkey as product_id, 'source ' || l_returnflag || cast(l_linenumber as string) as source_name,
                   {q.ds('o_orderdate')} as stat_date, cast(l_quantity as int) - 1 as visitor_count,
                   l_linenumber as pay_buyer_count, cast(l_quantity as int) * 2 as click_count,
                   cast(l_quantity as int) * 30 as stay_duration
            from {{lineitem}} join {{orders}} on l_orderkey = o_orderkey""",
        "ods_sku_sales_inventory_daily": f"""
            select l_partkey as sku_id, l_partkey as product_id, 'sku ' || cast(l_partkey as string) as sku_info,
                   {q.ds('o_orderdate')} as stat_date, cast(sum(l_quantity) as bigint) as pay_quantity,
                   sum({price}) as sales_amount, cast(40 - sum(l_quantity) as bigint) as current_stock,
                   cast(sum(l_linenumber) as bigint) as stock_in
            from {{lineitem}} join {{orders}} on l_orderkey = o_orderkey
            group by l_partkey, {q.ds('o_orderdate')}""",
        "ods_search_word_daily": f"""
            select o_orderpriority || ' ' || c_mktsegment as search_word, l_partkey as product_id,
                   {q.ds('o_orderdate')} as stat_date, l_linenumber * 3 as search_count, l_linenumber * 2 as click_count,
                   cast(l_quantity as int) as visitor_count
            from {{lineitem}} join {{orders}} on l_orderkey = o_orderkey join {{customer}} on o_custkey = c_custkey""",
        "ods_price_strength_product": f"""
            select l_partkey as product_id, 'level ' || cast(l_linenumber % 3 as string) as price_strength_level,
                   {price} as coupon_price, 'band ' || l_returnflag as price_band, {q.ds('o_orderdate')} as ds
            from {{lineitem}} join {{orders}} on l_orderkey = o_orderkey""",
        "ods_product_warning_daily": f"""
            select l_partkey as product_id, {q.ds('o_orderdate')} as stat_date, 'refund' as warning_type,
                   'line ' || cast(l_linenumber as string) as warning_reason,
                   'W' || cast(l_linenumber % 2 as string) as warning_level, l_linestatus as handle_status
            from {{lineitem}} join {{orders}} on l_orderkey = o_orderkey where l_returnflag = 'R'""",
        # ---- category board
        "ods_sales_full": f"""
            select l_partkey as item_id, p_name as item_name, p_type as category_id, lower(p_type) as category_name,
                   {price} as pay_amount, cast(l_quantity as bigint) as pay_quantity,
                   cast(length(p_type) * 100000 as bigint) as target_gmv, length(p_type) as last_month_rank,
                   {q.tm('o_orderdate')} as create_time
            from {{lineitem}} join {{orders}} on l_orderkey = o_orderkey join {{part}} on l_partkey = p_partkey""",
        "ods_attribute_info": f"""
            select {q.k()} as item_id, {q.k()} % 10 as category_id, 'cat ' || cast({q.k()} % 10 as string)
                     as category_name, event_type as attr_id, 'v' || cast(user_id % 4 as string) as attr_value,
                   user_id as visitor_id, case when {q.k()} % 3 = 0 then 1 else 0 end as is_pay,
                   {q.tm('ts')} as visit_time from {{events}}""",
        "ods_traffic_detail": f"""
            select {q.k()} % 10 as category_id, 'cat ' || cast({q.k()} % 10 as string) as category_name,
                   event_type as channel, case when user_id % 2 = 0 then 'word' || cast({q.k()} % 12 as string) end
                     as search_word, user_id as visitor_id, case when {q.k()} % 3 = 0 then 1 else 0 end as is_pay,
                   {q.tm('ts')} as visit_time from {{events}}""",
        "ods_user_behavior_full": f"""
            select user_id, {q.k()} % 10 as category_id, 'cat ' || cast({q.k()} % 10 as string) as category_name,
                   case event_type when 'purchase' then 'pay' when 'signup' then 'search' else 'visit' end
                     as behavior_type, {q.tm('ts')} as behavior_time from {{events}}""",
        "ods_user_profile": """
            select c_custkey as user_id, 20 + c_custkey % 4 * 10 as age,
                   case when c_custkey % 2 = 0 then 'F' else 'M' end as gender, c_nationkey as region,
                   c_mktsegment as consumption_level from {customer}""",
        # ---- page board
        "ods_user_behavior": f"""
            select event_id, user_id, {q.tm('ts')} as click_time, {q.page()} as page_type, {q.k()} % 20 as block_id,
                   case {q.k()} % 6 when 0 then '直播间' when 1 then '短视频' when 2 then '图文' when 3 then '微详情'
                        when 4 then '搜索' else '推荐' end as channel,
                   case when {q.k()} % 5 = 0 then 0 else 1 end as is_click, {q.ds('ts')} as ds from {{events}}""",
        "ods_page_structure": f"""
            select distinct {q.page()} as page_type, {q.k()} % 20 as block_id,
                   case when {q.k()} % 20 % 4 = 0 then '商品' else '模块' end || cast({q.k()} % 20 as string)
                     as block_name, 'pos ' || cast({q.k()} % 20 % 3 as string) as block_position, {q.ds('ts')} as ds
            from {{events}}""",
        "ods_trade_data": f"""
            select event_id as trade_id, user_id, {q.dec('value')} as pay_amount, {q.k()} % 20 as guide_block_id,
                   {q.tm('ts')} as pay_time, {q.ds('ts')} as ds from {{events}}
            where event_type in ('purchase', 'signup')""",
        # ---- store board
        "ods_wireless_instore_log": f"""
            select user_id as visitor_id, 'store ' || cast({q.k()} % 7 as string) as store_id,
                   'page ' || cast(user_id % 5 as string) as page_type, {q.tm('ts')} as visit_time,
                   case when {q.k()} % 4 = 0 then 1 else 0 end as is_buy, {q.ds('ts')} as dt
            from {{events}} where event_type in ('view', 'click')""",
        "ods_page_visit_log": f"""
            select user_id as visitor_id, 'store ' || cast({q.k()} % 7 as string) as store_id,
                   'kind ' || cast(user_id % 3 as string) as page_category,
                   'sub ' || cast(user_id % 4 as string) as page_subtype, {q.tm('ts')} as visit_time,
                   cast(floor(value) as int) as stay_time, {q.ds('ts')} as dt
            from {{events}} where event_type = 'purchase'""",
        "ods_instore_flow_log": f"""
            select user_id as visitor_id, 'store ' || cast({q.k()} % 7 as string) as store_id,
                   case when {q.k()} % 11 > 0 then 'from ' || cast(user_id % 6 as string) end as source_page,
                   'to ' || cast({q.k()} % 5 as string) as target_page, {q.tm('ts')} as jump_time, {q.ds('ts')} as dt
            from {{events}} where event_type = 'signup'""",
        "ods_pc_entry_log": f"""
            select user_id as visitor_id, 'store ' || cast({q.k()} % 7 as string) as store_id,
                   'entry ' || cast(user_id % 30 as string) as source_page, {q.tm('ts')} as visit_time,
                   {q.ds('ts')} as dt from {{events}} where event_type = 'error'""",
        "transactions": f"""
            select o_custkey as customer_id, o_orderkey as transaction_id, {q.tm('o_orderdate')} as transaction_date,
                   {q.dec('o_totalprice')} as transaction_amount from {{orders}}""",
        # ---- event and change feeds, one flat table per record type
        "log_events": f"""
            select event_id, event_type as kind, cast(user_id as string) as mid,
                   case when user_id % 5 > 0 then cast(user_id as string) end as uid,
                   'v' || cast(event_id % 3 as string) as vc, 'ch' || cast(event_id % 4 as string) as ch,
                   'ar' || cast(event_id % 6 as string) as ar, cast(user_id % 2 as string) as is_new,
                   case event_type when 'view' then 'home' when 'click' then 'good_detail' when 'purchase' then 'search'
                        else 'cart' end as page_id,
                   case event_type when 'view' then '' when 'click' then 'login' when 'purchase' then 'search'
                        else 'home' end as last_page_id,
                   case event_type when 'purchase' then 'Red widget ' || cast({q.k()} as string)
                        when 'click' then cast({q.k()} as string) end as item,
                   case event_type when 'purchase' then 'keyword' when 'click' then 'sku_id' end as item_type,
                   cast({q.dec('value')} * 1000 as bigint) as during_time, {q.ms('ts')} as ts, {q.k()} as k
            from {{events}}""",
        "chg_order_info": " union all ".join(f"""
            select cast(o_orderkey as string) as id, cast(o_custkey as string) as user_id,
                   cast(c_nationkey as string) as province_id, '{op}' as op, {was} as was, '{status}' as status,
                   {q.t0()} + {lag} as ts_ms
            from {{orders}} join {{customer}} on o_custkey = c_custkey where {state}"""
            for op, was, status, lag, state in (
                ("r", "cast(null as string)", "1001", 0, "true"),
                ("u", "'1001'", "1003", 60000, "o_orderstatus = 'P' and o_orderpriority = '5-LOW'"),
                ("u", "'1002'", "1005", 2000, "o_orderstatus = 'F'"),
                ("u", "'1004'", "1006", 3000, "o_orderstatus = 'O'"))),
        "chg_order_detail": f"""
            select {q.line_id()} as id, cast(l_orderkey as string) as order_id, cast(l_partkey as string) as sku_id,
                   p_name as sku_name, cast({q.t0()} as string) as create_time,
                   cast(cast(l_quantity as int) as string) as sku_num, cast({price} as string) as order_price,
                   cast({price} * {disc} as string) as split_activity_amount,
                   case when l_tax > 0 then cast({price} * {tax} as string) end as split_coupon_amount,
                   cast({price} * (1 - {disc}) as string) as split_total_amount, l_discount, l_tax,
                   {q.t0()} + (l_linenumber - 1) * 1000 as ts_ms
            from {{lineitem}} join {{orders}} on l_orderkey = o_orderkey join {{part}} on l_partkey = p_partkey""",
        "chg_payment_info": f"""
            select cast(o_custkey as string) as user_id, cast(o_orderkey as string) as order_id,
                   cast(1101 + o_custkey % 3 as string) as payment_type,
                   case when o_orderstatus = 'P' then '1601' else '1602' end as payment_status,
                   cast({q.t0()} + o_custkey % 10 * 1000 as string) as callback_time,
                   {q.t0()} + o_custkey % 10 * 1000 as ts_ms from {{orders}}""",
        "chg_refund_info": f"""
            select {q.line_id()} as id, cast(o_custkey as string) as user_id, cast(l_orderkey as string) as order_id,
                   cast(l_partkey as string) as sku_id, cast(1501 + l_linenumber % 2 as string) as refund_type,
                   cast(1501 + l_linenumber % 3 as string) as refund_reason_type, 'text ' || l_linestatus
                     as refund_reason_txt, cast(cast(l_quantity as int) as string) as refund_num,
                   cast({price} as string) as refund_amount, cast({q.t0()} as string) as create_time,
                   {q.t0()} + l_linenumber * 500 as ts_ms
            from {{lineitem}} join {{orders}} on l_orderkey = o_orderkey where l_returnflag = 'R'""",
        "chg_refund_payment": f"""
            select {q.line_id()} as id, cast(l_orderkey as string) as order_id, cast(l_partkey as string) as sku_id,
                   cast(1101 + l_linenumber % 3 as string) as payment_type, cast({q.t0()} + 5000 as string)
                     as callback_time, cast({price} as string) as total_amount,
                   {q.t0()} + 1000 + l_linenumber * 200 as ts_ms
            from {{lineitem}} join {{orders}} on l_orderkey = o_orderkey
            where l_returnflag = 'R' and l_linestatus = 'F'""",
        "chg_comment_info": """
            select cast(conv_id as string) || '-' || cast(turn as string) as id, cast(conv_id as string) as user_id,
                   cast(turn as string) as sku_id, cast(1201 + conv_id % 4 as string) as appraise, text as comment_txt,
                   cast(1700000000000 as bigint) + conv_id * 1000 + turn as ts_ms from {conversations}""",
        "chg_cart_info": f"""
            select cast(event_id as string) as id, cast(user_id as string) as user_id,
                   cast({q.k()} as string) as sku_id, case when {q.k()} % 2 = 0 then 'r' else 'u' end as op,
                   case when {q.k()} % 2 = 1 and {q.k()} % 5 > 0 then cast({q.k()} % 10 as string) end as was,
                   cast({q.k()} % 7 + 1 as string) as sku_num, {q.ms('ts')} as ts_ms
            from {{events}} where event_type = 'click'""",
        "dwd_detail_versions": " union all ".join(f"""
            select d.id, d.order_id, cast(o_custkey as string) as user_id, d.sku_id, d.sku_name,
                   cast(o_custkey % 25 as string) as province_id, d.order_price as split_original_amount,
                   {activity} as split_activity_amount, d.split_coupon_amount, d.split_total_amount,
                   d.ts_ms + {lag} as ts
            from ({{d}}) d join {{orders}} on d.order_id = cast(o_orderkey as string) where {cond}"""
            for activity, lag, cond in (("cast(null as string)", 0, "true"),
                                        ("d.split_activity_amount", 3000, "d.l_discount > 0.05"),
                                        # just inside and just beyond a lifetime of ten seconds
                                        ("d.split_activity_amount", 12900, "d.l_discount > 0.05 and d.l_tax > 0.05"),
                                        ("cast(null as string)", 13100, "d.l_discount > 0.05 and d.l_tax < 0.02"),
                                        ("d.split_activity_amount", 10000, "d.l_discount < 0.02"))),
    }
    out["dwd_detail_versions"] = out["dwd_detail_versions"].replace("{d}", out["chg_order_detail"])
    if q.spark:
        def version(holds: str, reduced: str, lag: int) -> str:
            return f"named_struct('holds', {holds}, 'reduced', {reduced}, 'lag', {lag})"

        # the same rows from one pass: the lines are joined once, and every line gives its versions
        lines = out["chg_order_detail"].replace("select ", "select cast(v_custkey as string) as user_id, cast(v_custkey % 25 as string) as province_id, ", 1)
        lines = lines.replace(" join {part} ", " join (select o_orderkey as v_orderkey, o_custkey as v_custkey from {orders}) on l_orderkey = v_orderkey join {part} ")
        out["dwd_detail_versions"] = f"""
            select id, order_id, user_id, sku_id, sku_name, province_id, order_price as split_original_amount,
                   if(v.reduced, split_activity_amount, null) as split_activity_amount, split_coupon_amount,
                   split_total_amount, ts_ms + v.lag as ts
            from ({lines}) lateral view explode(filter(array(
                {version('true', 'false', 0)}, {version('l_discount > 0.05', 'true', 3000)},
                {version('l_discount > 0.05 and l_tax > 0.05', 'true', 12900)},
                {version('l_discount > 0.05 and l_tax < 0.02', 'false', 13100)},
                {version('l_discount < 0.02', 'true', 10000)}), x -> x.holds)) as v"""
    return out
