"""Logistics queries: jobs over the derived inputs, and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry.core import REG
from tidemill.plans import logistics_daily as daily
from tidemill.plans import logistics_dims as dims
from tidemill.plans import logistics_reports as reports

T = REG.tables
DIC = "(select dic_code, dic_name from ods_base_dic)"

# ---------------------------------------------------------------- dimensions
T["dim_organ_full"] = """
select o.id, o.org_name, o.org_level, o.region_id, r.name as region_name, r.dict_code as region_code, o.org_parent_id,
  p.org_name as org_parent_name from ods_base_organ o left join ods_base_region_info r on o.region_id = r.id
left join ods_base_organ p on o.org_parent_id = p.id"""
T["dim_region_full"] = "select id, parent_id, name, dict_code, short_name from ods_base_region_info"
T["dim_shift_full"] = f"""
select s.*, l.name as line_name, line_no, line_level, org_id, transport_line_type_id,
  dic_name as transport_line_type_name, start_org_id, start_org_name, end_org_id, end_org_name, pair_line_id, distance,
  cost, estimated_time from ods_line_base_shift s join ods_line_base_info l on s.line_id = l.id
join {DIC} on transport_line_type_id = dic_code"""
T["dim_truck_full"] = f"""
select k.* replace (md5(truck_no) as truck_no), m.name as team_name, team_no, m.org_id, manager_emp_id,
  model_name as truck_model_name, model_type as truck_model_type, model_no as truck_model_no, brand as truck_brand,
  load_weight, max_speed, org_name, a.dic_name as truck_model_type_name, b.dic_name as truck_brand_name
from ods_truck_info k join ods_truck_team m on team_id = m.id join ods_truck_model x on truck_model_id = x.id
join ods_base_organ o on m.org_id = o.id join {DIC} a on model_type = a.dic_code join {DIC} b on brand = b.dic_code"""
REG.job("TD1_dim_express_courier_full", dims.dim_express_courier_full, "order", f"""
select c.* replace (md5(working_phone) as working_phone), org_name, dic_name as express_type_name
from ods_express_courier c join ods_base_organ o on c.org_id = o.id join {DIC} on express_type = dic_code""")
REG.job("TD2_dim_organ_full", dims.dim_organ_full, "order", "select * from dim_organ_full")
REG.job("TD3_dim_region_full", dims.dim_region_full, "order", "select * from dim_region_full")
REG.job("TD4_dim_shift_full", dims.dim_shift_full, "order",
        "select * replace (cast(distance as double) as distance, cast(cost as double) as cost) from dim_shift_full")
REG.job("TD5_dim_truck_driver_full", dims.dim_truck_driver_full, "order", """
select d.*, org_name, t.name as team_name from ods_truck_driver d join ods_base_organ o on d.org_id = o.id
join ods_truck_team t on d.team_id = t.id""")
REG.job("TD6_dim_truck_full", dims.dim_truck_full, "order", "select * from dim_truck_full")
PRIVATE = """id, login_name, nick_name, md5(passwd) as passwd, md5(real_name) as real_name,
  md5(case when regexp_matches(phone_num, '^(13[0-9]|14[01456879]|15[0-35-9]|16[2567]|17[0-8]|18[0-9]|19[0-35-9])[0-9]{8}$')
    then phone_num end) as phone_num,
  md5(case when regexp_matches(email, '^[a-zA-Z0-9_-]+@[a-zA-Z0-9_-]+([.][a-zA-Z0-9_-]+)+$') then email end) as email,
  user_level, strftime(date '1970-01-01' + cast(birthday as int), '%Y-%m-%d') as birthday, gender"""
BORN = "strftime(make_timestamp_ms(create_time), '%Y-%m-%d') as start_date, '9999-12-31' as end_date"
T["dim_tms_user_zip"] = f"select {PRIVATE}, {BORN} from tms_user_info"
HASHED = """md5(case when regexp_matches(phone, '^(13[0-9]|14[01456879]|15[0-35-9]|16[2567]|17[0-8]|18[0-9]|19[0-35-9])[0-9]{8}$')
  then phone end)"""
ADDR = ", ".join(c if c != "phone" else HASHED + " as phone" for c in dims.ADDRESS)
T["dim_user_address_zip"] = f"select {ADDR}, {BORN} from tms_user_address"


def zipped(zip_table: str, inc: str, cols: str) -> str:
    """The row_number form: open rows and today's rows, newest stays open, the one before closes yesterday."""
    return f"""
with inc as (select * from (select *, row_number() over (partition by id order by dt desc, seq desc) as rn from {inc}
             where dt = {{O.d}}) where rn = 1),
every as (select * from {zip_table}
          union all select {cols}, {{O.d}} as start_date, '9999-12-31' as end_date from inc)
select * exclude (rk) replace (case when rk = 1 then end_date else {{O.y}} end as end_date)
from (select *, row_number() over (partition by id order by start_date desc) as rk from every)"""


REG.job("TD7_dim_user_zip_init", dims.dim_tms_user_zip, "order", "select * from dim_tms_user_zip")
REG.job("TD7_dim_user_zip_daily", dims.dim_tms_user_zip_daily, "order",
        zipped("dim_tms_user_zip", "tms_user_info_inc", PRIVATE))
REG.job("TD7_dim_user_address_zip_init", dims.dim_user_address_zip, "order", "select * from dim_user_address_zip")
REG.job("TD7_dim_user_address_zip_daily", dims.dim_user_address_zip_daily, "order",
        zipped("dim_user_address_zip", "tms_user_address_inc", ADDR))
REG.job("TD8_dim_complex_full", dims.dim_complex_full, "order", """
select c.* exclude (is_deleted), p.name as province_name, y.name as city_name, ids as courier_emp_ids
from ods_base_complex c join ods_base_region_info p on c.province_id = p.id
join ods_base_region_info y on c.city_id = y.id
left join (select complex_id, string_agg(distinct cast(courier_emp_id as string), ','
  order by cast(courier_emp_id as string)) as ids from ods_express_courier_complex group by 1) k on c.id = k.complex_id""",
        final=lambda df: df.withColumn("courier_emp_ids", F.array_join("courier_emp_ids", ",")))


# ---------------------------------------------------------------- facts
def text_time(ms: str, f: str = "%Y-%m-%d %H:%M:%S") -> str:
    return f"strftime(make_timestamp_ms({ms}), '{f}')"


for name, time, emp in (("inbound", "inbound_time", "inbound_emp_id"), ("outbound", "outbound_time", "outbound_emp_id"),
                        ("sort", "sort_time", "sorter_emp_id")):
    T[f"dwd_bound_{name}"] = f"""
select id, order_id, org_id, {text_time(time)} as {time}, {emp}, {text_time(time, '%Y-%m-%d')} as dt
from ods_order_org_bound where {time} is not null"""
    REG.job(f"TW1_dwd_bound_{name}", getattr(dims, f"dwd_bound_{name}"), "order", f"select * from dwd_bound_{name}")


def lifecycle(time: str, source: str, where: str) -> str:
    sliced = f"left({source}, 10) || ' ' || substr({source}, 12, 8)"
    return f"""
select c.id, c.order_id, cargo_type, g.dic_name as cargo_type_name, volume_length, volume_width, volume_height, weight,
  {sliced} as {time}, order_no, status, s.dic_name as status_name, collect_type, l.dic_name as collect_type_name, user_id,
  receiver_complex_id, receiver_province_id, receiver_city_id, receiver_district_id,
  left(receiver_name, 1) || '*' as receiver_name, sender_complex_id, sender_province_id, sender_city_id,
  sender_district_id, left(sender_name, 1) || '*' as sender_name, payment_type, p.dic_name as payment_type_name,
  cargo_num, amount, {text_time('estimate_arrive_time')} as estimate_arrive_time, distance, left({source}, 10) as dt
from tms_order_cargo c join tms_order_info i on c.order_id = i.id
left join {DIC} g on cargo_type = g.dic_code left join {DIC} s on status = s.dic_code
left join {DIC} l on collect_type = l.dic_code left join {DIC} p on payment_type = p.dic_code where {where}"""


MONEY = "cast(weight as double) as weight, cast(amount as double) as amount, cast(distance as double) as distance"
FACTS = {
    "dwd_trade_order_detail": ("order_time", "c.create_time", "true"),
    "dwd_trade_order_cancel_detail": ("cancel_time", "update_time", "status = '60999'"),
    "dwd_trade_pay_suc_detail": ("payment_time", "update_time", "status <> '60999'"),
    "dwd_trans_receive_detail": ("receive_time", "update_time", "status in ('60020', '60050', '60080')"),
    "dwd_trans_dispatch_detail": ("dispatch_time", "update_time", "status in ('60050', '60080')"),
    "dwd_trans_bound_finish_detail": ("bound_finish_time", "update_time", "status = '60080'"),
    "dwd_trans_deliver_suc_detail": ("deliver_suc_time", "update_time", "status = '60080'"),
    "dwd_trans_sign_detail": ("sign_time", "update_time", "status = '60080'"),
}
for name, (time, source, where) in FACTS.items():
    T[name] = lifecycle(time, source, where)
    REG.job(f"TW2_{name}", getattr(dims, name), "order", f"select * replace ({MONEY}) from {name}")
T["order_process"] = f"""
select p.* exclude (dt) replace ({MONEY}), dt as start_date, e as end_date, e as dt from dwd_trade_order_detail p join
(select id as oid, case when status in ('60080', '60999') then left(update_time, 10) else '9999-12-31' end as e
 from tms_order_info) on order_id = oid"""
REG.job("TW3_dwd_trade_order_process", dims.dwd_trade_order_process, "order", "select * from order_process")
T["dwd_trans_trans_finish"] = f"""
select k.id, shift_id, k.line_id, k.start_org_id, k.start_org_name, k.end_org_id, k.end_org_name, order_num,
  k.driver1_emp_id, left(driver1_name, 1) || '*' as driver1_name, k.driver2_emp_id,
  left(driver2_name, 1) || '*' as driver2_name, k.truck_id, md5(truck_no) as truck_no,
  {text_time('actual_start_time')} as actual_start_time, {text_time('actual_end_time')} as actual_end_time,
  {text_time('actual_start_time + estimated_time * 60000')} as estimate_end_time, actual_distance,
  cast((actual_end_time - actual_start_time) // 1000 as bigint) as finish_dur_sec,
  {text_time('actual_end_time', '%Y-%m-%d')} as dt
from ods_transport_task k left join dim_shift_full f on shift_id = f.id"""
REG.job("TW4_dwd_trans_trans_finish", dims.dwd_trans_trans_finish, "order",
        "select * replace (cast(actual_distance as double) as actual_distance) from dwd_trans_trans_finish")

# ---------------------------------------------------------------- daily
T["dws_trade_org_cargo_type_order_1d"] = """
select g.*, r.name as city_name from (
  select o.id as org_id, o.org_name, sender_city_id as city_id, cargo_type, cargo_type_name, count(order_id)
    as order_count, sum(amount) as order_amount, dt from (
    select order_id, cargo_type, cargo_type_name, sender_district_id, sender_city_id, max(amount) as amount, dt
    from dwd_trade_order_detail group by all) x left join dim_organ_full o on sender_district_id = o.region_id
  group by all) g left join dim_region_full r on city_id = r.id"""
T["dws_trans_dispatch_1d"] = """
select count(order_id) as order_count, sum(m) as order_amount, dt from (
  select order_id, dt, max(amount) as m from dwd_trans_dispatch_detail group by all) group by dt"""
PLACED = """o.id as org_id, o.org_name, c.id as city_id, c.name as city_name, p.id as province_id,
  p.name as province_name"""
PLACE_JOINS = """left join dim_organ_full o on {0} = o.region_id left join dim_region_full x on o.region_id = x.id
  left join dim_region_full c on x.parent_id = c.id left join dim_region_full p on c.parent_id = p.id"""
T["dws_trans_org_deliver_suc_1d"] = f"""
select {PLACED}, count(order_id) as order_count, dt from (
  select order_id, receiver_district_id, dt from dwd_trans_deliver_suc_detail group by all) e
  {PLACE_JOINS.format('receiver_district_id')} group by all"""
T["dws_trans_org_receive_1d"] = f"""
select {PLACED}, count(order_id) as order_count, sum(amount) as order_amount, dt from (
  select order_id, sender_district_id, max(amount) as amount, dt from dwd_trans_receive_detail group by all) e
  {PLACE_JOINS.format('sender_district_id')} group by all"""
T["dws_trans_org_sort_1d"] = """
select org_id, org_name, if(org_level = 1, a.id, b.id) as city_id, if(org_level = 1, a.name, b.name) as city_name,
  if(org_level = 1, b.id, c.id) as province_id, if(org_level = 1, b.name, c.name) as province_name, sort_count, dt
from (select org_id, count(*) as sort_count, dt from dwd_bound_sort group by all) s
left join dim_organ_full o on org_id = o.id left join dim_region_full a on region_id = a.id
left join dim_region_full b on a.parent_id = b.id left join dim_region_full c on b.parent_id = c.id"""
T["dws_trans_org_truck_model_type_trans_finish_1d"] = """
select start_org_id as org_id, start_org_name as org_name, truck_model_type, truck_model_type_name,
  count(f.id) as trans_finish_count, sum(actual_distance) as trans_finish_distance,
  sum(finish_dur_sec) as trans_finish_dur_sec, dt
from dwd_trans_trans_finish f left join dim_truck_full k on f.truck_id = k.id group by all"""
D = "cast({0} as double) as {0}"
I = "cast({0} as bigint) as {0}"
OC = [I.format("order_count")]
OA = [*OC, D.format("order_amount")]
TRIP = [I.format("trans_finish_count"), D.format("trans_finish_distance"), I.format("trans_finish_dur_sec")]
SORT = [I.format("sort_count")]


def show(table: str, casts: list[str]) -> str:
    return f"select * replace ({', '.join(casts)}) from {table}"


for key, name, casts in (
        ("TS1", "dws_trade_org_cargo_type_order_1d", OA), ("TS2", "dws_trans_dispatch_1d", OA),
        ("TS3", "dws_trans_org_deliver_suc_1d", OC), ("TS4", "dws_trans_org_receive_1d", OA),
        ("TS5", "dws_trans_org_sort_1d", SORT), ("TS6", "dws_trans_org_truck_model_type_trans_finish_1d", TRIP)):
    REG.job(f"{key}_{name}", getattr(daily, name), "order", show(name, casts))


def many(table: str, keys: str, sums: list[str]) -> str:
    k = f"{keys}, " if keys else ""
    cols = ", ".join(f"sum({s}) as {s}" for s in sums)
    return f"""
select {k}recent_days, {cols} from {table} join (values (7, {{O.d7}}), (30, {{O.d30}})) h(recent_days, lo)
on dt between lo and {{O.d}} group by all"""


PLACE = ", ".join(daily.PLACE)
T["dws_trade_org_cargo_type_order_nd"] = many("dws_trade_org_cargo_type_order_1d",
                                              "org_id, org_name, city_id, city_name, cargo_type, cargo_type_name",
                                              ["order_count", "order_amount"])
T["dws_trans_dispatch_nd"] = many("dws_trans_dispatch_1d", "", ["order_count", "order_amount"])
T["dws_trans_org_deliver_suc_nd"] = many("dws_trans_org_deliver_suc_1d", PLACE, ["order_count"])
T["dws_trans_org_receive_nd"] = many("dws_trans_org_receive_1d", PLACE, ["order_count", "order_amount"])
T["dws_trans_org_sort_nd"] = many("dws_trans_org_sort_1d", PLACE, ["sort_count"])
for name, casts in (("dws_trade_org_cargo_type_order_nd", OA), ("dws_trans_dispatch_nd", OA),
                    ("dws_trans_org_deliver_suc_nd", OC), ("dws_trans_org_receive_nd", OA),
                    ("dws_trans_org_sort_nd", SORT)):
    REG.job(f"TN1_{name}", getattr(daily, name), "order", show(name, casts))
T["dws_trans_shift_trans_finish_nd"] = """
select shift_id, if(org_level = 1, a.id, b.id) as city_id, if(org_level = 1, a.name, b.name) as city_name,
  g.org_id, g.org_name, g.line_id, line_name, g.driver1_emp_id, driver1_name, g.driver2_emp_id, driver2_name,
  truck_model_type, truck_model_type_name, recent_days, trans_finish_count, trans_finish_distance, trans_finish_dur_sec,
  trans_finish_order_count, trans_finish_delay_count from (
  select recent_days, shift_id, line_id, truck_id, start_org_id as org_id, start_org_name as org_name, driver1_emp_id,
    driver1_name, driver2_emp_id, driver2_name, count(id) as trans_finish_count,
    sum(actual_distance) as trans_finish_distance, sum(finish_dur_sec) as trans_finish_dur_sec,
    sum(order_num) as trans_finish_order_count,
    sum(if(actual_end_time > estimate_end_time, 1, 0)) as trans_finish_delay_count
  from dwd_trans_trans_finish join (values (7, {O.d7}), (30, {O.d30})) h(recent_days, lo)
  on dt between lo and {O.d} group by all) g
left join dim_organ_full o on g.org_id = o.id left join dim_region_full a on o.region_id = a.id
left join dim_region_full b on a.parent_id = b.id left join dim_shift_full f on shift_id = f.id
left join dim_truck_full k on g.truck_id = k.id"""
SHIFT = [*TRIP, I.format("trans_finish_order_count"), I.format("trans_finish_delay_count")]
REG.job("TN2_dws_trans_shift_trans_finish_nd", daily.dws_trans_shift_trans_finish_nd, "order",
        show("dws_trans_shift_trans_finish_nd", SHIFT))
T["dws_trans_bound_finish_td"] = """
select count(order_id) as order_count, sum(m) as order_amount from (
  select order_id, max(amount) as m from dwd_trans_bound_finish_detail where dt <= {O.d} group by 1)"""
T["dws_trans_dispatch_td"] = """
select sum(order_count) as order_count, sum(order_amount) as order_amount from dws_trans_dispatch_1d where dt <= {O.d}"""
REG.job("TN3_dws_trans_bound_finish_td", daily.dws_trans_bound_finish_td, "order",
        show("dws_trans_bound_finish_td", OA))
REG.job("TN3_dws_trans_dispatch_td", daily.dws_trans_dispatch_td, "order", show("dws_trans_dispatch_td", OA))


# ---------------------------------------------------------------- reports
def both(stem: str, keys: str, sums: dict[str, str]) -> str:
    """Day rows and n-day rows summed per key."""
    k = f", {keys}" if keys else ""
    cols = ", ".join(f"sum({c}) as {o}" for o, c in sums.items())
    inner = ", ".join(sums.values())
    return f"""(select recent_days{k}, {cols} from (
  select 1 as recent_days{k}, {inner} from {stem}_1d where dt = {{O.d}}
  union all select recent_days{k}, {inner} from {stem}_nd) group by all)"""


ORD = {"order_count": "order_count", "order_amount": "order_amount"}
TRIPS = "trans_finish_count, trans_finish_distance, trans_finish_dur_sec"
TRIP_SUM = ", ".join(f"sum({c.strip()}) as {c.strip()}" for c in TRIPS.split(","))
AVG = """cast(trans_finish_distance as double) / trans_finish_count as avg_trans_finish_distance,
  cast(trans_finish_dur_sec as double) / trans_finish_count as avg_trans_finish_dur_sec"""
T["org_trips_1d"] = f"""
select if(org_level = 1, a.id, b.id) as city_id, if(org_level = 1, a.name, b.name) as city_name, x.*
from dws_trans_org_truck_model_type_trans_finish_1d x left join dim_organ_full o on x.org_id = o.id
left join dim_region_full a on o.region_id = a.id left join dim_region_full b on a.parent_id = b.id"""


def trips(keys: str) -> str:
    k = f", {keys}" if keys else ""
    return f"""(select recent_days{k}, {TRIP_SUM} from (
  select 1 as recent_days{k}, {TRIPS} from org_trips_1d where dt = {{O.d}}
  union all select recent_days{k}, {TRIPS} from dws_trans_shift_trans_finish_nd) group by all)"""


def orders_and_trips(i: str, n: str) -> str:
    return f"""
select {{O.d}} as dt, coalesce(o.recent_days, p.recent_days) as recent_days, coalesce(o.{i}, p.{i}) as {i},
  coalesce(o.{n}, p.{n}) as {n}, {', '.join(OA)}, {', '.join(TRIP)}, {AVG}
from {both('dws_trade_org_cargo_type_order', f'{i}, {n}', ORD)} o full join {trips(f'{i}, {n}')} p
on o.recent_days = p.recent_days and o.{i} is not distinct from p.{i} and o.{n} is not distinct from p.{n}"""


REG.job("TA1_ads_city_stats", reports.ads_city_stats, "order", orders_and_trips("city_id", "city_name"))
REG.job("TA1_ads_org_stats", reports.ads_org_stats, "order", orders_and_trips("org_id", "org_name"))
REG.job("TA2_ads_driver_stats", reports.ads_driver_stats, "order", f"""
select {{O.d}} as dt, recent_days, driver_emp_id, driver_name, {I.format('trans_finish_count')},
  {D.format('trans_finish_distance')}, {D.format('trans_finish_dur_sec')}, {AVG},
  cast(late as bigint) as trans_finish_late_count from (
  select recent_days, driver_emp_id, driver_name, sum(trans_finish_count) as trans_finish_count,
    sum(trans_finish_distance * share) as trans_finish_distance,
    sum(trans_finish_dur_sec * share) as trans_finish_dur_sec, sum(trans_finish_delay_count) as late from (
    select *, driver1_emp_id as driver_emp_id, driver1_name as driver_name,
      if(driver2_emp_id is null, 1.0, 0.5) as share from dws_trans_shift_trans_finish_nd
    union all select *, driver2_emp_id, driver2_name, 0.5 from dws_trans_shift_trans_finish_nd
    where driver2_emp_id is not null) group by all)""")


def express(i: str, n: str) -> str:
    k = f"{i}, {n}"
    return f"""
select {{O.d}} as dt, recent_days, {k}, cast(max(dlv) as bigint) as deliver_suc_count,
  cast(max(srt) as bigint) as sort_count, cast(max(rcv) as bigint) as receive_order_count,
  cast(max(amt) as double) as receive_order_amount from (
  select recent_days, {k}, v as dlv, null as srt, null as rcv, null as amt from
    {both('dws_trans_org_deliver_suc', k, {'v': 'order_count'})}
  union all select recent_days, {k}, null, v, null, null from {both('dws_trans_org_sort', k, {'v': 'sort_count'})}
  union all select recent_days, {k}, null, null, order_count, order_amount from
    {both('dws_trans_org_receive', k, ORD)}) group by all"""


REG.job("TA3_ads_express_city_stats", reports.ads_express_city_stats, "order", express("city_id", "city_name"))
REG.job("TA3_ads_express_org_stats", reports.ads_express_org_stats, "order", express("org_id", "org_name"))
REG.job("TA3_ads_express_province_stats", reports.ads_express_province_stats, "order",
        express("province_id", "province_name"))
REG.job("TA4_ads_express_stats", reports.ads_express_stats, "order", f"""
select {{O.d}} as dt, coalesce(a.recent_days, b.recent_days) as recent_days, cast(a.v as bigint) as deliver_suc_count,
  cast(b.v as bigint) as sort_count from {both('dws_trans_org_deliver_suc', '', {'v': 'order_count'})} a
full join {both('dws_trans_org_sort', '', {'v': 'sort_count'})} b on a.recent_days = b.recent_days""")
REG.job("TA5_ads_line_stats", reports.ads_line_stats, "order", f"""
select {{O.d}} as dt, recent_days, line_id, line_name, cast(sum(trans_finish_count) as bigint) as trans_finish_count,
  cast(sum(trans_finish_distance) as double) as trans_finish_distance,
  cast(sum(trans_finish_dur_sec) as bigint) as trans_finish_dur_sec,
  cast(sum(trans_finish_order_count) as bigint) as trans_finish_order_count
from dws_trans_shift_trans_finish_nd group by all""")
REG.job("TA5_ads_shift_stats", reports.ads_shift_stats, "order", f"""
select {{O.d}} as dt, recent_days, shift_id, {', '.join(TRIP)}, {I.format('trans_finish_order_count')}
from dws_trans_shift_trans_finish_nd""")
REG.job("TA6_ads_order_stats", reports.ads_order_stats, "order", f"""
select {{O.d}} as dt, recent_days, {', '.join(OA)} from {both('dws_trade_org_cargo_type_order', '', ORD)}""")
REG.job("TA6_ads_order_cargo_type_stats", reports.ads_order_cargo_type_stats, "order", f"""
select {{O.d}} as dt, recent_days, cargo_type, cargo_type_name, {', '.join(OA)}
from {both('dws_trade_org_cargo_type_order', 'cargo_type, cargo_type_name', ORD)}""")
REG.job("TA7_ads_trans_order_stats", reports.ads_trans_order_stats, "order", f"""
select {{O.d}} as dt, coalesce(a.recent_days, b.recent_days) as recent_days,
  cast(a.order_count as bigint) as receive_order_count, cast(a.order_amount as double) as receive_order_amount,
  cast(b.order_count as bigint) as dispatch_order_count, cast(b.order_amount as double) as dispatch_order_amount
from {both('dws_trans_org_receive', '', ORD)} a full join {both('dws_trans_dispatch', '', ORD)} b
on a.recent_days = b.recent_days""")
REG.job("TA8_ads_trans_order_stats_td", reports.ads_trans_order_stats_td, "order", """
select {O.d} as dt, cast(a.order_count - b.order_count as bigint) as bounding_order_count,
  cast(a.order_amount - b.order_amount as double) as bounding_order_amount
from dws_trans_dispatch_td a, dws_trans_bound_finish_td b""")
REG.job("TA9_ads_trans_stats", reports.ads_trans_stats, "order",
        f"select {{O.d}} as dt, recent_days, {', '.join(TRIP)} from {trips('')}")
REG.job("TA9_ads_truck_stats", reports.ads_truck_stats, "order", f"""
select {{O.d}} as dt, recent_days, truck_model_type, truck_model_type_name, {', '.join(TRIP)}, {AVG} from (
  select recent_days, truck_model_type, truck_model_type_name, {TRIP_SUM}
  from dws_trans_shift_trans_finish_nd group by all)""")
