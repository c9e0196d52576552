"""Logistics dimensions and facts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.functions import masks
from tidemill.functions.dates import OPEN_DATE, epoch_days_to_ds, iso_to_text, ms_to_ds, ms_to_text
from tidemill.operators.dims import codes_to_names, lookup
from tidemill.operators.scd2 import scd2_init, scd2_merge

# Order states that end an order, and those each milestone requires.
SIGNED, CANCELLED = "60080", "60999"


def dim_express_courier_full(t, d) -> DataFrame:
    """Couriers with organisation and type; the phone is hashed (T-D1)."""
    rows = t["ods_express_courier"].withColumn("working_phone", F.md5("working_phone"))
    rows = lookup(rows, t["ods_base_organ"], "org_id", "id", {"org_name": "org_name"}, "inner")
    return codes_to_names(rows, t["ods_base_dic"], {"express_type": ("express_type_name", None)}, "inner")


def dim_organ_full(t, d) -> DataFrame:
    """Organisations with region and parent organisation (T-D2)."""
    organ = t["ods_base_organ"].where(F.col("is_deleted") == "0").drop("is_deleted")
    region = t["ods_base_region_info"].where(F.col("is_deleted") == "0")
    rows = lookup(organ, region, "region_id", "id", {"region_name": "name", "region_code": "dict_code"})
    return lookup(rows, organ, "org_parent_id", "id", {"org_parent_name": "org_name"})


def dim_region_full(t, d) -> DataFrame:
    """The region tree (T-D3)."""
    return t["ods_base_region_info"].where(F.col("is_deleted") == "0").select(
        "id", "parent_id", "name", "dict_code", "short_name")


def dim_shift_full(t, d) -> DataFrame:
    """Shifts with their line and line type (T-D4)."""
    line = {c: c for c in ("line_no", "line_level", "org_id", "transport_line_type_id", "start_org_id",
                           "start_org_name", "end_org_id", "end_org_name", "pair_line_id", "distance", "cost",
                           "estimated_time")} | {"line_name": "name"}
    rows = lookup(t["ods_line_base_shift"], t["ods_line_base_info"], "line_id", "id", line, "inner")
    return codes_to_names(rows, t["ods_base_dic"], {"transport_line_type_id": ("transport_line_type_name", None)},
                          "inner")


def dim_truck_driver_full(t, d) -> DataFrame:
    """Drivers with organisation and team (T-D5)."""
    rows = lookup(t["ods_truck_driver"], t["ods_base_organ"], "org_id", "id", {"org_name": "org_name"}, "inner")
    return lookup(rows, t["ods_truck_team"], "team_id", "id", {"team_name": "name"}, "inner")


def dim_truck_full(t, d) -> DataFrame:
    """Trucks with team, model, organisation and the type and brand names (T-D6)."""
    rows = t["ods_truck_info"].withColumn("truck_no", F.md5("truck_no"))
    rows = lookup(rows, t["ods_truck_team"], "team_id", "id", {
        "team_name": "name", "team_no": "team_no", "org_id": "org_id", "manager_emp_id": "manager_emp_id"}, "inner")
    rows = lookup(rows, t["ods_truck_model"], "truck_model_id", "id", {
        "truck_model_name": "model_name", "truck_model_type": "model_type", "truck_model_no": "model_no",
        "truck_brand": "brand", "load_weight": "load_weight", "max_speed": "max_speed"}, "inner")
    rows = lookup(rows, t["ods_base_organ"], "org_id", "id", {"org_name": "org_name"}, "inner")
    return codes_to_names(rows, t["ods_base_dic"], {"truck_model_type": ("truck_model_type_name", None),
                                                    "truck_brand": ("truck_brand_name", None)}, "inner")


def dim_complex_full(t, d) -> DataFrame:
    """Residential complexes with province and city names and their couriers (T-D8)."""
    rows = t["ods_base_complex"].where(F.col("is_deleted") == "0").drop("is_deleted")
    region = t["ods_base_region_info"].where(F.col("is_deleted") == "0")
    rows = lookup(rows, region, "province_id", "id", {"province_name": "name"}, "inner")
    rows = lookup(rows, region, "city_id", "id", {"city_name": "name"}, "inner")
    staff = t["ods_express_courier_complex"].where(F.col("is_deleted") == "0").select(
        F.col("complex_id").alias("_c"), F.col("courier_emp_id").cast("string").alias("e")).distinct()
    couriers = staff.groupBy("_c").agg(F.sort_array(F.collect_set("e")).alias("courier_emp_ids"))
    return rows.join(couriers, F.col("id") == F.col("_c"), "left").drop("_c")


def _private(rows: DataFrame) -> list[Column]:
    return ["id", "login_name", "nick_name", F.md5("passwd").alias("passwd"), F.md5("real_name").alias("real_name"),
            masks.hashed_phone(F.col("phone_num")).alias("phone_num"),
            masks.hashed_email(F.col("email")).alias("email"), "user_level",
            epoch_days_to_ds(F.col("birthday")).alias("birthday"), "gender"]


def dim_tms_user_zip(t, d) -> DataFrame:
    """Hashed users, all open, valid from their registration (T-D7)."""
    rows = t["tms_user_info"]
    return scd2_init(rows.select(*_private(rows), ms_to_ds(F.col("create_time")).alias("_s")), F.col("_s")).drop("_s")


def dim_tms_user_zip_daily(t, d) -> DataFrame:
    """One day's user changes: replaced versions close the day before (T-D7)."""
    opened = t["dim_tms_user_zip"].where(F.col("end_date") == OPEN_DATE)
    rows = t["tms_user_info_inc"].where(F.col("dt") == d)
    return scd2_merge(opened, rows.select(*_private(rows), "dt", "seq"), d, "id", ["dt", "seq"], close_offset=1)


ADDRESS = ["id", "user_id", "phone", "province_id", "city_id", "district_id", "complex_id", "address", "is_default"]


def dim_user_address_zip(t, d) -> DataFrame:
    """Addresses, all open; an invalid phone becomes null before it is hashed (T-D7)."""
    rows = t["tms_user_address"].withColumn("phone", masks.hashed_phone(F.col("phone")))
    return scd2_init(rows.select(*ADDRESS, ms_to_ds(F.col("create_time")).alias("_s")), F.col("_s")).drop("_s")


def dim_user_address_zip_daily(t, d) -> DataFrame:
    opened = t["dim_user_address_zip"].where(F.col("end_date") == OPEN_DATE)
    rows = t["tms_user_address_inc"].where(F.col("dt") == d).withColumn("phone", masks.hashed_phone(F.col("phone")))
    return scd2_merge(opened, rows.select(*ADDRESS, "dt", "seq"), d, "id", ["dt", "seq"], close_offset=1)


# ---------------------------------------------------------------- facts
def _bound(t, time: str, emp: str) -> DataFrame:
    """A warehouse scan (T-W1). Scans that have not happened yet are dropped: a null time has no date."""
    return t["ods_order_org_bound"].where(F.col(time).isNotNull()).select(
        "id", "order_id", "org_id", ms_to_text(F.col(time)).alias(time), emp, ms_to_ds(F.col(time)).alias("dt"))


def dwd_bound_inbound(t, d) -> DataFrame:
    return _bound(t, "inbound_time", "inbound_emp_id")


def dwd_bound_outbound(t, d) -> DataFrame:
    return _bound(t, "outbound_time", "outbound_emp_id")


def dwd_bound_sort(t, d) -> DataFrame:
    return _bound(t, "sort_time", "sorter_emp_id")


def lifecycle_fact(t, time_col: str, event_time: Column, reached: Column | None = None) -> DataFrame:
    """One row per cargo whose order reached a milestone (C11), dated by ``event_time`` (an expression over the
    order, or over the cargo as ``cargo_time``).

    Each code column is resolved in the dictionary on its own, so no row is multiplied. ``reached=None`` keeps
    every order, whatever its state.
    """
    info = t["tms_order_info"] if reached is None else t["tms_order_info"].where(reached)
    info = info.withColumn("receiver_name", masks.first_letter(F.col("receiver_name"))) \
               .withColumn("sender_name", masks.first_letter(F.col("sender_name"))) \
               .withColumn("estimate_arrive_time", ms_to_text(F.col("estimate_arrive_time"))) \
               .withColumnRenamed("id", "_order").withColumnRenamed("create_time", "order_create_time")
    cargo = t["tms_order_cargo"].withColumnRenamed("create_time", "cargo_time")
    rows = cargo.join(info, F.col("order_id") == F.col("_order"))
    rows = rows.withColumn(time_col, event_time).withColumn("dt", F.substring(time_col, 1, 10))
    rows = codes_to_names(rows, t["ods_base_dic"], {
        "cargo_type": ("cargo_type_name", None), "status": ("status_name", None),
        "collect_type": ("collect_type_name", None), "payment_type": ("payment_type_name", None)})
    return rows.drop("_order", "cargo_time", "update_time", "order_create_time")


_UPDATED = "update_time"


def _reached(*states: str) -> Column:
    return F.col("status").isin(*states)


def dwd_trade_order_detail(t, d) -> DataFrame:
    return lifecycle_fact(t, "order_time", iso_to_text(F.col("cargo_time")))


def dwd_trade_order_cancel_detail(t, d) -> DataFrame:
    return lifecycle_fact(t, "cancel_time", iso_to_text(F.col(_UPDATED)), _reached(CANCELLED))


def dwd_trade_pay_suc_detail(t, d) -> DataFrame:
    return lifecycle_fact(t, "payment_time", iso_to_text(F.col(_UPDATED)), ~_reached(CANCELLED))


def dwd_trans_receive_detail(t, d) -> DataFrame:
    return lifecycle_fact(t, "receive_time", iso_to_text(F.col(_UPDATED)), _reached("60020", "60050", SIGNED))


def dwd_trans_dispatch_detail(t, d) -> DataFrame:
    return lifecycle_fact(t, "dispatch_time", iso_to_text(F.col(_UPDATED)), _reached("60050", SIGNED))


def dwd_trans_bound_finish_detail(t, d) -> DataFrame:
    return lifecycle_fact(t, "bound_finish_time", iso_to_text(F.col(_UPDATED)), _reached(SIGNED))


def dwd_trans_deliver_suc_detail(t, d) -> DataFrame:
    return lifecycle_fact(t, "deliver_suc_time", iso_to_text(F.col(_UPDATED)), _reached(SIGNED))


def dwd_trans_sign_detail(t, d) -> DataFrame:
    return lifecycle_fact(t, "sign_time", iso_to_text(F.col(_UPDATED)), _reached(SIGNED))


def dwd_trade_order_process(t, d) -> DataFrame:
    """Orders in progress (C10/T-W3): partitioned by the day the order ended, or open."""
    rows = lifecycle_fact(t.with_tables(tms_order_info=t["tms_order_info"].withColumn(
        "end_date", F.when(_reached(SIGNED, CANCELLED), F.substring("update_time", 1, 10)).otherwise(OPEN_DATE))),
        "order_time", iso_to_text(F.col("cargo_time")))
    return rows.withColumnRenamed("dt", "start_date").withColumn("dt", F.col("end_date"))


def dwd_trans_trans_finish(t, d) -> DataFrame:
    """Finished transport tasks with the planned end of their shift (T-W4)."""
    task = t["ods_transport_task"].where(F.col("actual_end_time").isNotNull())
    rows = lookup(task, t["dim_shift_full"], "shift_id", "id", {"estimated_time": "estimated_time"})
    planned = F.col("actual_start_time") + F.col("estimated_time") * 60_000
    return rows.select(
        "id", "shift_id", "line_id", "start_org_id", "start_org_name", "end_org_id", "end_org_name", "order_num",
        "driver1_emp_id", masks.first_letter(F.col("driver1_name")).alias("driver1_name"),
        "driver2_emp_id", masks.first_letter(F.col("driver2_name")).alias("driver2_name"), "truck_id",
        F.md5("truck_no").alias("truck_no"), ms_to_text(F.col("actual_start_time")).alias("actual_start_time"),
        ms_to_text(F.col("actual_end_time")).alias("actual_end_time"),
        ms_to_text(planned).alias("estimate_end_time"), "actual_distance",
        ((F.col("actual_end_time") - F.col("actual_start_time")) / 1000).cast("bigint").alias("finish_dur_sec"),
        ms_to_ds(F.col("actual_end_time")).alias("dt"))
