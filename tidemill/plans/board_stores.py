"""In-store path board: wireless entries, page visits, page-to-page flow, PC entries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.functions.numbers import distinct_if, ratio
from tidemill.functions.text import cleaned
from tidemill.operators.merge import unify
from tidemill.operators.ranking import number_all, top_n, with_group_total

# The columns of the unified log and its log names.
UNIFIED = [("visitor_id", "bigint"), ("store_id", "string"), ("page_type", "string"), ("page_category", "string"),
           ("page_subtype", "string"), ("source_page", "string"), ("target_page", "string"), ("visit_time", "string"),
           ("is_buy", "int"), ("stay_time", "int"), ("dt", "string")]


def dwd_traffic_unified_detail(t, d) -> DataFrame:
    """Four logs in one shape; rows without the value that makes them useful are dropped."""
    return unify({
        "wireless_instore": t["ods_wireless_instore_log"].where(F.col("visit_time").isNotNull()),
        "page_visit": t["ods_page_visit_log"].where(F.col("stay_time") > 0),
        "instore_flow": t["ods_instore_flow_log"].where(
            F.col("source_page").isNotNull() & F.col("target_page").isNotNull())
        .withColumnRenamed("jump_time", "visit_time"),
        "pc_entry": t["ods_pc_entry_log"],
    }, UNIFIED)


def _log(t, name: str) -> DataFrame:
    return t["dwd_traffic_unified_detail"].where(F.col("data_type") == name)


def dws_wireless_pc_summary(t, d) -> DataFrame:
    wireless = _log(t, "wireless_instore").groupBy("dt", "store_id", "page_type").agg(
        F.count_distinct("visitor_id").alias("wireless_uv"),
        distinct_if(F.col("is_buy") == 1, F.col("visitor_id")).alias("wireless_buyer_num"))
    pc = _log(t, "pc_entry").groupBy("dt", "store_id", "source_page").agg(F.count_distinct("visitor_id").alias("pc_uv"))
    return wireless.unionByName(pc, allowMissingColumns=True)


def dws_page_visit_summary(t, d) -> DataFrame:
    return _log(t, "page_visit").groupBy("dt", "store_id", "page_category", "page_subtype").agg(
        F.count_distinct("visitor_id").alias("page_uv"), F.count(F.lit(1)).alias("page_pv"),
        ratio(F.sum("stay_time"), F.count("stay_time")).alias("avg_stay_time"))


def dws_instore_flow_summary(t, d) -> DataFrame:
    """Flow counts every jump (repeats included) next to the store's total of the day."""
    flow = _log(t, "instore_flow").groupBy("dt", "store_id", "source_page", "target_page").agg(
        F.count("visitor_id").alias("flow_uv"))
    return with_group_total(flow, ["dt", "store_id"], "flow_uv", "total_store_flow")


def ads_wireless_instore_analysis(t, d) -> DataFrame:
    rows = t["dws_wireless_pc_summary"].where(F.col("page_type").isNotNull())
    return rows.select("dt", "store_id", "page_type", F.col("wireless_uv").alias("total_uv"),
                       F.col("wireless_buyer_num").alias("total_buyer_num"),
                       ratio(F.col("wireless_buyer_num"), F.col("wireless_uv"), 4).alias("conversion_rate"))


def ads_page_visit_rank(t, d) -> DataFrame:
    """Pages of a store and day numbered by visitors; names are trimmed, defaulted and cut to 50 characters."""
    rows = t["dws_page_visit_summary"].withColumn("store_id", cleaned(F.col("store_id"), "unknown_store", 50)) \
        .withColumn("page_category", cleaned(F.col("page_category"), "unknown_category", 50))
    return number_all(rows, ["dt", "store_id"], "page_uv", ["page_category", "page_subtype"], "rank_num")


def ads_instore_flow_analysis(t, d) -> DataFrame:
    return t["dws_instore_flow_summary"].withColumn(
        "source_ratio", ratio(F.col("flow_uv"), F.col("total_store_flow"), 4)).drop("total_store_flow")


def ads_pc_entry_analysis(t, d) -> DataFrame:
    """The 20 strongest PC entries per store and day with their share."""
    rows = t["dws_wireless_pc_summary"].where(F.col("source_page").isNotNull()).select(
        "dt", "store_id", "source_page", F.col("pc_uv").alias("source_uv"))
    rows = with_group_total(rows, ["dt", "store_id"], "source_uv", "_all")
    rows = top_n(rows, ["dt", "store_id"], [F.col("source_uv").desc(), F.col("source_page")], 20, "top_rank")
    return rows.withColumn("source_ratio", ratio(F.col("source_uv"), F.col("_all"), 4)).drop("_all")


# ---------------------------------------------------------------- straight from the logs, over a date range
def direct_wireless(t, first: str, last: str) -> DataFrame:
    rows = t["ods_wireless_instore_log"].where(F.col("dt").between(first, last))
    return rows.groupBy("store_id", "page_type").agg(
        F.count_distinct("visitor_id").alias("uv"),
        distinct_if(F.col("is_buy") == 1, F.col("visitor_id")).alias("buyer_num"))


def direct_page_visits(t, first: str, last: str) -> DataFrame:
    rows = t["ods_page_visit_log"].where(F.col("dt").between(first, last))
    return rows.groupBy("store_id", "page_category", "page_subtype").agg(
        F.count_distinct("visitor_id").alias("page_uv"), F.count(F.lit(1)).alias("page_pv"),
        ratio(F.sum("stay_time"), F.count("stay_time")).alias("avg_stay_time"))


def direct_flow(t, first: str, last: str) -> DataFrame:
    """Flow by distinct visitors, the other definition of the same report."""
    rows = t["ods_instore_flow_log"].where(F.col("dt").between(first, last))
    flow = rows.groupBy("store_id", "source_page", "target_page").agg(F.count_distinct("visitor_id").alias("flow_uv"))
    flow = with_group_total(flow, ["store_id"], "flow_uv", "_all")
    return flow.withColumn("source_ratio", ratio(F.col("flow_uv"), F.col("_all"), 4)).drop("_all")


def direct_pc_entries(t, first: str, last: str, n: int = 20) -> DataFrame:
    """The n strongest entries of all stores together."""
    rows = t["ods_pc_entry_log"].where(F.col("dt").between(first, last))
    uv = rows.groupBy("store_id", "source_page").agg(F.count_distinct("visitor_id").alias("source_uv"))
    uv = with_group_total(uv, ["store_id"], "source_uv", "_all")
    return uv.withColumn("source_uv_ratio", ratio(F.col("source_uv"), F.col("_all"), 4)).drop("_all").orderBy(
        F.col("source_uv").desc(), "store_id", "source_page").limit(n)
