"""Registered queries against their SQL on the smallest tables. ``python -m registry.check DIR`` runs them all."""

import pytest

import __spark_entry__ as driver
from registry.check import compare, connect

FAST = """B1_dim_activity_full B5_dim_sku_full M2_dim_user_zip_daily M4_dwd_trade_order_flow_daily
B13_dws_trade_province_order_1d B17_dws_trade_user_sku_order_1d B20_dws_trade_province_order_nd
B22_dws_trade_user_order_td_merge B23_dws_user_user_login_td_merge B26_ads_order_continuously_user_count
B30_ads_page_path B34_ads_traffic_stats_by_channel B35_ads_user_action B36_ads_user_change M7_dws_trade_province_order_nd
TD7_dim_user_zip_daily TW2_dwd_trans_receive_detail TW3_dwd_trade_order_process TS5_dws_trans_org_sort_1d
TN2_dws_trans_shift_trans_finish_nd TA1_ads_city_stats TA2_ads_driver_stats TA3_ads_express_city_stats
TA8_ads_trans_order_stats_td G1_dwd_sku_sales_inventory_daily G3_ads_sku_sales_top5 G5_dws_attribute_analysis
G5_dws_traffic_analysis G8_dws_block_stats G10_direct_guide_detail G12_dws_instore_flow_summary
G13_ads_pc_entry_analysis G14_direct_flow S12_overwrite_dynamic S18_upsert J8_full_outer_three C4_to_date_merge
C7_scd2_merge C15_split_shared_measure W1_latest_per_key D1_words F16_hash_bucket X15_new_flag_repair
X16_retraction R1_log_split R6_order_detail_fact R13_page_view_window R21_province_orders""".split()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("key", FAST)
def test_matches_sql(spark, con, sf_dir, key):
    ok, note = compare(spark, con, sf_dir, driver.queries()[key], driver.oracle_sql()[key])
    assert ok, note


def test_contract(spark):
    queries, sql = driver.queries(), driver.oracle_sql()
    assert set(sql) <= set(queries) and len(queries) > 300
    assert driver.entry(spark).count() > 0


def test_layered_equals_direct_where_definitions_agree(spark, sf_dir):
    """Visitors of the layered page report and of the direct one are the same measure."""
    from pyspark.sql import functions as F
    a = driver.queries()["G9_ads_page_trend_report"](spark, sf_dir).select("page_type", "stat_date", "daily_visitor_count")
    b = driver.queries()["G10_direct_page_trend"](spark, sf_dir).select("page_type", "stat_date", "daily_visitor_count")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    assert a.agg(F.sum("daily_visitor_count")).first()[0] > 0
