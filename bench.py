"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]: one warm-up, then the median of three runs, as one JSON line."""

from __future__ import annotations

import json
import os
import pathlib
import statistics
import sys
import time

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent))

from registry import REG  # noqa: E402
from tidemill.session import local_session  # noqa: E402

HEADLINE = [
    "B13_dws_trade_province_order_1d", "B15_dws_trade_user_order_1d", "B17_dws_trade_user_sku_order_1d",
    "B21_dws_trade_user_sku_order_nd", "B22_dws_trade_user_order_td_merge", "B27_ads_order_stats_by_cate",
    "B30_ads_page_path", "B32_ads_sku_cart_num_top3_by_cate", "B34_ads_traffic_stats_by_channel",
    "B37_ads_user_retention", "M4_dwd_trade_order_flow_init", "M7_dws_trade_province_order_nd",
    "TW2_dwd_trans_receive_detail", "TS1_dws_trade_org_cargo_type_order_1d", "TA1_ads_city_stats",
    "TA3_ads_express_city_stats", "G2_dws_product_sales", "G3_ads_sku_sales_top5", "G5_dws_attribute_analysis",
    "G8_dws_block_stats", "G13_ads_pc_entry_analysis", "J13_date_range_join", "W6_next_and_number",
]


def once(spark, sf_dir: str, key: str) -> float:
    start = time.perf_counter()
    REG.queries[key](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(cpus, "tidemill-bench", shuffle_partitions=int(cpus))
    timed = {}
    for key in HEADLINE:
        once(spark, sf_dir, key)
        timed[key] = round(statistics.median(once(spark, sf_dir, key) for _ in range(runs)), 3)
    sf = pathlib.Path(sf_dir).name.removeprefix("sf")
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(timed.values()), 3), "unit": "sec",
                      "queries": timed, "sf": float(sf) if sf.replace(".", "").isdigit() else sf}), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
