"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the folder of the tables, BENCH_CPUS the number of local cores. Every query is
executed completely (noop sink). Each is run twice in a row and the faster run counts.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from tallyline.catalog import QUERIES
from tallyline.session import build_session

HEADLINES = [
    "V1_ledger_close_actuals", "V5_month_to_date_variance", "V8_statement_overview", "V9_consolidation", "V11_cross_table",
    "L1_scenarios_with_prior_years", "L5_whole_book_statement", "L5_newest_month_statement",
    "R1_net_sales_bridge", "R3_ratio_table", "R6_organics_summary",
    "D1_daily_perspective", "D3_tracking_of_all_days",
    "X1_daily_rates", "X5_transactional_matrix", "X6_transactional_impact", "X9_account_compression",
    "H2_region_classification", "H5_gap_report",
    "K1_plan_vs_collected", "K2_sales_vs_billing", "K3_wide_compress", "K5_entity_map", "K7_requisition_cross_check",
    "B1_operating_plan", "B3_payroll_forecast", "E1_head_matrix", "T1_order_meter", "T5_policy_table",
    "A7_flatten_text", "A9_totals_row", "A12_long_to_wide", "J4_missing_both_ways", "J10_contains_any_code",
    "W1_row_index", "W2_first_rows", "W3_latest_per_group", "W6_running_month_to_date", "F14_unnest",
]


def timed(spark, name: str, folder: str) -> float:
    begin = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - begin


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("tallyline-bench", cpus, shared=tempfile.mkdtemp(prefix="run-"))
    spark.sparkContext.setLogLevel("ERROR")
    timed(spark, HEADLINES[1], folder)
    seconds = {name: round(min(timed(spark, name, folder) for _ in range(2)), 3) for name in HEADLINES}
    print(json.dumps({
        "metric": "headline queries, total time", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
