"""Times the headline queries and prints one JSON line.

Every query runs once to warm up the JVM and once timed, its result written to the
no-op sink so that all rows are computed.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from salesprism.plans.catalogue import all_queries  # noqa: E402
from salesprism.session import local_session  # noqa: E402

HEADLINE = [
    "q01_overall_kpis", "q02_status_distribution", "q03_b2b_split", "q04_monthly_trend",
    "q05_quarterly_performance", "q06_weekday_pattern", "q07_weekly_revenue",
    "q08_category_revenue", "q09_top_products_by_revenue", "q10_top_products_by_quantity",
    "q11_category_by_month", "q12_size_distribution", "q13_top_states", "q14_top_cities",
    "q15_state_cancellation", "q16_channel_revenue", "q17_fulfilment_analysis",
    "q18_service_levels", "q19_promotion_impact", "q20_value_tiers",
    "q21_top_state_category_matrix", "q22_cumulative_revenue", "q23_return_rates",
    "q24_courier_revenue", "q25_executive_summary", "q26_revenue_per_order_by_state",
    "clean_orders", "orders_flat", "measures_by_category", "time_intelligence",
    "category_month_matrix", "order_quartiles", "customer_scores", "forecast_features",
]


def run(spark, query, folder: str) -> float:
    start = time.perf_counter()
    query(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores, int(cores) if cores.isdigit() else 8)
    known = all_queries()
    chosen = os.environ.get("BENCH_QUERIES", "").split(",") if os.environ.get("BENCH_QUERIES") else HEADLINE
    seconds = {}
    for key in chosen:
        run(spark, known[key], folder)
        seconds[key] = round(run(spark, known[key], folder), 3)
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
