"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the table folder, ``BENCH_CPUS`` the local cores. Each query runs once to warm up and three
times for the record (median), into the noop sink so that every row is computed and none is collected. Every run starts
from fresh table definitions, so that jobs that run while a plan is built count; their share is listed in ``planning``.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from shelfline.plans.registry import forget, queries  # noqa: E402
from shelfline.session import local_session  # noqa: E402

HEADLINES = (
    "clean_financial_transactions clean_logistics clean_product_reviews flatten_inventory sales_enriched"
    " daily_sales_summary promotions_active customers_enriched marketing_performance region_performance"
    " quarterly_growth basket_by_income promo_sensitivity campaign_ranking numeric_distribution service_influence"
    " delivery_satisfaction stock_sales_satisfaction business_dashboard sales_kpis promo_by_type marketing_kpis"
).split()
RUNS = 3


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    chosen = sys.argv[1:] or HEADLINES
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "shelfline-bench")
    spark.sparkContext.setLogLevel("ERROR")
    registered = queries()
    seconds: dict[str, float] = {}
    planning: dict[str, float] = {}
    for key in chosen:
        taken, planned = [], []
        for _ in range(RUNS + 1):
            forget()
            started = time.perf_counter()
            result = registered[key](spark, folder)
            planned.append(time.perf_counter() - started)
            result.write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - started)
        seconds[key] = round(statistics.median(taken[1:]), 3)
        planning[key] = round(statistics.median(planned[1:]), 3)
    spark.stop()
    line = {
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "planning": planning,
        "sf": Path(folder).name.removeprefix("sf"),
    }
    print(json.dumps(line))


if __name__ == "__main__":
    main()
