"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR   input folder   (default /root/testdata/sf0.1)
BENCH_CPUS     local threads  (default 8)
BENCH_QUERIES  comma-separated subset, or "all"
BENCH_RUNS     runs per query, the best counts (default 2, so the first is the warm-up)
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from depotflow import registry
from depotflow.session import build_session

HEADLINE = (
    "clean_sales",
    "clean_production",
    "clean_inventory",
    "clean_accounts",
    "quality_sales",
    "sales_monthly",
    "sales_by_category",
    "sales_route_performance",
    "sales_top_customers",
    "sales_year_over_year",
    "sales_customer_segments",
    "production_monthly",
    "production_yield_pivot",
    "inventory_monthly_turnover",
    "inventory_days_of_supply",
    "accounts_billing_collections",
    "accounts_receivables_aging",
    "accounts_customer_payment",
    "measures_revenue_to_date",
    "measures_monthly_time_intelligence",
    "measures_customer_rank",
    "measures_top_n_customers",
    "measures_inventory_by_product",
    "star_read",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    wanted = os.environ.get("BENCH_QUERIES", "")
    spark = build_session(
        "bench",
        spark__master=f"local[{cpus}]",
        spark__driver__memory="8g",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__sql__shuffle__partitions=cpus,
        spark__sql__session__timeZone="UTC",
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = registry.queries()
    names = list(queries) if wanted == "all" else [n for n in wanted.split(",") if n] or HEADLINE

    times = {}
    for name in names:
        best = None
        for _ in range(runs):
            start = time.perf_counter()
            # Every row and column is produced, nothing is sent to the driver.
            queries[name](spark, folder).write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - start
            best = took if best is None else min(best, took)
        times[name] = round(best, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_seconds_headline_queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder.rstrip("/")),
            }
        )
    )


if __name__ == "__main__":
    main()
