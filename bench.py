"""Headline queries, timed end to end; prints one JSON line.

The first query runs once unmeasured. Then each query runs ``BENCH_RUNS`` times (default 3) and
counts with its median run.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    "m21_fct_revenue_daily", "m11_int_customers_unified", "m12_int_orders_all_channels", "m13_int_customer_metrics",
    "m14_int_sessions", "m15_dim_customers", "m19_fct_revenue_monthly", "m20_fct_reconciliation",
    "m24_fct_inventory_alerts", "m25_fct_store_performance", "j2_left_join_any_key", "w3_ntile_global",
    "t3_revenue_1min", "t4_sessions_30min", "t6_flash_sale_1min", "q11_check_report", "r1_batch_stream_daily",
    "x7_revenue_by_category", "x16_identity_clusters",
)


def main() -> None:
    from martloom import build_session, catalog

    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("martloom-bench", f"local[{cpus}]", int(cpus) if cpus.isdigit() else None, **{
        "spark.ui.enabled": "false", "spark.checkpoint.dir": tempfile.mkdtemp(prefix="bench-"), "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g")})
    spark.sparkContext.setLogLevel("ERROR")
    wanted = sys.argv[1:] or HEADLINE
    queries = catalog.queries()
    wanted = [name for name in wanted if name in queries]
    for name in wanted[:1]:
        queries[name](spark, folder).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in wanted:
        runs = []
        for _ in range(int(os.environ.get("BENCH_RUNS", "3"))):
            begin = time.perf_counter()
            queries[name](spark, folder).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - begin)
        seconds[name] = round(statistics.median(runs), 3)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
