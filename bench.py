"""Time the headline queries and print one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from brookmark.session import build_session  # noqa: E402
from brookmark.workload import all_queries  # noqa: E402

HEADLINE = [
    "star_revenue", "fact_order_items", "v_orders", "daily_revenue", "order_totals", "dim_date",
    "orders_clean", "silver_orders", "silver_customers", "latest_by_key", "merge_raw_orders",
    "merge_silver_order_items", "extract_incremental", "bronze_day", "lakehouse_orders",
    "cdc_parse", "cdc_current", "cdc_stream_current", "orders_mirror_current", "reconcile_replica",
    "dq_report", "fk_orphans", "reconcile_totals", "freshness", "revenue_z", "rolling_z",
    "event_increase", "alert_hold", "predict_linear", "message_rate", "expire_versions",
    "orphan_files", "compact_table", "cluster_table", "storage_report", "adhoc_star",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    repeats = int(os.environ.get("BENCH_REPEATS", "2"))
    spark = build_session(
        "brookmark-bench",
        master=f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "12g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = all_queries()
    chosen = sys.argv[1:] or HEADLINE
    seconds: dict[str, float] = {}
    queries["star_revenue"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm up
    for name in chosen:
        best = float("inf")
        for _ in range(repeats):
            start = time.perf_counter()
            queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            best = min(best, time.perf_counter() - start)
        seconds[name] = round(best, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
