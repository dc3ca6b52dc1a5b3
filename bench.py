"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR names the tables (default sf0.1), BENCH_CPUS the local cores. Each query is
run whole into a sink that discards its rows, once to warm up and then timed.
"""

from __future__ import annotations

import json
import os
import time

from clickloom.plans.queries import registered
from clickloom.session import build_session

HEADLINE = [
    "enriched_events", "key_figures", "sales_by_device_and_source", "sales_by_gender",
    "daily_event_counts", "sales_by_category", "top_sold_products", "sales_by_location",
    "parsed_events", "json_messages", "incremental_extract",
    "funnel_10s", "top_products_10s", "trending_totals_10s", "live_tiles",
    "abandoned_carts_5min", "abandonment_totals_10s",
    "stream_funnel", "stream_funnel_10s", "stream_top_products", "stream_abandonment_totals", "stream_history",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("clickloom-bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false",
        "spark.driver.memory": "16g", "spark.log.level": "ERROR",
    })
    queries = registered()
    seconds: dict[str, float] = {}
    for name in HEADLINE:
        for _ in range(2):
            started = time.perf_counter()
            queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - started, 3)
    spark.stop()
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(seconds.values()), 3),
        "unit": "sec", "queries": seconds, "sf": os.path.basename(sf_dir).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
