"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR: table folder (default /root/testdata/sf0.1), BENCH_CPUS: local cores (default 8),
BENCH_QUERIES: comma-separated names instead of the headline list, or "all".
"""

import json
import os
import statistics
import time

from orderflow.plans import registry
from orderflow.session import local_session

HEADLINE = [
    "order_detail_parse", "order_wide_broadcast", "order_mwide_two_dims", "agg_region_traffic_tumbling",
    "agg_product_traffic_tumbling", "agg_wide_type_window", "agg_session_traffic", "agg_count_window_region",
    "stat_running_count_trigger", "stat_day_utc8", "stat_count_or_time", "running_totals_dep",
    "topn_within_key", "topn_cross_product", "kv_latest", "envelope_mwide", "log_click", "log_pageview",
    "log_viewlist_flat", "cep_duration_matches", "cep_duration_by_user", "pageview_stats", "click_stats",
    "burst_orders_by_user", "sliding_orders", "json_flatten",
    "stream_agg_region_traffic", "stream_count_or_time",
]


def run(query, spark, folder):
    started = time.perf_counter()
    query(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main():
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    wanted = os.environ.get("BENCH_QUERIES")
    names = list(registry.QUERIES) if wanted == "all" else wanted.split(",") if wanted else HEADLINE
    spark = local_session(cores, shuffle_partitions=cores if cores.isdigit() else 8)
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in names:
        query = registry.QUERIES[name]
        rounds = 1 if name.startswith(("stream", "landing")) else 2
        if rounds > 1:
            run(query, spark, folder)
        times[name] = round(statistics.median(run(query, spark, folder) for _ in range(rounds)), 3)
    print(json.dumps({
        "metric": "total query time", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
    }))
    spark.stop()


if __name__ == "__main__":
    main()
