"""Benchmark the headline queries.

Runs each query on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) with
``local[$BENCH_CPUS]``, executes it fully through the ``noop`` sink (no
driver collect), takes the median of ``$BENCH_REPEATS`` timed runs after one
warm-up, and prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from logstream.plans.registry import all_queries  # noqa: E402
from logstream.session import get_spark  # noqa: E402

HEADLINE = [
    "parse_access_log",
    "url_strict_counts",
    "sliding_url_counts",
    "sliding_url_counts_1s",
    "top_urls_per_window",
    "error_alarm",
    "agent_counts_per_interval",
    "sessions_30m",
    "sessions_2d_first10",
    "latest_by_ip",
    "linreg_sgd_batch",
    "kmeans_train_batch",
    "kmeans_score",
    # streaming: the table's own files, bounded per micro-batch
    "stream_sessions",
    "stream_sliding_url_counts_1s",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    only = os.environ.get("BENCH_QUERIES")
    names = only.split(",") if only else HEADLINE
    spark = get_spark(f"local[{cpus}]", shuffle_partitions=max(cpus, 8), app_name="logstream-bench",
                      extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "8g")})
    queries = all_queries()
    results = {}
    for name in names:
        fn = queries[name]
        runs = []
        for i in range(repeats + 1):
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            dt = time.perf_counter() - t0
            if i:  # first run warms up the JVM / caches
                runs.append(dt)
        results[name] = round(statistics.median(runs), 3)
    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({"metric": "sum_of_median_query_seconds",
                      "value": round(sum(results.values()), 3), "unit": "sec",
                      "queries": results, "sf": sf, "cpus": cpus, "repeats": repeats}))
    spark.stop()


if __name__ == "__main__":
    main()
