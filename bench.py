"""Time the headline queries on local[$BENCH_CPUS] over $BENCH_SF_DIR; one JSON line on stdout.

Each query runs once to warm up and then BENCH_RUNS times; the median is reported.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    "popularity_host", "popularity_host_daily", "popularity_uri", "fiveday_popularity_host", "cnt_resp_ip",
    "alert_match", "conn_enrich_left", "blacklist_match", "ssl_mismatch_label", "tuple_profile", "cert_inventory",
    "leaf_root", "ca_category", "registered_domain", "subnet_index", "clean_schema", "build_ts", "merge_ts",
    "autocorr", "periodogram", "periodicity", "domain_history", "discrete_score", "continuous_score", "topk",
    "coverage", "verdict_pivot", "resolve_popularity",
)


def main() -> None:
    from flowloom.plans.queries import QUERIES
    from flowloom.session import local_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = os.environ.get("BENCH_QUERIES", "").split(",") if os.environ.get("BENCH_QUERIES") else HEADLINE
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    times = {}
    for name in names:
        laps = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            laps.append(time.perf_counter() - start)
        times[name] = round(statistics.median(laps[1:]), 4)
        print(f"{name} {times[name]} (first {laps[0]:.2f})", file=sys.stderr)
    print(json.dumps({
        "metric": "median seconds per headline query, summed", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
