"""Benchmark the headline queries.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_REPEAT (default 3).  Each query runs once to warm up, then BENCH_REPEAT
times; the median is reported.  Plans execute in full through the ``noop``
sink (nothing is collected to the driver).  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

HEADLINE = [
    "C3_pickup_features",
    "C3_pickup_features_presliced",
    "C2_dropoff_features",
    "J6_training_set",
    "C1_customer_features",
    "L4_preprocess_fit_transform",
    "A17_M1_quality_profile",
    "M2_metric_violation_check",
    "C5_W1_scd2_merge",
    "W4_champion_history",
    "A14_roc_auc_ovr",
    "C1_customer_features_hot_customer",
    "J5_asof_lookup_single_hot_key",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]

    from featurewright.plans.registry import queries
    from featurewright.session import local_session

    spark = local_session(cores=cpus, shuffle_partitions=max(cpus, 8), driver_memory="16g")
    qs = queries()
    results: dict[str, float] = {}
    for name in only or HEADLINE:
        fn = qs[name]
        times = []
        for i in range(repeat + 1):
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            if i > 0:
                times.append(time.perf_counter() - t0)
            spark.catalog.clearCache()
        results[name] = round(statistics.median(times), 3)
        print(f"# {name}: {results[name]}s", file=sys.stderr)
    m = re.search(r"sf([0-9.]+)$", sf_dir)
    sf = float(m.group(1)) if m else None
    print(json.dumps({
        "metric": "headline_total_median_sec",
        "value": round(sum(results.values()), 3),
        "unit": "sec",
        "queries": results,
        "sf": sf,
        "cpus": cpus,
        "repeat": repeat,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
