"""Benchmark the headline queries; prints one JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_REPEAT (default 2: the best of the runs is reported per query),
BENCH_SHUFFLE_PARTITIONS (default 2 x cpus; AQE coalesces at run time).
Each query is executed in full with the ``noop`` sink (no driver collect).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pluvia.plans import catalog  # noqa: E402
from pluvia.session import build_session  # noqa: E402

HEADLINE = ["silver_clean", "dq_all_checks", "quality_report", "mart_city_stats",
            "top_groups_share", "headline_kpis", "last_n_per_key", "flatten_parallel_arrays",
            "load_replace_partitions", "raw_payload_roundtrip"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "2"))
    shuffle = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", str(max(2 * cpus, 8))))
    spark = build_session(f"local[{cpus}]", app_name="pluvia-bench",
                          shuffle_partitions=shuffle,
                          extra={"spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    # Warm-up: JVM, file listing, codegen caches.
    catalog.silver(spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in HEADLINE:
        best = None
        for _ in range(repeat):
            t0 = time.perf_counter()
            catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            dt = time.perf_counter() - t0
            best = dt if best is None else min(best, dt)
        times[name] = round(best, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": float(m.group(1)) if m else None,
                      "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
