"""Benchmark: run every registered query at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is built and executed to completion with the `noop` sink (full evaluation,
nothing collected to the driver), $BENCH_REPEATS times (default 2); the best time per
query is kept (every run lists its tables and plans anew; nothing is cached). One JSON line
is printed:
{"metric": "total_query_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ledgerlake.plans.catalog import QUERIES  # noqa: E402
from ledgerlake.session import local_session  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "2"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    spark = local_session(cores=cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8,
                          app="ledgerlake-bench")
    # JVM/codegen warm-up on the smallest query; not counted.
    QUERIES["json_props"](spark, sf_dir).write.format("noop").mode("overwrite").save()

    times: dict[str, float] = {}
    for name, q in QUERIES.items():
        if only and name not in only:
            continue
        best = None
        for _ in range(repeats):
            t = time.perf_counter()
            q(spark, sf_dir).write.format("noop").mode("overwrite").save()
            dt = time.perf_counter() - t
            best = dt if best is None else min(best, dt)
        times[name] = round(best, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {
        "metric": "total_query_sec",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
        "repeats": repeats,
        "stat": "min over repeats, noop sink, plan build included",
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
