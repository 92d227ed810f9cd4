"""Headline query timings.

Runs each headline query once to warm up (JIT, codegen cache, text
exports), then BENCH_REPEATS more times, each to completion into Spark's
no-op sink (every row computed, nothing collected to Python).  Prints one
JSON line: per-query warm medians and their sum.

env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
     BENCH_REPEATS (default 3), BENCH_QUERIES (comma list, default headline set)
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cellroll.queries.registry import QUERIES  # noqa: E402
from cellroll.session import build_session, env_int  # noqa: E402

HEADLINE = ("load_lines_comma", "feed_join", "daily_rollup", "first_wins", "insert_ignore",
            "quality_report", "wide_rollup", "full_load_daily")


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = env_int("BENCH_CPUS", 8)
    repeats = max(1, env_int("BENCH_REPEATS", 3))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    spark = build_session(f"local[{cpus}]", app="cellroll-bench", shuffle_partitions=cpus,
                          extra={"spark.driver.memory": "16g"})
    out = {}
    for name in names:
        times = []
        for i in range(repeats + 1):
            t0 = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            if i > 0:
                times.append(time.perf_counter() - t0)
        out[name] = round(statistics.median(times), 3)
        print(f"# {name}: {out[name]}s", file=sys.stderr, flush=True)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "sum_of_warm_median_query_seconds",
        "value": round(sum(out.values()), 3),
        "unit": "sec",
        "queries": out,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
        "repeats": repeats,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
