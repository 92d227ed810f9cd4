"""Print plan facts of registered queries (exchanges, pushed filters, read schemas).

usage: python tools/show_plans.py [sf_dir] [name ...]   (AQE initial plans; queries
that write tables run their writes first and show the plan of the final read)
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cellroll.queries.registry import QUERIES  # noqa: E402
from cellroll.session import build_session  # noqa: E402

NAMES = ("load_lines_comma", "feed_join", "daily_rollup", "first_wins", "insert_ignore",
         "hourly_latest", "quality_report", "wide_rollup", "feed_join_audit", "cell_key_collisions")


def facts(plan: str) -> dict:
    return {
        "exchanges": len(re.findall(r"Exchange hashpartitioning", plan)),
        "broadcasts": plan.count("BroadcastExchange"),
        "window_group_limit_partial": "WindowGroupLimit" in plan and "Partial" in plan,
        "partial_aggregates": plan.count("partial_"),
        "pushed_filters": sorted(set(re.findall(r"PushedFilters: \[([^\]]*)\]", plan)) - {""}),
        "read_schemas": sorted(set(re.findall(r"ReadSchema: (struct<[^>]{0,160})", plan))),
        "python_udf": "BatchEvalPython" in plan or "ArrowEvalPython" in plan,
    }


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or NAMES
    spark = build_session("local[8]", shuffle_partitions=8)
    spark.conf.set("spark.sql.debug.maxToStringFields", "1000")
    for name in names:
        df = QUERIES[name](spark, sf)
        plan = df._jdf.queryExecution().executedPlan().toString()
        print(f"## {name}")
        for k, v in facts(plan).items():
            print(f"- {k}: {v}")
    spark.stop()


if __name__ == "__main__":
    main()
