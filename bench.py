"""Bench: headline queries on the driver tables; prints one JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (timed runs per query, default 5; the best is reported).
Each query runs to completion into Spark's ``noop`` sink (the whole plan
executes; nothing is collected).  One warm-up run precedes the timings.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemark.plans.analogues import QUERIES  # noqa: E402
from tidemark.session import build_session  # noqa: E402

HEADLINE = [
    "asof_fact",            # as-of lookup, scan form
    "asof_fact_join",       # as-of lookup, join form
    "merge_timelines",
    "merge_timelines_join",     # literal form, for comparison
    "replay_snapshots",
    "snapshot_two_runs",
    "latest_overlay",
    "upsert_latest",
    "insert_absent",
    "merge_by_key",
    "quality_checks",
    "quality_checks_one_by_one",  # one job per check, for comparison
    "lines_per_order",
    "redact_digits",
    "gold_fact_transactions",   # dimensions + fact end to end
]


def run(spark, name, sf_dir):
    t0 = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    spark = build_session(f"local[{cpus}]", max(cpus, 8), app_name="tidemark-bench")
    timings: dict[str, float | None] = {}
    try:
        run(spark, "asof_fact", sf_dir)                  # warm-up (JVM, code generation)
    except Exception as e:  # noqa: BLE001 - reported, the bench goes on
        print(f"warm-up failed: {e}", file=sys.stderr)
    for name in HEADLINE:
        try:
            timings[name] = round(min(run(spark, name, sf_dir) for _ in range(runs)), 3)
        except Exception as e:  # noqa: BLE001 - a failing query is recorded as null
            print(f"{name} failed: {e}", file=sys.stderr)
            timings[name] = None
    m = re.search(r"sf([0-9.]+)", sf_dir)
    total = round(sum(v for v in timings.values() if v is not None), 3)
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec",
                      "queries": timings, "sf": float(m.group(1)) if m else sf_dir}))
    spark.stop()


if __name__ == "__main__":
    main()
