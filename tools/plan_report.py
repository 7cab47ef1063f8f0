"""Summarize the physical plan of every registered query (shuffles, broadcasts, scans).

Usage: python tools/plan_report.py [sf_dir] > PLANS.md
Flags any nested-loop join, cartesian product or Python evaluation in a plan.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark.plans.analogues import QUERIES  # noqa: E402
from tidemark.session import build_session  # noqa: E402

SKIP = {"stream_landing", "stream_upsert"}   # run a stream to produce their result table; the plan is a plain scan


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session("local[8]", 8)
    print(f"# Physical plans at {os.path.basename(sf_dir)} (initial AQE plans)\n")
    print("| query | shuffles | broadcasts | windows | aggregates | scans (columns read) | red flags |")
    print("|---|---|---|---|---|---|---|")
    for name, fn in QUERIES.items():
        if name in SKIP:
            continue
        text = plan_text(fn(spark, sf_dir))
        shuffles = len(set(re.findall(r"Exchange (?:hash|range)partitioning[^\n]*\[plan_id=(\d+)\]", text)
                           + re.findall(r"Exchange SinglePartition[^\n]*\[plan_id=(\d+)\]", text)))
        bcast = len(set(re.findall(r"BroadcastExchange[^\n]*\[plan_id=(\d+)\]", text)))
        windows = len(re.findall(r"\bWindow \[", text))
        aggs = len(re.findall(r"(HashAggregate|SortAggregate|ObjectHashAggregate)\(", text))
        cols = set()
        for line in text.splitlines():
            m = re.search(r"FileScan parquet .*?/([a-z_]+)\.parquet\].*ReadSchema: struct<(.*)>", line)
            if m:
                cols.add(f"{m.group(1)}({m.group(2).count(':')})")
        cols = sorted(cols)
        flags = [f for f in ["BroadcastNestedLoopJoin", "CartesianProduct", "BatchEvalPython", "ArrowEvalPython",
                             "FlatMapGroupsInPandas"] if f in text]
        print(f"| {name} | {shuffles} | {bcast} | {windows} | {aggs} | {', '.join(cols)} | {', '.join(flags) or '-'} |")
    for name in ("asof_fact", "high_water"):
        print(f"\n## `{name}`: physical plan (`explain(\"formatted\")`, initial AQE plan)\n")
        print("```")
        print(QUERIES[name](spark, sf_dir)._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")).strip())
        print("```")
    spark.stop()


if __name__ == "__main__":
    main()
