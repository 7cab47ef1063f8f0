"""Largest per-task group and run time of the skewed as-of lookup, with and without hot-key splitting.

Usage: python tools/skew_report.py [sf_dir]
The input gives one customer a third of all line items (``asof_fact_skewed``).
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from tidemark.operators.scan import SEG, plan_segments  # noqa: E402
from tidemark.plans import analogues as A  # noqa: E402
from tidemark.session import build_session  # noqa: E402


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session("local[8]", 8)
    orders = A.load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    facts = (A.load(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
             .join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "left")
             .withColumn("o_custkey", F.when(F.col("l_linenumber") <= 2, F.lit(A.HOT_CUSTOMER).cast("long"))
                         .otherwise(F.col("o_custkey"))))
    total = facts.count()
    rows_per_segment = max(1000, total // 200)
    for label, opts in [("whole keys", {"hot_keys": False}),
                        ("hot keys split", {"rows_per_segment": rows_per_segment})]:
        segs = plan_segments(facts, ["o_custkey"], "l_shipdate", **opts)
        groups = segs.assign(facts).groupBy("o_custkey", SEG).count()
        largest = groups.agg(F.max("count")).first()[0]
        n_groups = groups.filter(F.col("o_custkey") == A.HOT_CUSTOMER).count()
        t0 = time.perf_counter()
        out = A.lookup_version(
            facts.drop("o_orderkey"),
            A.order_priority_versions(spark, sf_dir).withColumn("customer_sk", A.versioned_key("o_custkey", "valid_from")),
            "o_custkey", "l_shipdate", columns=["customer_sk", "priority"], **opts)
        out.write.format("noop").mode("overwrite").save()
        dt = time.perf_counter() - t0
        print(f"{label:15s} rows={total} largest_group={largest} ({largest / total:.1%}) "
              f"hot_key_groups={n_groups} lookup_sec={dt:.2f}")
    spark.stop()


if __name__ == "__main__":
    main()
