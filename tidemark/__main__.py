"""Command line: ``python -m tidemark bootstrap|run-day|rebuild ...``.

The daily command is what a scheduler calls once a day (it replaces the
reference's task chain: loads, silver, snapshots, silver checks, gold, gold
checks).  Clocks are explicit so a day can be re-run with the same result.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import sys

from tidemark.operators.load import utc
from tidemark.plans import jobs
from tidemark.session import build_session


def _ts(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="tidemark", description=__doc__)
    parser.add_argument("--master", default=None,
                        help="Spark master (default: the one spark-submit or the cluster configuration gives)")
    sub = parser.add_subparsers(dest="command", required=True)
    b = sub.add_parser("bootstrap", help="load every seed file into bronze")
    b.add_argument("--seed-dir", required=True)
    b.add_argument("--root", required=True)
    b.add_argument("--run-ts", type=_ts, required=True)
    d = sub.add_parser("run-day", help="the daily run for one landing folder")
    d.add_argument("--day", required=True, help="YYYY-MM-DD: folder and file suffix under --incoming")
    d.add_argument("--incoming", required=True)
    d.add_argument("--root", required=True)
    d.add_argument("--run-ts", type=_ts, required=True)
    d.add_argument("--as-of", type=dt.date.fromisoformat, default=None)
    d.add_argument("--on-fail", choices=["error", "warn"], default="error")
    r = sub.add_parser("rebuild", help="rebuild one layer from the layer below")
    r.add_argument("layer", choices=["silver", "snapshots", "gold"])
    r.add_argument("--root", required=True)
    r.add_argument("--run-ts", type=_ts, required=True)
    r.add_argument("--as-of", type=dt.date.fromisoformat, default=None)
    args = parser.parse_args(argv)

    spark = build_session(args.master, shuffle_partitions=None)
    if args.command == "bootstrap":
        print(json.dumps({"loaded": jobs.bootstrap(spark, args.seed_dir, args.root, args.run_ts)}))
    elif args.command == "run-day":
        failed = jobs.run_day(spark, args.day, args.incoming, args.root, args.run_ts, as_of=args.as_of,
                              on_fail=args.on_fail)
        print(json.dumps(failed, default=str))
    elif args.layer == "silver":
        jobs.build_silver(spark, args.root, args.as_of or utc(args.run_ts).date(), args.run_ts)
    elif args.layer == "snapshots":
        jobs.take_snapshots(spark, args.root, args.run_ts)
    else:
        jobs.build_gold(spark, args.root, args.run_ts, full=True)
    return 0


if __name__ == "__main__":
    sys.exit(main())
