"""Command line: list the registered queries, run one, optionally export it.

    python -m fieldbook list
    python -m fieldbook run k12_queue_pivot --sf /root/testdata/sf0.01 --show 24
    python -m fieldbook run k12_queue_pivot --sf DIR --out /shared/queue_pivot --format csv
    python -m fieldbook explain k27_improvement_plan --sf DIR
"""

from __future__ import annotations

import argparse
import sys

from fieldbook.plans.registry import queries
from fieldbook.session import build_session
from fieldbook.sources.io import write_csv
from fieldbook.sources.store import owned


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="fieldbook")
    sub = ap.add_subparsers(dest="cmd", required=True)
    sub.add_parser("list", help="list registered queries")
    for cmd in ("run", "explain"):
        p = sub.add_parser(cmd)
        p.add_argument("name")
        p.add_argument("--sf", required=True, help="folder with the driver tables")
        p.add_argument("--master", default=None, help="e.g. local[8]; omit under spark-submit")
        if cmd == "run":
            p.add_argument("--show", type=int, default=20)
            p.add_argument("--out", default=None)
            p.add_argument("--format", choices=("csv", "parquet"), default="parquet")
    args = ap.parse_args(argv)

    qs = queries()
    if args.cmd == "list":
        for name in sorted(qs):
            print(name)
        return 0
    if args.name not in qs:
        print(f"unknown query {args.name}; try `python -m fieldbook list`", file=sys.stderr)
        return 2
    spark = build_session(args.master)
    with owned(spark):
        df = qs[args.name](spark, args.sf)
        if args.cmd == "explain":
            df.explain("formatted")
        elif args.out:
            if args.format == "csv":
                write_csv(df, args.out)
            else:
                df.write.mode("overwrite").parquet(args.out)
        else:
            df.show(args.show, truncate=False)
    # what the session stored for longer (the survey tables) goes with the session
    return 0


if __name__ == "__main__":
    sys.exit(main())
