"""Print the formatted physical plan of registered queries.

    python tools/explain.py [--sf DIR] [--mode formatted|simple|cost] name-substring ...
"""

from __future__ import annotations

import argparse
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from fieldbook.plans.registry import queries  # noqa: E402
from fieldbook.session import build_session  # noqa: E402
from fieldbook.sources.roles import forget_tables  # noqa: E402
from fieldbook.sources.store import owned  # noqa: E402


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("--mode", default="formatted")
    ap.add_argument("--run", action="store_true", help="execute first so the adaptive plan is final")
    ap.add_argument("names", nargs="+")
    args = ap.parse_args()
    spark = build_session("local[8]", 8)
    for name, fn in queries().items():
        if not any(s in name for s in args.names):
            continue
        print("=" * 30, name)
        with owned(spark):
            df = fn(spark, args.sf)
            if args.run:
                df.write.format("noop").mode("overwrite").save()
            df.explain(args.mode)
    forget_tables(spark)
    spark.stop()


if __name__ == "__main__":
    main()
