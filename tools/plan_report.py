"""Summarise the executed (adaptive, final) physical plan of every registered query.

    python tools/plan_report.py [--sf DIR] > docs/PLANS.md

Per query: shuffle exchanges, broadcast exchanges, joins by strategy, Parquet
scans and the widest column list a scan reads, and whether Python runs
(``MapInPandas``).  The ordered helpers' one-off passes (visit ordinal,
ranks) run when a query is built, so they show up as a scan of their stored
table, not here.
"""

from __future__ import annotations

import argparse
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from fieldbook.plans.registry import queries  # noqa: E402
from fieldbook.session import build_session  # noqa: E402


def without_cached_plans(plan: str) -> str:
    """Drop the subtree printed under each ``InMemoryRelation``: execution reads the cache instead."""
    out, skip_indent = [], None
    for line in plan.splitlines():
        indent = len(line) - len(line.lstrip(" :+-"))
        if skip_indent is not None:
            if indent > skip_indent:
                continue
            skip_indent = None
        out.append(line)
        if "InMemoryRelation" in line:
            skip_indent = indent
    return "\n".join(out)


def summarise(plan: str) -> dict:
    plan = without_cached_plans(plan)
    joins = re.findall(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|BroadcastNestedLoopJoin|CartesianProduct)", plan)
    read_cols = [m.count(":") for m in re.findall(r"ReadSchema: struct<([^\n>]*)>", plan)]
    return {
        # a subquery is printed wherever it is referenced; count each exchange once by its plan id
        "shuffles": len(set(re.findall(
            r"Exchange (?:hashpartitioning|rangepartitioning|SinglePartition|RoundRobin)[^\n]*\[plan_id=(\d+)\]", plan))),
        "broadcasts": len(set(re.findall(r"BroadcastExchange[^\n]*\[plan_id=(\d+)\]", plan))),
        "joins": ", ".join(f"{j}x{joins.count(j)}" for j in sorted(set(joins))) or "-",
        "scans": plan.count("FileScan parquet"),
        "max_cols": max(read_cols) if read_cols else 0,
        "python": "yes" if "MapInPandas" in plan or "ArrowEvalPython" in plan else "no",
        "cached": plan.count("InMemoryTableScan"),
    }


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    args = ap.parse_args()
    spark = build_session("local[8]", 8)
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")  # untruncated ReadSchema
    print("# Executed plans per query\n")
    print(f"Generated by `tools/plan_report.py` at `{args.sf}` (adaptive plans after execution; "
          "exchanges counted once by plan id; scan and cached-scan columns count printed nodes, so a subquery referenced twice shows its scans twice).\n")
    print("| query | shuffles | broadcasts | joins | parquet scans | cached scans | widest scan (cols) | python |")
    print("| --- | --- | --- | --- | --- | --- | --- | --- |")
    for name, fn in sorted(queries().items()):
        df = fn(spark, args.sf)
        df.write.format("noop").mode("overwrite").save()
        s = summarise(df._jdf.queryExecution().executedPlan().toString())
        print(f"| {name} | {s['shuffles']} | {s['broadcasts']} | {s['joins']} | {s['scans']} | "
              f"{s['cached']} | {s['max_cols']} | {s['python']} |")
    spark.stop()


if __name__ == "__main__":
    main()
