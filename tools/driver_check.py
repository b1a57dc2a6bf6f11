"""Run the driver contract the way an outside harness would.

From a scratch working directory, load ``__spark_entry__.py`` by path into a
plain SparkSession (no fieldbook session helpers, repo not on the workers'
path), run ``entry`` and every query, and compare each with its DuckDB
oracle SQL (row count, column names, order-insensitive values).

    python tools/driver_check.py [--sf /root/testdata/sf0.01] [--partitions 8]
"""

from __future__ import annotations

import argparse
import importlib.util
import json
import os
import sys
import tempfile

HERE = os.path.dirname(os.path.abspath(__file__))
REPO = os.path.dirname(HERE)
sys.path.insert(0, HERE)

from oracle_check import digest  # noqa: E402


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("--partitions", default="8")
    args = ap.parse_args()
    os.chdir(tempfile.mkdtemp(prefix="fb-driver-"))

    import duckdb
    from pyspark.sql import SparkSession

    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", args.partitions)
             .config("spark.ui.enabled", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(REPO, "__spark_entry__.py"))
    entry = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(entry)

    smoke = entry.entry(spark)
    print("entry", len(smoke.collect()), smoke.columns, flush=True)

    con = duckdb.connect()
    for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
              "embeddings", "pages", "benchmark", "labels", "conversations"):
        p = os.path.join(args.sf, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    sqls = entry.oracle_sql()
    bad = []
    for name, fn in entry.queries().items():
        try:
            df = fn(spark, args.sf)
            rows = [tuple(r) for r in df.collect()]
            if name not in sqls:
                print(name, len(rows), "rows, no oracle", flush=True)
                continue
            cur = con.execute(sqls[name])
            orows, ocols = cur.fetchall(), [d[0] for d in cur.description]
            ok = (len(rows) == len(orows) and sorted(df.columns) == sorted(ocols)
                  and digest(df.columns, rows)[0] == digest(ocols, orows)[0])
        except Exception as e:  # noqa: BLE001
            ok = False
            print(name, "ERROR", type(e).__name__, str(e)[:200], flush=True)
        if not ok:
            bad.append(name)
    print(json.dumps({"checked": len(entry.queries()), "bad": bad}))
    spark.stop()


if __name__ == "__main__":
    main()
