"""Local stand-in for the driver's correctness gate.

Runs every registered query on Spark and its oracle SQL on DuckDB over the
same Parquet tables, then compares row counts, column names and an
order-insensitive hash of the values (columns sorted by name).

    python tools/oracle_check.py [--sf /root/testdata/sf0.01] [name-substring ...]
"""

from __future__ import annotations

import argparse
import datetime as dt
import decimal
import hashlib
import json
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from fieldbook.plans.registry import oracle_sql, queries  # noqa: E402
from fieldbook.session import build_session  # noqa: E402
from fieldbook.sources.tables import NATIVE_TABLES, table_path  # noqa: E402


def canon(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NULL"
        return f"{v:.6f}"
    if isinstance(v, decimal.Decimal):
        return f"{float(v):.6f}"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, int):
        return str(v)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return str(v)


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                 "timestamp_ntz": "TIMESTAMP", "date": "DATE", "boolean": "BOOLEAN", "smallint": "SMALLINT",
                 "float": "FLOAT", "tinyint": "TINYINT"}


def type_diffs(scols, stypes, ocols, otypes):
    duck = dict(zip(ocols, otypes))
    out = []
    for c, t in zip(scols, stypes):
        want = SPARK_TO_DUCK.get(t, t)
        if c in duck and duck[c] != want:
            out.append((c, t, duck[c]))
    return out


def digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(canon(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()[:16], lines


def main():
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("--partitions", type=int, default=8)
    ap.add_argument("names", nargs="*")
    args = ap.parse_args()

    spark = build_session("local[8]", args.partitions)
    con = duckdb.connect()
    for t in NATIVE_TABLES:
        p = table_path(args.sf, t)
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    qs, sqls = queries(), oracle_sql()
    results = {}
    for name, fn in qs.items():
        if args.names and not any(s in name for s in args.names):
            continue
        rec = {}
        t0 = time.time()
        try:
            df = fn(spark, args.sf)
            srows = [tuple(r) for r in df.collect()]
            scols = df.columns
            stypes = [f.dataType.simpleString() for f in df.schema.fields]
        except Exception as e:  # noqa: BLE001
            rec["status"] = f"SPARK ERROR {type(e).__name__}: {str(e)[:300]}"
            results[name] = rec
            print(name, rec["status"], flush=True)
            continue
        rec["spark_sec"] = round(time.time() - t0, 2)
        rec["rows"] = len(srows)
        if name not in sqls:
            rec["status"] = "no oracle"
            results[name] = rec
            print(f"{name:40s} rows={len(srows):6d} NO ORACLE", flush=True)
            continue
        try:
            cur = con.execute(sqls[name])
            orows = cur.fetchall()
            ocols = [d[0] for d in cur.description]
            otypes = [str(d[1]) for d in cur.description]
        except Exception as e:  # noqa: BLE001
            rec["status"] = f"DUCKDB ERROR {e}"[:300]
            results[name] = rec
            print(name, rec["status"], flush=True)
            continue
        sh, sl = digest(scols, srows)
        oh, ol = digest(ocols, orows)
        ok = len(srows) == len(orows) and sorted(scols) == sorted(ocols) and sh == oh
        rec["status"] = "OK" if ok else "MISMATCH"
        rec["types"] = list(zip(scols, stypes))
        td = type_diffs(scols, stypes, ocols, otypes)
        if td:
            rec["type_diffs"] = td
            print("   TYPE DIFF", td)
        print(f"{name:40s} rows={len(srows):6d}/{len(orows):6d} {rec['status']} {rec['spark_sec']}s", flush=True)
        if not ok:
            if sorted(scols) != sorted(ocols):
                print("   cols spark", scols, "\n   cols duck ", ocols)
            diff_s = [x for x in sl if x not in set(ol)][:3]
            diff_o = [x for x in ol if x not in set(sl)][:3]
            print("   spark-only", diff_s, "\n   duck-only ", diff_o)
            print("   types", list(zip(scols, stypes)), list(zip(ocols, otypes)))
        results[name] = rec
    bad = [k for k, v in results.items() if v["status"] not in ("OK", "no oracle")]
    typed = [k for k, v in results.items() if v.get("type_diffs")]
    print(json.dumps({"checked": len(results), "bad": bad, "type_diffs": typed}))
    spark.stop()


if __name__ == "__main__":
    main()
