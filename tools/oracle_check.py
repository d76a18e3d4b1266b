"""Run registered queries in Spark and their DuckDB twins; compare rows, columns, values.

usage: python tools/oracle_check.py [--sf DIR] [name ...]
Strict compare: column names sorted, row multiset equality with exact float values.
"""

from __future__ import annotations

import argparse
import hashlib
import json
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from quarry.plans.derived import TABLES  # noqa: E402
from quarry.plans.registry import load_all  # noqa: E402
from quarry.session import local_session  # noqa: E402


def canon(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return repr(float(v)) if v != 0 else "0.0"
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(canon(x) for x in v) + "]"
    if isinstance(v, bool):
        return str(int(v))
    return str(v)


def rows_of(pdf):
    cols = sorted(pdf.columns)
    out = []
    for rec in pdf[cols].itertuples(index=False, name=None):
        out.append("|".join(canon(x.item() if hasattr(x, "item") and not hasattr(x, "__len__") else x) for x in rec))
    out.sort()
    return cols, out


def main():
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("--skip-spark", action="store_true")
    ap.add_argument("names", nargs="*")
    args = ap.parse_args()
    reg = load_all()
    names = args.names or [n for n, e in reg.items() if e.sql is not None]
    spark = local_session(8)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{args.sf}/{t}.parquet')")
    summary = {}
    for n in names:
        e = reg[n]
        t0 = time.time()
        try:
            sp = e.build(spark, args.sf).toPandas()
        except Exception as ex:  # noqa: BLE001
            print(f"{n}: SPARK ERROR {str(ex)[:2000]}")
            summary[n] = "spark-error"
            continue
        t1 = time.time()
        sql = e.oracle()
        if sql is None:
            print(f"{n}: rows={len(sp)} (no oracle) spark={t1 - t0:.1f}s cols={list(sp.columns)}")
            summary[n] = "rows-only"
            continue
        try:
            dk = con.execute(sql).df()
        except Exception as ex:  # noqa: BLE001
            print(f"{n}: DUCKDB ERROR {str(ex)[:2000]}")
            summary[n] = "duck-error"
            continue
        t2 = time.time()
        cs, rs = rows_of(sp)
        cd, rd = rows_of(dk)
        ok = cs == cd and rs == rd
        summary[n] = "ok" if ok else "MISMATCH"
        print(f"{n}: {'OK' if ok else 'MISMATCH'} rows spark={len(rs)} duck={len(rd)} "
              f"spark={t1 - t0:.1f}s duck={t2 - t1:.1f}s")
        if not ok:
            if cs != cd:
                print("  cols", cs, cd)
            a, b = set(rs), set(rd)
            print("  spark-only", sorted(a - b)[:5])
            print("  duck-only ", sorted(b - a)[:5])
            print("  dtypes spark", dict(sp.dtypes.astype(str)), "duck", dict(dk.dtypes.astype(str)))
        h = hashlib.md5("\n".join(rs).encode()).hexdigest()[:8]
        print(f"  hash {h}")
    print(json.dumps(summary))
    spark.stop()


if __name__ == "__main__":
    main()
