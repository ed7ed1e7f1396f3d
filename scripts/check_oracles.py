"""Run every registered query and its DuckDB oracle; compare like the driver does.

usage: python scripts/check_oracles.py [sf_dir] [name ...]

Runs every query in one session (like the driver).  CHECK_DRIVER_MEMORY sets the
driver heap (default: Spark's 1 GB) to test memory headroom.
"""
from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from curata.plans.catalog import oracle_sql, queries  # noqa: E402
from curata.plans.tables import TABLES  # noqa: E402
from curata.session import build_session  # noqa: E402


def norm(v):
    if isinstance(v, float):
        return repr(v)
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, norm(x)) for k, x in v.items()))
    return v


def rows(cols, data):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(norm(r[i]) for i in order) for r in data), key=repr)


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = set(sys.argv[2:])
    spark = build_session("local[8]", shuffle_partitions=8,
                          driver_memory=os.environ.get("CHECK_DRIVER_MEMORY"))
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    qs, ors = queries(), oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if only and name not in only:
            continue
        t0 = time.time()
        try:
            df = fn(spark, sf)
            cols = df.columns
            got = [tuple(r) for r in df.collect()]
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: spark error {type(e).__name__}: {str(e)[:400]}")
            bad += 1
            continue
        dt = time.time() - t0
        if name not in ors:
            print(f"ROWS {name}: {len(got)} rows (no oracle) {dt:.1f}s")
            continue
        try:
            cur = con.execute(ors[name])
            ocols = [d[0] for d in cur.description]
            exp = cur.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: oracle error {str(e)[:400]}")
            bad += 1
            continue
        if sorted(cols) != sorted(ocols):
            print(f"FAIL {name}: columns {sorted(cols)} vs {sorted(ocols)}")
            bad += 1
            continue
        a, b = rows(cols, got), rows(ocols, exp)
        if a == b:
            print(f"OK   {name}: {len(a)} rows {dt:.1f}s")
        else:
            bad += 1
            sa, sb = set(a), set(b)
            print(f"FAIL {name}: {len(a)} vs {len(b)} rows; spark-only {list(sa - sb)[:3]} oracle-only {list(sb - sa)[:3]}")
    print("failures:", bad)


if __name__ == "__main__":
    main()
