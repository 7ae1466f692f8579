"""Run registered Spark queries and their DuckDB oracles side by side.

Usage: python tools/check_oracles.py [sf_dir] [name ...]
Prints one line per query: OK / MISMATCH / ERROR with row counts and time.
"""

from __future__ import annotations

import math
import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from quire.plans.catalog import ORACLES, QUERIES  # noqa: E402
from quire.session import get_spark  # noqa: E402
from quire.sources.tables import TABLES  # noqa: E402


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        if math.isinf(v):
            return "inf" if v > 0 else "-inf"
        return round(v, 4)
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if hasattr(v, "asDict"):
        return tuple(norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(norm(x) for x in v.values())
    return v


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(spark, con, name, sf_dir):
    t0 = time.time()
    df = QUERIES[name](spark, sf_dir)
    cols = df.columns
    rows = df.collect()
    t1 = time.time()
    if name not in ORACLES:
        return f"ROWS  {name}: spark={len(rows)} ({t1 - t0:.1f}s) no oracle"
    cur = con.execute(ORACLES[name])
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    t2 = time.time()
    if sorted(cols) != sorted(dcols):
        return f"MISMATCH {name}: columns spark={cols} duck={dcols}"
    order = sorted(cols)
    si = [cols.index(c) for c in order]
    di = [dcols.index(c) for c in order]
    a = sorted((tuple(norm(r[i]) for i in si) for r in rows), key=repr)
    b = sorted((tuple(norm(r[i]) for i in di) for r in drows), key=repr)
    if a != b:
        diff_a = [x for x in a if x not in set(b)][:3]
        diff_b = [x for x in b if x not in set(a)][:3]
        return (f"MISMATCH {name}: rows spark={len(a)} duck={len(b)}\n   spark-only {diff_a}\n"
                f"   duck-only {diff_b}")
    return f"OK    {name}: rows={len(a)} spark {t1 - t0:.1f}s duck {t2 - t1:.1f}s"


def main():
    args = sys.argv[1:]
    sf_dir = "/root/testdata/sf0.01"
    if args and args[0].startswith("/"):
        sf_dir, args = args[0], args[1:]
    names = args or sorted(QUERIES)
    spark = get_spark("local[8]", 8, driver_memory="16g")
    con = duck(sf_dir)
    bad = 0
    for n in names:
        try:
            line = compare(spark, con, n, sf_dir)
        except Exception as e:  # noqa: BLE001
            line = f"ERROR {n}: {type(e).__name__}: {str(e)[:400]}"
            traceback.print_exc(limit=2)
        if not line.startswith(("OK", "ROWS")):
            bad += 1
        print(line, flush=True)
    print(f"done: {len(names) - bad}/{len(names)} ok")


if __name__ == "__main__":
    main()
