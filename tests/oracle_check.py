"""Compare each registered query with its DuckDB oracle (row count, columns, values).

Usage: python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time
from datetime import date, datetime

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if isinstance(v, datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, date):
        return v.isoformat()
    return v


def _key(row):
    return tuple((x is None, str(type(x).__name__), x if x is not None else 0) for x in row)


def compare(spark, con, name, query, sql, sf_dir):
    t0 = time.time()
    sdf = query(spark, sf_dir)
    scols = sdf.columns
    srows = [tuple(_norm(r[c]) for c in sorted(scols)) for r in sdf.collect()]
    t1 = time.time()
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows_raw = res.fetchall()
    order = sorted(range(len(dcols)), key=lambda i: dcols[i])
    drows = [tuple(_norm(r[i]) for i in order) for r in drows_raw]
    problems = []
    if sorted(scols) != sorted(dcols):
        problems.append(f"columns spark={scols} duck={dcols}")
    if len(srows) != len(drows):
        problems.append(f"rows spark={len(srows)} duck={len(drows)}")
    if not problems:
        a, b = sorted(srows, key=_key), sorted(drows, key=_key)
        diff = [(x, y) for x, y in zip(a, b) if x != y]
        if diff:
            problems.append(f"{len(diff)} differing rows, first: {diff[:2]}")
    return problems, len(srows), t1 - t0


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in argv[1:] if not a.startswith("/")]
    from streammetrics.session import build_session
    import __spark_entry__ as e
    spark = build_session("local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    qs, oracle = e.queries(), e.oracle_sql()
    bad = 0
    for name in names or list(qs):
        if name not in oracle:
            print(f"{name:40s} (no oracle)")
            continue
        problems, n, secs = compare(spark, con, name, qs[name], oracle[name], sf_dir)
        status = "OK " if not problems else "BAD"
        bad += bool(problems)
        print(f"{status} {name:40s} rows={n:<7d} {secs:6.1f}s {'; '.join(problems)}", flush=True)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
