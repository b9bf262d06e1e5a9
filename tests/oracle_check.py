"""Compare registered Spark queries with their DuckDB oracle, the way the
driver's correctness gate does: row count, column names, and an
order-insensitive hash of the values (columns sorted by name).

Usage: python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(v) if os.environ.get("ORACLE_EXACT") else repr(round(v, 6))
    if isinstance(v, decimal.Decimal):
        return repr(float(v)) if os.environ.get("ORACLE_EXACT") else repr(round(float(v), 6))
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (dt.date, bool, int, str)):
        return str(v)
    return str(v)


def digest(columns, rows) -> tuple[int, str]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    h = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return len(rows), h


def check(spark, con, sf_dir, name, q, sql):
    t0 = time.time()
    df = q(spark, sf_dir)
    srows = [tuple(r) for r in df.collect()]
    scols = df.columns
    t1 = time.time()
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    n1, h1 = digest(scols, srows)
    n2, h2 = digest(dcols, drows)
    ok = sorted(scols) == sorted(dcols) and n1 == n2 and h1 == h2
    detail = ""
    if not ok:
        if sorted(scols) != sorted(dcols):
            detail = f"cols spark-only={set(scols)-set(dcols)} duck-only={set(dcols)-set(scols)}"
        else:
            order_s = sorted(range(len(scols)), key=lambda i: scols[i])
            order_d = sorted(range(len(dcols)), key=lambda i: dcols[i])
            a = sorted("|".join(_norm(r[i]) for i in order_s) for r in srows)
            b = sorted("|".join(_norm(r[i]) for i in order_d) for r in drows)
            sa, sb = set(a), set(b)
            detail = f"rows {n1} vs {n2}; spark-only e.g. {list(sa - sb)[:2]} duck-only e.g. {list(sb - sa)[:2]}"
    return ok, n1, n2, t1 - t0, detail


def main(argv):
    from __spark_entry__ import oracle_sql, queries
    from tallyward.session import build_session

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    only = set(argv[2:])
    if os.environ.get("ORACLE_PLAIN_SESSION"):
        from pyspark.sql import SparkSession

        spark = SparkSession.builder.master("local[*]").getOrCreate()
    else:
        spark = build_session()
    con = duck(sf_dir)
    qs, sqls = queries(), oracle_sql()
    bad = 0
    for name, q in qs.items():
        if only and name not in only:
            continue
        if name not in sqls:
            df = q(spark, sf_dir)
            print(f"{'ROWS':5} {name:34} rows={df.count()} (no oracle)")
            continue
        ok, n1, n2, secs, detail = check(spark, con, sf_dir, name, q, sqls[name])
        bad += not ok
        print(f"{'OK' if ok else 'FAIL':5} {name:34} rows={n1}/{n2} {secs:.1f}s {detail}")
    print("mismatches:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
