"""Run registered queries in Spark and their SQL twins in DuckDB, compare.

Usage: python tests/oracle_check.py [sf_dir] [name ...]
Prints one line per query: OK / MISMATCH / ERROR with row counts.
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

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir):
    import duckdb
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return f"{v:.15g}" if abs(v) >= 1e9 else f"{round(v, 6):.6f}"  # cents count in large sums too
    if isinstance(v, decimal.Decimal):
        return norm(float(v))
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (dt.date,)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(norm(x) for x in v) + "]"
    return str(v)


def digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()[:16], lines


def compare(spark, name, fn, sql, sf_dir, con, verbose=False):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    scols = sdf.columns
    t1 = time.time()
    if sql is None:
        return f"ROWS   {name:28s} spark={len(srows)} ({t1 - t0:.1f}s)", True
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    if sorted(scols) != sorted(dcols):
        return f"SCHEMA {name:28s} spark={sorted(scols)} duck={sorted(dcols)}", False
    sh, sl = digest(scols, srows)
    dh, dl = digest(dcols, drows)
    ok = sh == dh and len(srows) == len(drows)
    msg = f"{'OK' if ok else 'MISMATCH':6s} {name:28s} rows={len(srows)}/{len(drows)} ({t1 - t0:.1f}s)"
    if not ok and verbose:
        ss, ds = set(sl), set(dl)
        only_s = [x for x in sl if x not in ds][:3]
        only_d = [x for x in dl if x not in ss][:3]
        msg += f"\n   cols={sorted(scols)}\n   spark-only={only_s}\n   duck-only={only_d}"
    return msg, ok


def main():
    args = sys.argv[1:]
    sf_dir = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in args if not a.startswith("/")]
    import __spark_entry__ as E
    from gatekit.session import get_session
    spark = get_session()
    spark.sparkContext.setLogLevel("ERROR")
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for name in names or list(qs):
        try:
            msg, ok = compare(spark, name, qs[name], sqls.get(name), sf_dir, con, verbose=True)
        except Exception as e:  # report and go on
            msg, ok = f"ERROR  {name:28s} {type(e).__name__}: {str(e)[:400]}", False
        bad += not ok
        print(msg, flush=True)
    print(f"done: {len(names or qs) - bad} ok, {bad} not ok")


if __name__ == "__main__":
    main()
