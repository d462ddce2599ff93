"""Run registered queries against their DuckDB oracles (row count, columns, values).

Usage: python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
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
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return float(v)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def rows_of(columns, tuples):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_norm(r[i]) for i in order) for r in tuples]
    return sorted(out, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = rows_of(s_cols, [tuple(r) for r in sdf.collect()])
    t1 = time.time()
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = rows_of(d_cols, res.fetchall())
    ok_cols = sorted(s_cols) == sorted(d_cols)
    ok_n = len(s_rows) == len(d_rows)
    ok_v = s_rows == d_rows
    diff = []
    if not ok_v:
        ss, dd = set(s_rows), set(d_rows)
        diff = [("spark_only", r) for r in list(ss - dd)[:3]] + [("oracle_only", r) for r in list(dd - ss)[:3]]
    return dict(name=name, cols=ok_cols, rows=(len(s_rows), len(d_rows)), values=ok_v, sec=round(t1 - t0, 2), diff=diff,
                s_cols=s_cols, d_cols=d_cols)


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in argv[1:] if not a.startswith("/")]
    import __spark_entry__ as E
    from mapweave.session import local_session

    spark = local_session()
    con = duck(sf_dir)
    qs, oracles = E.queries(), E.oracle_sql()
    bad = 0
    for name in names or list(qs):
        if name not in oracles:
            n = qs[name](spark, sf_dir).count()
            print(f"{name:28s} rows-only {n}")
            continue
        r = compare(spark, con, name, qs[name], oracles[name], sf_dir)
        ok = r["cols"] and r["values"]
        bad += not ok
        print(f"{name:28s} {'OK ' if ok else 'BAD'} rows={r['rows']} {r['sec']}s", "" if ok else (r["diff"], r["s_cols"], r["d_cols"]))
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv))
