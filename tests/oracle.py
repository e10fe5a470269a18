"""Compare queries with their oracle SQL: ``python tests/oracle.py [sf_dir] [name ...]``."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "NULL"
    if isinstance(v, bool):
        return str(int(v))
    if isinstance(v, (float, decimal.Decimal)):
        return f"{float(v):.6g}"
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    return str(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(cell(r[i]) for i in order) for r in rows)


def compare(df, con, sql: str) -> tuple[bool, str]:
    rel = con.sql(sql)
    cols, want = list(rel.columns), rel.fetchall()
    got = [tuple(r) for r in df.collect()]
    if sorted(cols) != sorted(df.columns):
        return False, f"columns differ: only oracle {sorted(set(cols) - set(df.columns))}, only spark {sorted(set(df.columns) - set(cols))}"
    a, b = rows_of(df.columns, got), rows_of(cols, want)
    if len(a) != len(b):
        return False, f"{len(a)} rows, oracle {len(b)}"
    for x, y in zip(a, b):
        if x != y:
            diff = [(c, p, q) for c, p, q in zip(sorted(cols), x, y) if p != q]
            return False, f"first difference {diff[:4]} in {x[:6]}"
    return True, f"{len(a)} rows"


def main(argv):
    import __spark_entry__ as entry
    from wardflow.session import local_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark, con = local_session("8"), connect(sf_dir)
    queries, oracle = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in argv[1:] or queries:
        t0 = time.time()
        try:
            df = queries[name](spark, sf_dir)
            if name in oracle:
                ok, text = compare(df, con, oracle[name])
            else:
                ok, text = True, f"{df.count()} rows (no oracle)"
        except Exception as e:  # report and go on
            ok, text = False, f"{type(e).__name__}: {str(e)[:600]}"
        bad += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name:28s} {time.time() - t0:6.2f}s {text}", flush=True)
    print(f"{bad} failed")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
