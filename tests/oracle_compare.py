"""Compare a registered Spark query with its DuckDB oracle.

Columns are sorted by name, values brought to a canonical text form and
rows compared as multisets: the same test the correctness gate applies.
Usable from pytest and as a script: ``python tests/oracle_compare.py [sf_dir] [names...]``.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
from collections import Counter

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]


def _canon(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return repr(float(v))
    if isinstance(v, decimal.Decimal):
        return format(v.normalize(), "f")
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, dt.date):
        return dt.datetime(v.year, v.month, v.day).isoformat(sep=" ")
    if hasattr(v, "item"):          # numpy scalar
        return _canon(v.item())
    return str(v)


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [tuple(_canon(r[i]) for i in order) for r in rows], [cols[i] for i in order]


def duck_rows(sf_dir: str, sql: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    return cols, cur.fetchall()


def spark_rows(df):
    cols = df.columns
    return cols, [tuple(r) for r in df.collect()]


def compare(spark, name: str, sf_dir: str):
    """Returns (ok, message)."""
    from stockroom.plans.queries import ORACLE, QUERIES
    s_cols, s_raw = spark_rows(QUERIES[name](spark, sf_dir))
    d_cols, d_raw = duck_rows(sf_dir, ORACLE[name])
    s, s_names = _rows(s_cols, s_raw)
    d, d_names = _rows(d_cols, d_raw)
    if s_names != d_names:
        return False, f"{name}: columns differ\n spark {s_names}\n duck  {d_names}"
    if len(s) != len(d):
        return False, f"{name}: rows spark={len(s)} duck={len(d)}"
    cs, cd = Counter(s), Counter(d)
    if cs != cd:
        only_s = list((cs - cd).elements())[:3]
        only_d = list((cd - cs).elements())[:3]
        return False, f"{name}: values differ ({len(s)} rows)\n spark-only {only_s}\n duck-only  {only_d}"
    return True, f"{name}: ok ({len(s)} rows)"


if __name__ == "__main__":
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from stockroom.plans.queries import QUERIES
    from stockroom.session import build_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = build_session("local[8]", 8)
    bad = 0
    for n in names:
        try:
            ok, msg = compare(spark, n, sf)
        except Exception as e:  # report and go on
            ok, msg = False, f"{n}: ERROR {type(e).__name__}: {str(e)[:500]}"
        bad += not ok
        print(("PASS " if ok else "FAIL ") + msg, flush=True)
    print(f"{len(names) - bad}/{len(names)} passed")
    sys.exit(1 if bad else 0)
