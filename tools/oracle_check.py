"""Run registered queries in Spark and their oracle SQL in DuckDB; compare.

Usage: python tools/oracle_check.py [sf_dir] [name ...]

Compares row count, column names and the multiset of rows (columns sorted
by name, values normalised: floats to 9 significant digits, decimals and
dates as text).  Queries that sort are compared in order: DuckDB sorts its rows
by the same keys (text without case and trailing blanks, NULL first), the
sequence of keys must agree, and rows of equal keys are compared as a set.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from care_analytics.sources import fixtures  # noqa: E402


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return float(f"{v:.9g}")
    if isinstance(v, decimal.Decimal):
        return float(f"{float(v):.9g}")
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, dt.date):
        return dt.datetime(v.year, v.month, v.day).isoformat(sep=" ")
    if isinstance(v, int):
        return v
    return str(v)


def rows_multiset(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(norm(r[i]) for i in order) for r in rows)


def in_order(sql: str, keys: list[str]) -> str:
    """``sql`` sorted by ``keys`` as the source dialect sorts."""
    def key(k: str) -> str:
        return f"CASE WHEN typeof(\"{k}\") = 'VARCHAR' THEN lower(rtrim(\"{k}\"::VARCHAR, ' ')) END NULLS FIRST, CASE WHEN typeof(\"{k}\") <> 'VARCHAR' THEN \"{k}\" END NULLS FIRST"
    return f"SELECT * FROM ({sql}) ORDER BY {', '.join(map(key, keys))}"


def runs(columns, rows, keys: list[str]):
    """Runs of rows with equal sort keys: (key, multiset of rows), one after the other."""
    at = [columns.index(k) for k in keys]
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = []
    for row in rows:
        key = tuple(row[i].rstrip(" ").lower() if isinstance(row[i], str) else norm(row[i]) for i in at)
        if not out or out[-1][0] != key:
            out.append((key, Counter()))
        out[-1][1][tuple(norm(row[i]) for i in order)] += 1
    return out


def duck_connection(sf_dir: str):
    con = duckdb.connect()
    for name in fixtures.DRIVER_TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def check(spark, sf_dir: str, names=None, verbose=True):
    from care_analytics.plans.suite import ORDERS, all_queries
    from care_analytics.sources.catalog import Tables
    queries = all_queries()
    con = duck_connection(sf_dir)
    results = {}
    for name, (build, oracle) in queries.items():
        if names and name not in names:
            continue
        t0 = time.time()
        try:
            df = build(Tables.from_driver(spark, sf_dir))
            s_cols = df.columns
            s_rows = [tuple(r) for r in df.collect()]
            t1 = time.time()
            if oracle is None:
                results[name] = ("rows-only", len(s_rows))
                if verbose:
                    print(f"{name:40s} rows-only {len(s_rows)}", flush=True)
                continue
            sql = fixtures.oracle_prefix(oracle)
            cur = con.execute(in_order(sql, ORDERS[name]) if name in ORDERS else sql)
            d_cols = [d[0] for d in cur.description]
            d_rows = cur.fetchall()
            ok_cols = sorted(s_cols) == sorted(d_cols)
            ok_n = len(s_rows) == len(d_rows)
            ok_v = ok_cols and rows_multiset(s_cols, s_rows) == rows_multiset(d_cols, d_rows)
            if ok_v and name in ORDERS:
                ok_v = runs(s_cols, s_rows, ORDERS[name]) == runs(d_cols, d_rows, ORDERS[name])
            status = "OK" if (ok_cols and ok_n and ok_v) else "MISMATCH"
            results[name] = (status, len(s_rows), len(d_rows))
            if verbose:
                print(f"{name:40s} {status:8s} spark={len(s_rows)} duck={len(d_rows)} "
                      f"cols={'ok' if ok_cols else (sorted(s_cols), sorted(d_cols))} "
                      f"t={t1 - t0:.2f}s", flush=True)
                if status != "OK" and ok_cols:
                    a = rows_multiset(s_cols, s_rows)
                    b = rows_multiset(d_cols, d_rows)
                    print("   spark-only:", list((a - b).items())[:3])
                    print("   duck-only: ", list((b - a).items())[:3])
        except Exception as exc:  # report and go on
            results[name] = ("ERROR", repr(exc)[:500])
            if verbose:
                print(f"{name:40s} ERROR {repr(exc)[:500]}", flush=True)
    return results


if __name__ == "__main__":
    from care_analytics.session import local_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    sel = sys.argv[2:] or None
    res = check(local_session(), sf, sel)
    bad = {k: v for k, v in res.items() if v[0] not in ("OK", "rows-only")}
    print(f"{len(res) - len(bad)}/{len(res)} ok; bad: {sorted(bad)}")
