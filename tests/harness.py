"""Spark-vs-DuckDB comparison used by the tests and by hand:

    python tests/harness.py [sf_dir] [key ...]

Rows are compared as sorted multisets after normalising values, columns by name.
"""

from __future__ import annotations

import datetime as dt
import decimal
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def norm(v):
    if isinstance(v, decimal.Decimal):
        return ("D", format(v.normalize(), "f") if v == v else "nan")
    if isinstance(v, float):
        return ("F", round(v, 6))
    if isinstance(v, dt.datetime):
        return ("T", v.replace(tzinfo=None).isoformat())
    if isinstance(v, dt.date):
        return ("d", v.isoformat())
    if isinstance(v, bool):
        return ("b", v)
    if isinstance(v, int):
        return ("i", v)
    if v is None:
        return ("n", "")
    return ("s", str(v))


def compare(spark, con, key: str, sf_dir: str, fn, sql: str) -> tuple[bool, str]:
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    cur = con.execute(sql)
    d_cols = [c[0] for c in cur.description]
    d_rows = cur.fetchall()
    if sorted(s_cols) != sorted(d_cols):
        return False, f"columns differ: spark={sorted(s_cols)} duck={sorted(d_cols)}"
    order = sorted(range(len(s_cols)), key=lambda i: s_cols[i])
    d_index = {c: i for i, c in enumerate(d_cols)}
    s_norm = sorted(tuple(norm(r[i]) for i in order) for r in s_rows)
    d_norm = sorted(tuple(norm(r[d_index[s_cols[i]]]) for i in order) for r in d_rows)
    if len(s_norm) != len(d_norm):
        return False, f"row count spark={len(s_norm)} duck={len(d_norm)}"
    if s_norm != d_norm:
        diff = [(a, b) for a, b in zip(s_norm, d_norm) if a != b][:2]
        names = [s_cols[i] for i in order]
        return False, f"values differ ({len(s_norm)} rows); cols={names}; first: {diff}"
    return True, f"{len(s_norm)} rows, spark {t1 - t0:.1f}s"


def main(argv: list[str]) -> int:
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    keys = argv[2:]
    from cloudcost.session import build_session
    import __spark_entry__ as E
    spark = build_session("local[8]")
    con = duck(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for k in (keys or list(qs)):
        if k not in sqls:
            print(f"SKIP {k}: no oracle")
            continue
        try:
            ok, msg = compare(spark, con, k, sf_dir, qs[k], sqls[k])
        except Exception as e:  # noqa: BLE001
            ok, msg = False, f"ERROR {type(e).__name__}: {str(e)[:600]}"
        bad += not ok
        print(("OK  " if ok else "FAIL") + f" {k}: {msg}", flush=True)
    print(f"{len(keys or qs) - bad} ok, {bad} failed")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
