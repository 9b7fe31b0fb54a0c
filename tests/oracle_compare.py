"""Run registered queries in Spark and their SQL in DuckDB; compare results.

Mirrors the driver's check: same row count, same column names, same multiset
of rows (order-insensitive). Floats must be equal exactly (``strict``) or to
1e-9 relative (``close``).

CLI: ``python tests/oracle_compare.py [sf_dir] [key ...]``
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

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
    if isinstance(v, decimal.Decimal):
        return int(v) if v == v.to_integral_value() else float(v)
    if isinstance(v, bool):
        return v
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=repr), [cols[i] for i in order]


def _close(a, b):
    if isinstance(a, float) or isinstance(b, float):
        if a is None or b is None:
            return a is b
        if math.isnan(a) and math.isnan(b):
            return True
        return math.isclose(float(a), float(b), rel_tol=1e-9, abs_tol=1e-12)
    if isinstance(a, tuple) and isinstance(b, tuple):
        return len(a) == len(b) and all(_close(x, y) for x, y in zip(a, b))
    return a == b


def compare(spark, con, key, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    res = {"key": key, "spark_rows": len(s_rows), "spark_sec": round(t1 - t0, 2)}
    if sql is None:
        res["status"] = "rows-only"
        return res
    cur = con.execute(sql)
    d_cols = [c[0] for c in cur.description]
    d_rows = cur.fetchall()
    res["duck_rows"] = len(d_rows)
    a, ca = _rows(s_cols, s_rows)
    b, cb = _rows(d_cols, d_rows)
    if ca != cb:
        res["status"] = f"COLUMNS {ca} vs {cb}"
    elif len(a) != len(b):
        res["status"] = "ROWCOUNT"
    elif a == b:
        res["status"] = "strict"
    elif all(_close(x, y) for x, y in zip(a, b)):
        res["status"] = "close"
    else:
        bad = next((x, y) for x, y in zip(a, b) if not _close(x, y))
        res["status"] = f"VALUES e.g. {bad}"
    return res


def main(argv):
    from quarry.session import build_session
    from quarry.plans.registry import ORACLE, QUERIES
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    keys = argv[2:] or list(QUERIES)
    spark = build_session("local[8]", 8)
    con = duck(sf_dir)
    bad = 0
    for k in keys:
        try:
            r = compare(spark, con, k, QUERIES[k], ORACLE.get(k), sf_dir)
        except Exception as e:  # report and continue
            r = {"key": k, "status": f"ERROR {type(e).__name__}: {str(e)[:300]}"}
        if r["status"] not in ("strict", "close", "rows-only"):
            bad += 1
        print(r, flush=True)
    spark.stop()
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
