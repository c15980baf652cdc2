"""Run ``queries()`` against ``oracle_sql()`` the way the driver's correctness gate does:
row count, column names (sorted) and an order-insensitive hash of normalised values.

Usage: ``python tests/oracle_check.py [sf_dir] [name ...]``
"""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NULL"
        if math.isinf(v):
            return "inf" if v > 0 else "-inf"
        return f"{v:.6f}"
    if isinstance(v, decimal.Decimal):
        return f"{float(v):.6f}"
    if isinstance(v, bool):
        return str(int(v))
    if isinstance(v, int):
        return f"{float(v):.6f}" if abs(v) < 2**53 else str(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    return str(v)


def _digest(cols: list[str], rows) -> tuple[int, str]:
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    keys = sorted("\x1f".join(_norm(r[i]) for i in order) for r in rows)
    h = hashlib.sha256()
    for k in keys:
        h.update(k.encode())
        h.update(b"\n")
    return len(keys), h.hexdigest()


def duck_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def compare(spark, name: str, sf_dir: str, con=None) -> dict:
    import __spark_entry__ as se

    con = con or duck_connection(sf_dir)
    t0 = time.time()
    df = se.queries()[name](spark, sf_dir)
    s_cols = df.columns
    s_rows = [tuple(r) for r in df.collect()]
    t1 = time.time()
    sql = se.oracle_sql().get(name)
    out = {"name": name, "spark_rows": len(s_rows), "spark_sec": round(t1 - t0, 2)}
    if sql is None:
        out["status"] = "no-oracle"
        return out
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    out["duck_rows"] = len(d_rows)
    out["cols_match"] = sorted(s_cols) == sorted(d_cols)
    if not out["cols_match"]:
        out["spark_only"] = sorted(set(s_cols) - set(d_cols))
        out["duck_only"] = sorted(set(d_cols) - set(s_cols))
    sn, sh = _digest(list(s_cols), s_rows)
    dn, dh = _digest(d_cols, d_rows)
    out["hash_match"] = sh == dh
    out["status"] = "ok" if (out["cols_match"] and sn == dn and sh == dh) else "MISMATCH"
    if out["status"] != "ok" and out["cols_match"]:
        order_s = sorted(range(len(s_cols)), key=lambda i: s_cols[i])
        order_d = sorted(range(len(d_cols)), key=lambda i: d_cols[i])
        ks = {"\x1f".join(_norm(r[i]) for i in order_s) for r in s_rows}
        kd = {"\x1f".join(_norm(r[i]) for i in order_d) for r in d_rows}
        out["example_spark_only"] = sorted(ks - kd)[:2]
        out["example_duck_only"] = sorted(kd - ks)[:2]
        out["columns"] = sorted(s_cols)
    return out


def main(argv: list[str]) -> int:
    from martsmith.session import build_session

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    import __spark_entry__ as se

    spark = build_session("local[8]", shuffle_partitions=8)
    con = duck_connection(sf_dir)
    bad = 0
    for name in names or list(se.queries()):
        try:
            r = compare(spark, name, sf_dir, con)
        except Exception as e:  # report and continue
            r = {"name": name, "status": "ERROR", "error": repr(e)[:500]}
        if r["status"] != "ok":
            bad += 1
        print(r, flush=True)
    print(f"{bad} not ok")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
