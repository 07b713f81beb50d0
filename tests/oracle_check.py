"""Compare registered Spark queries with their DuckDB oracles.

Mirrors the driver's check: row count, column names (sorted) and an
order-insensitive comparison of the values.  Usable from pytest and as a
script: ``python tests/oracle_check.py [sf_dir] [name ...]``.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations"]


def duck_connection(sf_dir: str):
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
            return "nan"
        return repr(round(v, 9))
    if isinstance(v, decimal.Decimal):
        return str(v.normalize()) if v == v else "nan"
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (bytes, bytearray)):
        return bytes(v).hex()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v if isinstance(v, (str, bool, int)) else str(v)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


def compare(spark, con, name, query, sql, sf_dir):
    t0 = time.time()
    sdf = query(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    res = {"name": name, "spark_rows": len(s_rows), "spark_sec": round(t1 - t0, 2)}
    if sql is None:
        res["status"] = "rows-only"
        return res
    cur = con.execute(sql)
    d_cols = [d[0] for d in cur.description]
    d_rows = cur.fetchall()
    res["duck_rows"] = len(d_rows)
    if sorted(s_cols) != sorted(d_cols):
        res["status"] = "COLUMNS"
        res["detail"] = (sorted(set(s_cols) - set(d_cols)), sorted(set(d_cols) - set(s_cols)))
        return res
    a, b = _rows(s_cols, s_rows), _rows(d_cols, d_rows)
    if a == b:
        res["status"] = "ok"
    else:
        res["status"] = "VALUES" if len(a) == len(b) else "ROWCOUNT"
        sa, sb = set(a), set(b)
        res["only_spark"] = list(sa - sb)[:3]
        res["only_duck"] = list(sb - sa)[:3]
        res["cols"] = sorted(s_cols)
    return res


def main(argv):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as entry
    from millrace.session import build_session
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in argv[1:] if not a.startswith("/")]
    spark = build_session(shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    con = duck_connection(sf_dir)
    qs, oracles = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in names or list(qs):
        try:
            r = compare(spark, con, name, qs[name], oracles.get(name), sf_dir)
        except Exception as exc:  # report and continue
            r = {"name": name, "status": "ERROR", "detail": f"{type(exc).__name__}: {str(exc)[:600]}"}
        bad += r["status"] not in ("ok", "rows-only")
        print(r, flush=True)
    print(f"{bad} failing of {len(names or qs)}")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
