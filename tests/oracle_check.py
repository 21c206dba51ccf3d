"""Run registered queries in Spark and their oracle SQL in DuckDB; compare.

Comparison: row count, column names (sorted), and the multiset of rows with
columns in name order. Used by tests and as a CLI:

    python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, sf_dir: str, name: str, fn, sql: str | None, con) -> dict:
    t = time.time()
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    out = {"name": name, "spark_rows": len(s_rows), "spark_sec": round(time.time() - t, 2)}
    if sql is None:
        out["status"] = "rows-only"
        return out
    con.execute(f"CREATE OR REPLACE VIEW checked AS {sql}")  # as a gate may do: the SQL has to stand in a view
    rel = con.sql("SELECT * FROM checked")
    d_cols = rel.columns
    d_rows = rel.fetchall()
    out["duck_rows"] = len(d_rows)
    if sorted(s_cols) != sorted(d_cols):
        out["status"] = f"SCHEMA {sorted(s_cols)} != {sorted(d_cols)}"
        return out
    a, b = _rows(s_cols, s_rows), _rows(d_cols, d_rows)
    if len(a) != len(b):
        out["status"] = "COUNT"
    elif a != b:
        diff = [(x, y) for x, y in zip(a, b) if x != y][:2]
        out["status"] = f"VALUES {diff}"
    else:
        out["status"] = "ok"
    return out


def main(argv):
    from __spark_entry__ import oracle_sql, queries
    from weblake.session import build_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:]
    spark = build_session("local[8]")
    con = duck(sf_dir)
    qs, sqls = queries(), oracle_sql()
    bad = 0
    for name in names or qs:
        try:
            r = compare(spark, sf_dir, name, qs[name], sqls.get(name), con)
        except Exception as e:  # noqa: BLE001
            r = {"name": name, "status": f"ERROR {type(e).__name__}: {str(e)[:300]}"}
        bad += r["status"] not in ("ok", "rows-only")
        print(r, flush=True)
    print(f"{len(names or qs) - bad} ok / {bad} failing")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
