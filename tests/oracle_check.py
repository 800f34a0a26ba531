"""Run registered queries and their DuckDB oracle side by side.

Compares row count, column names and an order-insensitive value hash (columns
sorted by name), the way the correctness gate does. Usable from pytest and
from the command line::

    python tests/oracle_check.py /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import hashlib
import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
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
        return repr(float(v))
    if hasattr(v, "is_integer") and not isinstance(v, (int, bool)):  # Decimal
        return repr(float(v))
    return str(v)


def _is_null(v) -> bool:
    try:
        return v is None or (isinstance(v, float) and math.isnan(v)) or bool(v != v)
    except Exception:
        return False


def digest(columns: list[str], rows: list[tuple]) -> str:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("\x1f".join(str(_norm(None if _is_null(r[i]) else r[i])) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


def compare(spark, sf_dir: str, name: str, query, sql: str, con=None) -> dict:
    con = con or duck(sf_dir)
    t0 = time.time()
    sdf = query(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = [tuple(r) for r in res.fetchall()]
    out = {
        "name": name, "spark_rows": len(s_rows), "oracle_rows": len(d_rows),
        "columns_match": sorted(s_cols) == sorted(d_cols),
        "hash_match": digest(s_cols, s_rows) == digest(d_cols, d_rows),
        "spark_sec": round(t1 - t0, 2),
    }
    if not out["columns_match"]:
        out["spark_only"] = sorted(set(s_cols) - set(d_cols))
        out["oracle_only"] = sorted(set(d_cols) - set(s_cols))
    out["ok"] = out["columns_match"] and out["hash_match"] and len(s_rows) == len(d_rows)
    return out


def main(argv: list[str]) -> int:
    from __spark_entry__ import oracle_sql, queries
    from fieldbook.session import get_session

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:] or list(queries())
    spark = get_session("local[8]", 8)
    con = duck(sf_dir)
    qs, sqls = queries(), oracle_sql()
    bad = 0
    for name in names:
        if name not in sqls:
            print(f"{name}: no oracle")
            continue
        try:
            r = compare(spark, sf_dir, name, qs[name], sqls[name], con)
        except Exception as exc:  # report and continue
            r = {"name": name, "ok": False, "error": f"{type(exc).__name__}: {str(exc)[:400]}"}
        bad += 0 if r["ok"] else 1
        print(r, flush=True)
    print(f"{len(names) - bad}/{len(names)} match")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
