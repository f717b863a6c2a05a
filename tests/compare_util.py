"""Spark vs DuckDB comparison used by the tests (row count, column names,
order-insensitive value hash)."""

from __future__ import annotations

import datetime as dt
import hashlib
import math
import os

EXACT = os.environ.get("WXMESH_EXACT_FLOATS", "1") == "1"   # compare floats bit for bit by default

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(v) if EXACT else repr(round(v, 6))
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (int, str, bool)):
        return repr(v)
    return repr(v)


def digest(columns, rows) -> tuple[int, str]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("|".join(str(_norm(r[i])) for i in order) for r in rows)
    return len(lines), hashlib.sha256("\n".join(lines).encode()).hexdigest()


def compare(spark_df, con, sql: str):
    s_cols = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    s_n, s_h = digest(s_cols, s_rows)
    d_n, d_h = digest(d_cols, d_rows)
    return {
        "rows": (s_n, d_n), "columns_match": sorted(s_cols) == sorted(d_cols),
        "hash_match": s_h == d_h, "spark_cols": s_cols, "duck_cols": d_cols,
        "ok": s_n == d_n and sorted(s_cols) == sorted(d_cols) and s_h == d_h,
        "s_rows": s_rows, "d_rows": d_rows,
    }
