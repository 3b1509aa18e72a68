"""Order-insensitive comparison of a Spark result with a DuckDB oracle result."""
from __future__ import annotations

import datetime as dt
import math

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        if math.isnan(v):
            return "∅"
        return f"{round(v, 6):.6f}"
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat(sep=" ") if isinstance(v, dt.datetime) else v.isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, int):
        return str(v)
    return str(v)


def normalized(columns: list[str], rows: list[tuple]) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cols = [columns[i] for i in order]
    out = sorted(tuple(_norm(r[i]) for i in order) for r in rows)
    return cols, out


def spark_rows(df):
    return [tuple(r) for r in df.collect()]


def compare(df, con, query_sql: str) -> tuple[bool, str]:
    s_cols, s_rows = normalized(df.columns, spark_rows(df))
    rel = con.sql(query_sql)
    d_cols, d_rows = normalized(rel.columns, rel.fetchall())
    if s_cols != d_cols:
        return False, f"columns differ: spark={s_cols} duck={d_cols}"
    if len(s_rows) != len(d_rows):
        return False, f"row counts differ: spark={len(s_rows)} duck={len(d_rows)}"
    for a, b in zip(s_rows, d_rows):
        if a != b:
            return False, f"first differing row: spark={a} duck={b}"
    return True, f"{len(s_rows)} rows match"
