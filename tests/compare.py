"""Order-insensitive comparison of a Spark result with a DuckDB oracle result."""

from __future__ import annotations

import datetime as dt
import hashlib

import duckdb

VIEWS = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in VIEWS:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _norm(v):
    if v is None:
        return "\\N"
    if isinstance(v, float):
        return repr(round(v, 9))
    if isinstance(v, dt.datetime):
        return v.isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, bool):
        return str(v).lower()
    return str(v)


def rows_of_spark(df):
    cols = df.columns
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    rows = [tuple(_norm(r[i]) for i in order) for r in df.collect()]
    return [cols[i] for i in order], sorted(rows)


def rows_of_duck(con, sql):
    rel = con.sql(sql)
    cols = rel.columns
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    rows = [tuple(_norm(r[i]) for i in order) for r in rel.fetchall()]
    return [cols[i] for i in order], sorted(rows)


def digest(rows) -> str:
    h = hashlib.sha256()
    for r in rows:
        h.update("\x1f".join(r).encode())
        h.update(b"\x1e")
    return h.hexdigest()


def compare(df, con, sql) -> dict:
    s_cols, s_rows = rows_of_spark(df)
    d_cols, d_rows = rows_of_duck(con, sql)
    out = {
        "rows_spark": len(s_rows),
        "rows_oracle": len(d_rows),
        "columns_match": s_cols == d_cols,
        "values_match": digest(s_rows) == digest(d_rows),
    }
    if not out["columns_match"]:
        out["columns"] = (s_cols, d_cols)
    elif not out["values_match"]:
        s_only = sorted(set(s_rows) - set(d_rows))[:3]
        d_only = sorted(set(d_rows) - set(s_rows))[:3]
        out["diff"] = {"spark_only": s_only, "oracle_only": d_only, "columns": s_cols}
    out["ok"] = out["columns_match"] and out["values_match"] and len(s_rows) == len(d_rows)
    return out
