"""Compare a Spark query with its DuckDB oracle the way the driver does:
row count, column names, and an order-insensitive hash of the values."""

from __future__ import annotations

import datetime as dt
import hashlib
import math

import duckdb

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 9)
    if isinstance(v, dt.datetime):
        if v.tzinfo is not None:
            v = v.astimezone(dt.timezone.utc).replace(tzinfo=None)
        return v.isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _digest(columns: list[str], rows: list[tuple]) -> tuple[list[str], list[tuple], str]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cols = [columns[i] for i in order]
    norm = sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)
    h = hashlib.sha256(repr(norm).encode()).hexdigest()
    return cols, norm, h


def compare(spark, query, sql: str, sf_dir: str) -> dict:
    sdf = query(spark, sf_dir)
    s_rows = [tuple(r) for r in sdf.collect()]
    s_cols, s_norm, s_hash = _digest(sdf.columns, s_rows)
    res = duck(sf_dir).execute(sql)
    d_cols_raw = [d[0] for d in res.description]
    d_cols, d_norm, d_hash = _digest(d_cols_raw, res.fetchall())
    out = {"rows": len(s_norm), "oracle_rows": len(d_norm), "columns_match": s_cols == d_cols,
           "hash_match": s_hash == d_hash}
    out["ok"] = out["columns_match"] and out["hash_match"] and len(s_norm) == len(d_norm)
    if not out["ok"]:
        out["spark_cols"], out["oracle_cols"] = s_cols, d_cols
        only_s = [r for r in s_norm if r not in set(d_norm)][:3]
        only_d = [r for r in d_norm if r not in set(s_norm)][:3]
        out["only_spark"], out["only_oracle"] = only_s, only_d
    return out
