"""Run a registered Spark query and its oracle SQL on the same parquet tables
and compare row count, column names and an order-insensitive value hash."""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import math

from settlebook.sources.tables import DRIVER_TABLES


def duckdb_connection(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _canon(v) -> str:
    if v is None:
        return "NULL"
    try:
        import pandas as pd
        if v is pd.NaT:
            return "NULL"
        if isinstance(v, pd.Timestamp):
            return v.isoformat(sep=" ")
    except ImportError:  # pragma: no cover
        pass
    if isinstance(v, float):
        if math.isnan(v):
            return "NULL"
        return str(int(v)) if v.is_integer() else repr(round(v, 6))
    if isinstance(v, decimal.Decimal):
        return _canon(float(v))
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat(sep=" ") if isinstance(v, dt.datetime) else v.isoformat()
    if hasattr(v, "item"):
        return _canon(v.item())
    return str(v)


def _rows(columns, records) -> list[str]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted("|".join(_canon(r[i]) for i in order) for r in records)


def digest(columns, records) -> str:
    h = hashlib.sha256()
    for r in _rows(columns, records):
        h.update(r.encode())
        h.update(b"\n")
    return h.hexdigest()


def compare(spark, name: str, query, sql: str, sf_dir: str, con=None) -> dict:
    sdf = query(spark, sf_dir)
    s_cols = list(sdf.columns)
    s_rows = [tuple(r) for r in sdf.collect()]
    con = con or duckdb_connection(sf_dir)
    cur = con.execute(sql)
    d_cols = [c[0] for c in cur.description]
    d_rows = [tuple(r) for r in cur.fetchall()]
    out = {
        "name": name,
        "spark_rows": len(s_rows),
        "oracle_rows": len(d_rows),
        "columns_match": sorted(s_cols) == sorted(d_cols),
        "hash_match": digest(s_cols, s_rows) == digest(d_cols, d_rows),
    }
    if not out["columns_match"]:
        out["spark_columns"], out["oracle_columns"] = s_cols, d_cols
    elif not out["hash_match"]:
        a, b = set(_rows(s_cols, s_rows)), set(_rows(d_cols, d_rows))
        out["only_spark"] = sorted(a - b)[:3]
        out["only_oracle"] = sorted(b - a)[:3]
    out["ok"] = out["columns_match"] and out["hash_match"] and out["spark_rows"] == out["oracle_rows"]
    return out
