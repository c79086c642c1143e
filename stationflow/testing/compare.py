"""Spark-versus-DuckDB comparison used by the tests (mirrors the driver's
check: row count, column names, order-insensitive values)."""

from __future__ import annotations

import datetime as dt
import math

import duckdb
import pandas as pd

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def duckdb_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 9)
    if isinstance(v, pd.Timestamp):
        v = v.to_pydatetime().replace(tzinfo=None)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    if isinstance(v, dt.date):
        return dt.datetime(v.year, v.month, v.day)
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        try:
            return _norm(v.item())
        except Exception:
            return v
    return v


def rows(df: pd.DataFrame) -> list[tuple]:
    cols = sorted(df.columns)
    out = [tuple(_norm(r[c]) for c in cols) for r in df.to_dict("records")]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), str(x)) for x in t))


def compare(spark_df, oracle_sql: str, con) -> tuple[bool, str]:
    left = spark_df.toPandas()
    right = con.sql(oracle_sql).df()
    if sorted(left.columns) != sorted(right.columns):
        return False, f"columns differ: {sorted(left.columns)} vs {sorted(right.columns)}"
    if len(left) != len(right):
        return False, f"row counts differ: {len(left)} vs {len(right)}"
    lr, rr = rows(left), rows(right)
    for a, b in zip(lr, rr):
        if a != b:
            return False, f"first differing row: {a} vs {b}"
    return True, f"{len(left)} rows"
