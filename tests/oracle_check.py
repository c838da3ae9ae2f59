"""Spark result vs DuckDB oracle: row count, column names and sorted values."""

from __future__ import annotations

import datetime as dt
import math

import duckdb

RAW_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in RAW_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return f"{v:.6f}"
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    return "" if v is None and False else repr(v) if v is None else str(v)


def normalise(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


def compare(spark, name: str, sf_dir: str, queries, oracle, con=None):
    df = queries[name](spark, sf_dir)
    s_cols = df.columns
    s_rows = [tuple(r) for r in df.collect()]
    con = con or duck(sf_dir)
    res = con.execute(oracle[name])
    d_cols = [c[0] for c in res.description]
    d_rows = res.fetchall()
    return {
        "name": name,
        "spark_rows": len(s_rows), "oracle_rows": len(d_rows),
        "columns_match": sorted(s_cols) == sorted(d_cols),
        "values_match": normalise(s_rows, s_cols) == normalise(d_rows, d_cols),
        "spark_cols": s_cols, "oracle_cols": d_cols,
        "_s": normalise(s_rows, s_cols), "_d": normalise(d_rows, d_cols),
    }
