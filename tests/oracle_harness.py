"""Spark-vs-DuckDB comparison in the spirit of the driver's correctness gate:
row count, column names, and an order-insensitive multiset of rows."""

from __future__ import annotations

import datetime as dt
import decimal
import math
from collections import Counter

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


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
            return "NaN"
        return repr(v)
    if isinstance(v, decimal.Decimal):
        return repr(float(v))
    if isinstance(v, bool):
        return v
    if isinstance(v, int):
        return v
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return str(v)


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [tuple(_norm(r[i]) for i in order) for r in rows], [cols[i] for i in order]


def compare(spark, sf_dir: str, name: str, fn, sql: str | None, con=None, show: int = 5):
    df = fn(spark, sf_dir)
    s_cols = df.columns
    s_rows, s_sorted = rows_of(s_cols, [tuple(r) for r in df.collect()])
    out = {"name": name, "spark_rows": len(s_rows)}
    if sql is None:
        out["status"] = "rows-only"
        return out
    con = con or duck(sf_dir)
    res = con.execute(sql)
    d_cols = [c[0] for c in res.description]
    d_rows, d_sorted = rows_of(d_cols, res.fetchall())
    out["duck_rows"] = len(d_rows)
    if s_sorted != d_sorted:
        out["status"] = f"columns differ: spark={s_sorted} duck={d_sorted}"
        return out
    cs, cd = Counter(s_rows), Counter(d_rows)
    if cs == cd:
        out["status"] = "match"
    else:
        only_s = list((cs - cd).elements())[:show]
        only_d = list((cd - cs).elements())[:show]
        out["status"] = "values differ"
        out["cols"] = s_sorted
        out["only_spark"] = only_s
        out["only_duck"] = only_d
    return out
