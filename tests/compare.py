"""Spark result vs DuckDB oracle: row count, column names, values.

Used by the oracle tests and by ``check_oracle.py``. Values are compared as
an order-insensitive multiset of rows with columns sorted by name; floats are
compared after rounding to 6 decimals, dates and decimals as text.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
from collections import Counter

import duckdb

TABLES = [
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
    "documents",
    "embeddings",
    "pages",
    "benchmark",
    "labels",
    "conversations",
]


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
            return None
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return v


def spark_rows(df):
    cols = sorted(df.columns)
    return cols, [tuple(_norm(r[c]) for c in cols) for r in df.collect()]


def duck_rows(con, sql):
    rel = con.sql(sql)
    names = rel.columns
    order = sorted(range(len(names)), key=lambda i: names[i])
    cols = [names[i] for i in order]
    return cols, [tuple(_norm(r[i]) for i in order) for r in rel.fetchall()]


def compare(df, con, sql) -> dict:
    s_cols, s_rows = spark_rows(df)
    d_cols, d_rows = duck_rows(con, sql)
    same_cols = s_cols == d_cols
    sc, dc = Counter(s_rows), Counter(d_rows)
    only_spark = list((sc - dc).elements())[:3]
    only_duck = list((dc - sc).elements())[:3]
    return {
        "rows_spark": len(s_rows),
        "rows_duck": len(d_rows),
        "columns_match": same_cols,
        "spark_cols": s_cols,
        "duck_cols": d_cols,
        "values_match": same_cols and sc == dc,
        "only_spark": only_spark,
        "only_duck": only_duck,
    }
