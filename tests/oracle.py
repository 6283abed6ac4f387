"""Spark-vs-DuckDB comparison in the driver's style: column names, row count
and an order-insensitive hash of the values."""

from __future__ import annotations

import datetime as dt
import hashlib
import math
import os

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def canon(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cols = [columns[i] for i in order]
    norm = sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)
    digest = hashlib.sha256(repr(norm).encode()).hexdigest()
    return cols, norm, digest


def compare(spark_df, con, sql):
    s_cols, s_rows, s_hash = canon(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    rel = con.sql(sql)
    d_cols, d_rows, d_hash = canon(rel.columns, rel.fetchall())
    return {
        "columns_match": s_cols == d_cols,
        "rows_spark": len(s_rows),
        "rows_oracle": len(d_rows),
        "hash_match": s_hash == d_hash,
        "spark_cols": s_cols,
        "oracle_cols": d_cols,
        "first_diff": next(((a, b) for a, b in zip(s_rows, d_rows) if a != b), None),
    }
