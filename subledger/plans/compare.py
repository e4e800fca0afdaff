"""Side-by-side check of a Spark result against DuckDB SQL on the driver tables."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os

DRIVER_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
                 "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duckdb_connection(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in DRIVER_TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"create view {t} as select * from read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _key(row):
    return tuple((x is None, str(type(x)), x if x is not None else 0) for x in row)


def compare(spark_df, sql: str, con) -> dict:
    """Row count, column names and order-insensitive values of both sides."""
    s_cols = spark_df.columns
    s_rows = [tuple(_norm(r[c]) for c in sorted(s_cols)) for r in spark_df.collect()]
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_raw = res.fetchall()
    idx = {c: i for i, c in enumerate(d_cols)}
    out = {"spark_rows": len(s_rows), "oracle_rows": len(d_raw),
           "columns_match": sorted(s_cols) == sorted(d_cols), "spark_cols": s_cols, "oracle_cols": d_cols}
    if not out["columns_match"]:
        out["match"] = False
        return out
    d_rows = [tuple(_norm(r[idx[c]]) for c in sorted(s_cols)) for r in d_raw]
    s_sorted, d_sorted = sorted(s_rows, key=_key), sorted(d_rows, key=_key)
    out["match"] = s_sorted == d_sorted
    if not out["match"]:
        diff_s = [r for r in s_sorted if r not in set(d_sorted)][:3]
        diff_d = [r for r in d_sorted if r not in set(s_sorted)][:3]
        out["sample_spark_only"], out["sample_oracle_only"] = diff_s, diff_d
    return out
