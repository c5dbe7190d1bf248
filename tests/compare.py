"""Spark-vs-DuckDB comparison in the driver's style (sorted column names,
row count, order-insensitive value hash)."""

from __future__ import annotations

import hashlib
import math

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(round(v, 9) + 0.0)
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (int,)):
        return str(v)
    return str(v)


def digest(cols: list[str], rows: list[tuple]) -> tuple[int, str]:
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(str(_norm(r[i])) for i in order) for r in rows)
    return len(lines), hashlib.sha256("\n".join(lines).encode()).hexdigest()


def compare(spark_df, con, sql: str) -> dict:
    s_cols = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    rel = con.execute(sql)
    d_cols = [d[0] for d in rel.description]
    d_rows = rel.fetchall()
    out = {"cols_match": sorted(s_cols) == sorted(d_cols),
           "spark_cols": sorted(s_cols), "duck_cols": sorted(d_cols)}
    sn, sh = digest(s_cols, s_rows)
    dn, dh = digest(d_cols, d_rows)
    out.update(rows_spark=sn, rows_duck=dn, hash_match=sh == dh)
    if sh != dh:
        order_s = sorted(range(len(s_cols)), key=lambda i: s_cols[i])
        order_d = sorted(range(len(d_cols)), key=lambda i: d_cols[i])
        ls = sorted("|".join(str(_norm(r[i])) for i in order_s) for r in s_rows)
        ld = sorted("|".join(str(_norm(r[i])) for i in order_d) for r in d_rows)
        out["only_spark"] = sorted(set(ls) - set(ld))[:3]
        out["only_duck"] = sorted(set(ld) - set(ls))[:3]
    return out
