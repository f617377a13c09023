"""Side-by-side check of a Spark query and its DuckDB SQL (as the driver does)."""

from __future__ import annotations

import math

import duckdb
import pandas as pd

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def rows_of(pdf: pd.DataFrame) -> list[tuple]:
    cols = sorted(pdf.columns)
    out = [tuple(_norm(x) for x in r) for r in pdf[cols].itertuples(index=False, name=None)]
    return sorted(out, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0)
                                           for x in r))


def compare(spark_df, sql: str, con) -> tuple[bool, str]:
    s = spark_df.toPandas()
    d = con.execute(sql).df()
    if sorted(s.columns) != sorted(d.columns):
        return False, f"columns differ: {sorted(s.columns)} vs {sorted(d.columns)}"
    if len(s) != len(d):
        return False, f"row count {len(s)} vs {len(d)}"
    rs, rd = rows_of(s), rows_of(d)
    for a, b in zip(rs, rd):
        if a != b:
            return False, f"first diff: {a} vs {b}"
    return True, f"{len(s)} rows"
