"""Runs a query and its SQL side by side and says how they differ."""

from __future__ import annotations

import glob
import os

import duckdb
import numpy as np
import pandas as pd


def connect(sf_dir: str):
    con = duckdb.connect()
    for p in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM read_parquet('{p}')")
    return con


def canon(v):
    if isinstance(v, (list, tuple, np.ndarray)):
        return tuple(canon(x) for x in v)
    if isinstance(v, dict):
        return tuple((k, canon(x)) for k, x in sorted(v.items()))
    if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and v != v):
        return None
    if isinstance(v, (bool, np.bool_)):
        return bool(v)
    if isinstance(v, (int, np.integer)):
        return int(v)
    if isinstance(v, (float, np.floating)):
        return round(float(v), 6)
    return str(v)


def rows(pdf: pd.DataFrame) -> list[tuple]:
    pdf = pdf[sorted(pdf.columns)]
    return sorted((tuple(canon(v) for v in r) for r in pdf.itertuples(index=False)), key=repr)


def difference(spark_df, sql: str, sf_dir: str, con=None) -> str:
    a, b = spark_df.toPandas(), (con or connect(sf_dir)).execute(sql).df()
    if sorted(a.columns) != sorted(b.columns):
        return f"columns {sorted(a.columns)} and {sorted(b.columns)}"
    x, y = rows(a), rows(b)
    if x == y:
        return ""
    only_x, only_y = [r for r in x if r not in set(y)][:3], [r for r in y if r not in set(x)][:3]
    return f"{len(x)} and {len(y)} rows; only Spark {only_x}; only SQL {only_y}"
