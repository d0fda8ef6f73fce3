"""Compares a query with its SQL in DuckDB over the same tables: columns by name, rows without order."""

import glob
import os

import duckdb
import pandas as pd


def connect(d):
    c = duckdb.connect()
    c.execute("set timezone='UTC'")
    for p in glob.glob(d + "/*.parquet"):
        c.execute(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")
    return c


def plain(x):
    if hasattr(x, "tolist"):
        x = x.tolist()
    if x is None or (not isinstance(x, (list, dict, str)) and pd.isna(x)):
        return "NULL"
    if isinstance(x, bool):
        return str(x)
    if isinstance(x, (int, float)) or "Decimal" in type(x).__name__:
        return f"{float(x):.7g}"
    return str(x)


def rows(df):
    df = df[sorted(df.columns)]
    return list(df.columns), sorted(tuple(map(plain, r)) for r in df.itertuples(index=False, name=None))
