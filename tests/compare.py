"""Compare a query with its SQL counterpart: columns, row count and values."""

from __future__ import annotations

import glob
import os

import duckdb
import pandas as pd


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def normalise(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)].copy()
    for name in frame.columns:
        column = frame[name]
        if pd.api.types.is_datetime64_any_dtype(column) or column.map(lambda v: hasattr(v, "isoformat")).any():
            frame[name] = pd.to_datetime(column).dt.strftime("%Y-%m-%d").astype(object)
        elif pd.api.types.is_numeric_dtype(column):
            frame[name] = column.astype("float64") + 0.0
        frame[name] = frame[name].astype(object).where(frame[name].notna(), None)
    order = frame.astype(str).sort_values(list(frame.columns)).index
    return frame.loc[order].reset_index(drop=True)


def differences(spark_frame: pd.DataFrame, sql_frame: pd.DataFrame) -> str | None:
    a, b = normalise(spark_frame), normalise(sql_frame)
    if list(a.columns) != list(b.columns):
        return f"columns {sorted(set(a.columns) ^ set(b.columns))}"
    if len(a) != len(b):
        return f"rows {len(a)} != {len(b)}"
    for name in a.columns:
        unequal = (a[name] != b[name]) & ~(a[name].isna() & b[name].isna())
        if unequal.any():
            at = unequal.idxmax()
            return f"{name}: {int(unequal.sum())} differ, e.g. {a[name][at]!r} != {b[name][at]!r}"
    return None
