"""Compare a registered query with its SQL counterpart on the same tables."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pandas as pd


def views(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def canonical(frame: pd.DataFrame) -> pd.DataFrame:
    """Columns by name, rows in one order, values as comparable text."""
    frame = frame[sorted(frame.columns)].copy()
    for name in frame.columns:
        column = frame[name]
        if pd.api.types.is_float_dtype(column):
            column = column + 0.0
        elif pd.api.types.is_datetime64_any_dtype(column):
            column = column.astype("datetime64[us]")
        frame[name] = column.map(lambda v: "NULL" if pd.isna(v) else str(v))
    return frame.sort_values(list(frame.columns), ignore_index=True)


def differences(spark_frame: pd.DataFrame, sql_frame: pd.DataFrame) -> str | None:
    if sorted(spark_frame.columns) != sorted(sql_frame.columns):
        return f"columns {sorted(spark_frame.columns)} != {sorted(sql_frame.columns)}"
    if len(spark_frame) != len(sql_frame):
        return f"rows {len(spark_frame)} != {len(sql_frame)}"
    left, right = canonical(spark_frame), canonical(sql_frame)
    unequal = (left != right).any(axis=1)
    if unequal.any():
        return f"{unequal.sum()} rows differ:\n{left[unequal].head(3)}\n{right[unequal].head(3)}"
    return None
