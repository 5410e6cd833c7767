"""Bit-for-bit comparison of a query's rows with its SQL twin's, regardless of order."""

from __future__ import annotations

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def oracle_frame(folder: str, sql: str) -> pd.DataFrame:
    con = duckdb.connect()
    con.execute("SET threads = 8")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con.execute(sql).df()


def canonical(frame: pd.DataFrame) -> pd.DataFrame:
    columns = sorted(frame.columns)
    out = frame[columns].copy()
    for c in columns:
        if pd.api.types.is_datetime64_any_dtype(out[c]):
            out[c] = out[c].astype("datetime64[us]")
        elif pd.api.types.is_integer_dtype(out[c]):
            out[c] = out[c].astype("float64" if out[c].hasnans else "int64")
    return out.sort_values(columns, kind="stable").reset_index(drop=True)


def assert_same(got: pd.DataFrame, want: pd.DataFrame) -> None:
    pd.testing.assert_frame_equal(canonical(got), canonical(want), check_exact=True)
