"""Holds a query against its SQL on the same Parquet tables."""

from __future__ import annotations

from pathlib import Path

import duckdb
import numpy as np
import pandas as pd


def tables(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for f in Path(folder).glob("*.parquet"):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return con


def cell(v):
    """A value without its type's spelling: a whole number in a column with nulls comes as a float from one side."""
    if v is None or v is pd.NA or v != v:
        return None
    if isinstance(v, float | np.floating):
        return int(v) if v == int(v) else round(float(v), 6)
    return int(v) if isinstance(v, int | np.integer) and not isinstance(v, bool) else str(v)


def plain(df: pd.DataFrame) -> list[tuple]:
    return sorted((tuple(map(cell, r)) for r in df[sorted(df.columns)].astype(object).itertuples(index=False, name=None)), key=repr)


def assert_same(spark_rows: pd.DataFrame, sql_rows: pd.DataFrame) -> None:
    assert sorted(spark_rows.columns) == sorted(sql_rows.columns)
    a, b = plain(spark_rows), plain(sql_rows)
    assert len(a) == len(b)
    assert [x for x, y in zip(a, b, strict=True) if x != y][:3] == [y for x, y in zip(a, b, strict=True) if x != y][:3]
