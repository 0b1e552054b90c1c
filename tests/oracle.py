"""Run a catalogue query on Spark and its SQL twin on DuckDB, and compare the rows."""

from __future__ import annotations

import time

import duckdb
import numpy as np
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def canonical(df: pd.DataFrame, integers: frozenset = frozenset()) -> pd.DataFrame:
    """Values as text; ``integers`` names columns that pandas turned into floats because they hold NULLs."""
    df = df[sorted(df.columns)].copy()
    for name in df.columns:
        column = df[name]
        if str(column.dtype).startswith("datetime64"):
            df[name] = column.astype("datetime64[us]").astype(str)
        elif column.dtype == object:
            df[name] = column.map(lambda v: None if v is None or v is pd.NaT or v is np.nan else str(v))
        elif column.dtype.kind == "f":
            whole = name in integers
            df[name] = column.map(lambda v: None if pd.isna(v) else str(int(v)) if whole else repr(float(v)))
        elif column.dtype.kind in "iub":
            df[name] = [None if pd.isna(v) else str(bool(v)) if column.dtype.kind == "b" else str(int(v)) for v in column]
    df = df.astype(object).where(df.notna(), "NULL").astype(str)
    return df.sort_values(list(df.columns)).reset_index(drop=True)


def compare(spark, con, plan, sql: str, sf_dir: str) -> tuple[bool, str, float]:
    started = time.monotonic()
    found = plan(spark, sf_dir)
    integers = frozenset(c for c, kind in found.dtypes if kind in ("int", "bigint"))
    mine = found.toPandas()
    seconds = time.monotonic() - started
    other = con.execute(sql).df()
    if sorted(mine.columns) != sorted(other.columns):
        return False, f"columns {sorted(mine.columns)} != {sorted(other.columns)}", seconds
    kinds = {c: (mine[c].dtype, other[c].dtype) for c in mine.columns if mine[c].dtype.kind != other[c].dtype.kind}
    a, b = canonical(mine, integers), canonical(other, integers)
    if len(a) != len(b):
        return False, f"rows {len(a)} != {len(b)}", seconds
    if not a.equals(b):
        bad = (a != b).any(axis=1)
        where = [c for c in a.columns if (a[c] != b[c]).any()]
        return False, f"{bad.sum()} of {len(a)} rows differ in {where}:\n{a[bad].head(5)}\n{b[bad].head(5)}", seconds
    return True, f"{len(a)} rows" + (f" (types {kinds})" if kinds else ""), seconds
