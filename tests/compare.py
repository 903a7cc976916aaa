"""Run a registered query and its SQL counterpart and compare columns, types and values."""

from __future__ import annotations

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET threads TO 8")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def canonical(df: pd.DataFrame) -> list[tuple]:
    columns = sorted(df.columns)
    rows = []
    for row in df[columns].itertuples(False, None):
        rows.append(tuple(None if pd.isna(v) else (float(v) if isinstance(v, float) else v) for v in row))
    return sorted(rows, key=lambda r: tuple((v is None, str(v)) for v in r))


def differences(got: pd.DataFrame, wanted: pd.DataFrame) -> str | None:
    if sorted(got.columns) != sorted(wanted.columns):
        return f"columns {sorted(got.columns)} != {sorted(wanted.columns)}"
    if len(got) != len(wanted):
        return f"rows {len(got)} != {len(wanted)}"
    for name in got.columns:
        left, right = got[name].dtype.kind, wanted[name].dtype.kind
        if left != right and len(got) and not got[name].isna().any():
            return f"type of {name}: {got[name].dtype} != {wanted[name].dtype}"
    for left, right in zip(canonical(got), canonical(wanted)):
        if left != right:
            return f"first different row: {left} != {right}"
    return None
