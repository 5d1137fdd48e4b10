"""Compare a query with its DuckDB oracle as sorted rows."""

from __future__ import annotations

import math
import os

import duckdb
import pandas as pd

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def oracle(sql: str, sf_dir: str) -> pd.DataFrame:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p + '/*.parquet' if os.path.isdir(p) else p}')")
    return con.execute(sql).df()


def _cell(x):
    if x is None or x is pd.NaT or (isinstance(x, float) and math.isnan(x)):
        return ""
    if isinstance(x, bool):
        return str(x)
    if hasattr(x, "tolist"):
        x = x.tolist()
    if isinstance(x, dict):
        return str({k: _cell(v) for k, v in sorted(x.items())})
    if isinstance(x, (list, tuple)):
        return "[" + ",".join(_cell(y) for y in x) + "]"
    if isinstance(x, (int, float)):
        return f"{round(float(x), 5) + 0.0:.5f}"
    return str(x)


def rows(df: pd.DataFrame) -> list[tuple[str, ...]]:
    columns = sorted(df.columns)
    return sorted(tuple(_cell(x) for x in r) for r in df[columns].astype(object).where(df[columns].notna(), None).itertuples(index=False, name=None))


def same(got: pd.DataFrame, want: pd.DataFrame) -> str:
    """Empty if equal, else what differs."""
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} and {sorted(want.columns)}"
    a, b = rows(got), rows(want)
    if len(a) != len(b):
        return f"{len(a)} and {len(b)} rows"
    bad = [(x, y) for x, y in zip(a, b, strict=True) if x != y]
    return f"{len(bad)} of {len(a)} rows differ, as {bad[:2]}" if bad else ""
