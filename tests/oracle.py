"""Comparison of a query result with DuckDB running the oracle SQL."""

from __future__ import annotations

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def canonical(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)].astype(object).where(frame[sorted(frame.columns)].notna(), None)
    show = lambda v: repr(float(v)) if isinstance(v, float) else str(v)
    return sorted(tuple(show(v) for v in row) for row in frame.itertuples(index=False))


def compare(frame: pd.DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> str:
    """Empty if equal, otherwise what differs."""
    expected = con.execute(sql).fetchdf()
    if sorted(frame.columns) != sorted(expected.columns):
        return f"columns {sorted(frame.columns)} != {sorted(expected.columns)}"
    if len(frame) != len(expected):
        return f"rows {len(frame)} != {len(expected)}"
    kinds = {c: (frame[c].dtype.kind, expected[c].dtype.kind) for c in frame.columns}
    odd = {c: k for c, k in kinds.items() if k[0] != k[1] and "O" not in k}
    got, want = canonical(frame), canonical(expected)
    differing = [(g, w) for g, w in zip(got, want) if g != w]
    if differing:
        return f"{len(differing)} rows differ, kinds {odd}, e.g. {differing[0]} columns {sorted(frame.columns)}"
    return f"types {odd}" if odd else ""
