"""Compare a Spark result with a DuckDB result, as multisets of rows with columns by name."""

from __future__ import annotations

import glob
import os
from collections import Counter

import duckdb


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for path in glob.glob(f"{sf}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return db


def _plain(value):
    return round(value, 9) if isinstance(value, float) else value


def _rows(columns: list[str], rows) -> tuple[list[str], Counter]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return ([columns[i] for i in order],
            Counter(tuple(_plain(row[i]) for i in order) for row in rows))


def differences(frame, db: duckdb.DuckDBPyConnection, sql: str) -> str:
    """'' when equal, else a short description."""
    cursor = db.execute(sql)
    want_columns, want = _rows([c[0] for c in cursor.description], cursor.fetchall())
    got_columns, got = _rows(frame.columns, frame.collect())
    if got_columns != want_columns:
        return f"columns {got_columns} != {want_columns}"
    if got != want:
        extra, missing = got - want, want - got
        return (f"{sum(got.values())} rows, expected {sum(want.values())}; "
                f"extra {list(extra)[:2]}; missing {list(missing)[:2]}")
    return ""
