"""Compare a Spark query with its SQL counterpart in DuckDB."""

from __future__ import annotations

import datetime as dt
import decimal
from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        if Path(f"{folder}/{name}.parquet").exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return str(value)
    if isinstance(value, dt.datetime):
        return value.isoformat()
    return value


def _rows(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple((type(r[i]).__name__, _plain(r[i])) for i in order) for r in rows)


def differences(df, con, sql: str) -> str:
    """Empty if both give the same columns and rows, else what differs."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != sorted(df.columns):
        return f"columns: spark {sorted(df.columns)}, sql {sorted(names)}"
    expected = _rows(names, result.fetchall())
    actual = _rows(df.columns, [tuple(r) for r in df.collect()])
    if expected == actual:
        return ""
    extra, lacking = actual - expected, expected - actual
    return (
        f"{sum(actual.values())} rows against {sum(expected.values())}; "
        f"only in spark: {list(extra)[:3]}; only in sql: {list(lacking)[:3]}"
    )
