"""Run a query and its SQL on the same tables and compare the rows, whatever their order."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"create view {name} as select * from '{Path(sf_dir) / name}.parquet'")
    return db


def _cell(value):
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.12g}")
    if isinstance(value, list):
        return tuple(map(_cell, value))
    return value


def rows_of(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_cell(row[i]) for i in order) for row in rows)


def difference(df, db, sql: str) -> str | None:
    """What differs, or None."""
    answer = db.execute(sql)
    columns = [column[0] for column in answer.description]
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} and {sorted(columns)}"
    expected = rows_of(columns, answer.fetchall())
    found = rows_of(df.columns, df.collect())
    if expected == found:
        return None
    extra, missing = found - expected, expected - found
    return (
        f"{found.total()} rows and {expected.total()}; extra {list(extra.items())[:3]}, "
        f"missing {list(missing.items())[:3]}"
    )
