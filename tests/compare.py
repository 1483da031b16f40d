"""Compare a Spark result with SQL run on the same parquet files."""

from __future__ import annotations

import math
from collections import Counter
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

import duckdb


def database(sf: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for path in sorted(Path(sf).glob("*.parquet")):
        db.execute(f"create view {path.stem} as select * from '{path}'")
    return db


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else repr(value)
    if isinstance(value, (Decimal, date, datetime)):
        return str(value)
    if isinstance(value, list):
        return tuple(value)
    return value


def _bag(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(frame, db, sql: str) -> list[str]:
    """What differs in columns or rows; nothing if the results agree."""
    cursor = db.execute(sql)
    columns = [c[0] for c in cursor.description]
    expected = _bag(columns, cursor.fetchall())
    if sorted(columns) != sorted(frame.columns):
        return [f"columns {sorted(frame.columns)} but SQL has {sorted(columns)}"]
    actual = _bag(frame.columns, frame.collect())
    missing, extra = expected - actual, actual - expected
    if not missing and not extra:
        return []
    return [
        f"{sum(actual.values())} rows but SQL has {sum(expected.values())}",
        *(f"missing {row}" for row in list(missing)[:3]),
        *(f"extra {row}" for row in list(extra)[:3]),
    ]


def rows(frame):
    """Rows as a sorted list of tuples."""
    return sorted((tuple(r) for r in frame.collect()), key=repr)
