"""Comparison of a query with its SQL, as multisets of rows."""

from __future__ import annotations

import math
from collections import Counter
from datetime import date, datetime
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    db.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return db


def plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        if math.isnan(value):
            return "NaN"
        return int(value) if value == int(value) else value
    if isinstance(value, (datetime, date)):
        return value.replace(tzinfo=None) if isinstance(value, datetime) else value
    return value


def bag(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def differences(frame, db, sql: str) -> str:
    """Empty text when the frame and the SQL agree."""
    cursor = db.execute(sql)
    names = [d[0] for d in cursor.description]
    expected_rows = cursor.fetchall()
    if sorted(frame.columns) != sorted(names):
        return f"columns {sorted(frame.columns)} vs {sorted(names)}"
    found, expected = bag(frame.columns, frame.collect()), bag(names, expected_rows)
    if found == expected:
        return ""
    extra, missing = list((found - expected).items())[:3], list((expected - found).items())[:3]
    return (
        f"{sum(found.values())} rows vs {sum(expected.values())}; columns {sorted(names)}; "
        f"only in Spark {extra}; only in SQL {missing}"
    )
