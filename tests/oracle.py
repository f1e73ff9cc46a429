"""Comparison of a query's rows with those of its SQL in DuckDB."""

from __future__ import annotations

import math
from datetime import date, datetime
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        if Path(f"{folder}/{name}.parquet").exists():
            connection.execute(
                f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')"
            )
    return connection


def _plain(value):
    if isinstance(value, datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, date):
        return datetime(value.year, value.month, value.day).isoformat()
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return repr(value)


def canonical(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(spark_df, connection, sql: str, show: int = 3) -> str | None:
    """What differs, or None."""
    result = connection.execute(sql)
    expected_names = [c[0] for c in result.description]
    expected = canonical(expected_names, result.fetchall())
    actual = canonical(spark_df.columns, spark_df.collect())
    if sorted(expected_names) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} != {sorted(expected_names)}"
    if len(actual) != len(expected):
        return f"{len(actual)} rows, expected {len(expected)}"
    if actual != expected:
        pairs = [(a, e) for a, e in zip(actual, expected) if a != e]
        return f"{len(pairs)} rows differ, e.g. {pairs[:show]}"
    return None
