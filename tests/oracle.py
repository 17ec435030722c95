"""Comparison of a Spark query with its SQL twin in DuckDB."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in sorted(Path(folder).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return connection


def rows_of_spark(frame) -> Counter:
    names = sorted(frame.columns)
    return Counter(tuple(row) for row in frame.select(*names).toLocalIterator())


def rows_of_sql(connection, text: str) -> tuple[list[str], Counter]:
    result = connection.execute(text)
    names = [column[0] for column in result.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    rows = Counter(tuple(row[place] for place in order) for row in result.fetchall())
    return sorted(names), rows


def check(frame, connection, text: str) -> int:
    names, expected = rows_of_sql(connection, text)
    assert sorted(frame.columns) == names
    actual = rows_of_spark(frame)
    missing, extra = expected - actual, actual - expected
    assert not missing and not extra, (
        f"{sum(missing.values())} missing {list(missing)[:3]}, {sum(extra.values())} extra {list(extra)[:3]}"
    )
    return sum(actual.values())
