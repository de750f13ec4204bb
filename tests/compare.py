"""Comparing a Spark result with a DuckDB result, row by row and without regard to order."""

from __future__ import annotations

import math
import pathlib

import duckdb


def connect(folder: str):
    connection = duckdb.connect()
    for path in sorted(pathlib.Path(folder).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _sortable(value):
    if value is None:
        return (0, "")
    if isinstance(value, bool):
        return (1, str(value))
    if isinstance(value, float) and math.isnan(value):
        return (2, "nan")
    return (1, f"{value:040.10f}" if isinstance(value, float) else str(value))


def canonical(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(row[i] for i in order) for row in rows]
    return sorted(plain, key=lambda r: [_sortable(v) for v in r])


def spark_rows(df) -> tuple[list[str], list[tuple]]:
    return sorted(df.columns), canonical(df.columns, df.collect())


def duck_rows(connection, sql: str) -> tuple[list[str], list[tuple]]:
    result = connection.execute(sql)
    columns = [d[0] for d in result.description]
    return sorted(columns), canonical(columns, result.fetchall())
