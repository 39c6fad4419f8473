"""Comparing a query with its SQL on DuckDB, rows in any order."""

from __future__ import annotations

import math
import os

import duckdb

SF = "/root/testdata/sf0.001"


def connect(folder: str = SF) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for name in os.listdir(folder):
        path = f"{folder}/{name}" + ("/*.parquet" if os.path.isdir(f"{folder}/{name}") else "")
        db.execute(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM read_parquet('{path}')")
    return db


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    return repr(float(value)) if isinstance(value, (int, float)) and not isinstance(value, bool) else str(value)


def rows(columns: list[str], found: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in found), key=str)


def check(spark, query, sql: str, folder: str = SF) -> None:
    mine = query(spark, folder)
    cursor = connect(folder).sql(sql)
    assert sorted(mine.columns) == sorted(cursor.columns)
    assert rows(mine.columns, [tuple(r) for r in mine.collect()]) == rows(cursor.columns, cursor.fetchall())
