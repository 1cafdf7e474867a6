"""Runs a query's SQL with DuckDB over a folder of tables and compares its rows with Spark's."""

from __future__ import annotations

import math
import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def run_sql(sql: str, folder: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        if os.path.exists(path := f"{folder}/{name}.parquet"):
            path = f"{path}/*.parquet" if os.path.isdir(path) else path
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con.execute(sql).to_arrow_table()


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.9g}")
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    if isinstance(value, dict):
        return tuple((k, plain(v)) for k, v in sorted(value.items()))
    if hasattr(value, "asDict"):
        return plain(value.asDict())
    return value


def rows_of(table, columns: list[str]) -> list[tuple]:
    data = table.to_pylist()
    return sorted((tuple(plain(r[c]) for c in columns) for r in data), key=repr)


def assert_same(df, sql: str, folder: str) -> int:
    """Same columns, same rows; gives the number of rows."""
    want = run_sql(sql, folder)
    assert sorted(df.columns) == sorted(want.column_names), (sorted(df.columns), sorted(want.column_names))
    columns = sorted(df.columns)
    got = rows_of(df.toArrow(), columns)
    expected = rows_of(want, columns)
    assert len(got) == len(expected), (len(got), len(expected))
    for x, y in zip(got, expected, strict=True):
        assert x == y, (columns, x, y)
    return len(got)
