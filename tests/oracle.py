"""Runs a query's SQL in DuckDB over the same tables and compares all rows, whatever their order."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for p in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p}')")
    return con


def _plain(x):
    if x is None or isinstance(x, float) and math.isnan(x):
        return "NULL"
    if hasattr(x, "dtype") or isinstance(x, (int, float)) and not isinstance(x, bool):
        return repr(round(float(x), 6))
    return str(list(x)) if isinstance(x, (list, tuple)) else str(x)


def rows(columns, data) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(r[i]) for i in order) for r in data)


def same(query, sql: str, spark, sf_dir: str) -> None:
    df = query(spark, sf_dir)
    found = connect(sf_dir).execute(sql)
    names = [d[0] for d in found.description]
    assert sorted(df.columns) == sorted(names)
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == rows(names, found.fetchall())
