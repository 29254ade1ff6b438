"""Comparison of Spark rows with DuckDB rows, order and column order aside."""

from __future__ import annotations

import glob
import os

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(
        (tuple(row[i] for i in order) for row in rows),
        key=lambda r: tuple((v is None, str(type(v)), str(v)) for v in r),
    )


def mismatch(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """What differs, or None."""
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    expected = _rows(names, found.fetchall())
    actual = _rows(df.columns, [tuple(r) for r in df.collect()])
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} expected {sorted(names)}"
    if len(actual) != len(expected):
        return f"{len(actual)} rows expected {len(expected)}"
    for a, e in zip(actual, expected):
        if a != e:
            return f"row {a} expected {e}"
        if [type(x) for x in a] != [type(x) for x in e]:
            return f"types of {a} differ from {e}"
    return None
