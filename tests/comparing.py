"""Order-insensitive comparison of a query with its SQL."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb


def connect(root: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in Path(root).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def _cell(value):
    if isinstance(value, float):
        return None if math.isnan(value) else repr(value + 0.0)
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    shown = [tuple(_cell(r[i]) for i in order) for r in rows]
    return sorted(shown, key=repr)


def difference(df, con, sql: str) -> str | None:
    """None if both give the same columns and rows, exactly; else what differs first."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    expected = _rows(names, cursor.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    if len(got) != len(expected):
        extra = [g for g in got if g not in set(expected)][:2]
        lacking = [e for e in expected if e not in set(got)][:2]
        return f"{len(got)} rows against {len(expected)}: extra {extra}, lacking {lacking}"
    if not expected:
        return "no rows"
    for g, e in zip(got, expected):
        if g != e:
            return f"{sorted(names)}: {g} against {e}"
    return None
