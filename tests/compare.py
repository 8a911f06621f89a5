"""Run a registered query and its SQL, and compare rows exactly."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        if Path(f"{folder}/{name}.parquet").exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, bool) or value is None:
        return str(value)
    if isinstance(value, int):
        return str(value)
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in rows), sorted(columns)


def spark_rows(df):
    return rows_of(df.columns, [tuple(r) for r in df.collect()])


def sql_rows(con, sql: str):
    cur = con.execute(sql)
    return rows_of([c[0] for c in cur.description], cur.fetchall())


def difference(got, want) -> str | None:
    (rows, columns), (sql, sql_columns) = got, want
    if columns != sql_columns:
        return f"columns {columns} != {sql_columns}"
    if len(rows) != len(sql):
        return f"{len(rows)} rows != {len(sql)}"
    bad = [(a, b) for a, b in zip(rows, sql) if a != b]
    if bad:
        a, b = bad[0]
        shown = [(c, x[:300], y[:300]) for c, x, y in zip(columns, a, b) if x != y]
        return f"{len(bad)} of {len(rows)} rows differ, first: {shown}"
    return None
