"""Run a registered query and its oracle SQL side by side."""

from __future__ import annotations

import os
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        path = os.path.join(folder, f"{name}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(repr(r[i]) for i in order) for r in rows)


def compare(df, con, sql: str) -> str | None:
    """None when both sides hold the same rows, else what differs."""
    cursor = con.execute(sql)
    expected_columns = [c[0] for c in cursor.description]
    expected = _rows(expected_columns, cursor.fetchall())
    got_columns = df.columns
    if sorted(got_columns) != sorted(expected_columns):
        return f"columns {sorted(got_columns)} vs {sorted(expected_columns)}"
    got = _rows(got_columns, [tuple(r) for r in df.collect()])
    if got == expected:
        return None
    extra, missing = got - expected, expected - got
    return (
        f"{sum(got.values())} vs {sum(expected.values())} rows; only here {sum(extra.values())} e.g. {list(extra)[:2]};"
        f" only oracle {sum(missing.values())} e.g. {list(missing)[:2]}"
    )
