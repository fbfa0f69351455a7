"""Run queries next to their DuckDB SQL and compare whole results."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _norm(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    table = [tuple(_norm(row[i]) for i in order) for row in rows]
    return [names[i] for i in order], sorted(table, key=repr)


def compare(spark, con, folder, query, sql) -> str | None:
    """None when equal, else what differs."""
    df = query(spark, folder)
    got = _rows(df.columns, [tuple(row) for row in df.collect()])
    cursor = con.execute(sql)
    want = _rows([d[0] for d in cursor.description], cursor.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    if len(got[1]) != len(want[1]):
        return f"{len(got[1])} rows, expected {len(want[1])}"
    for left, right in zip(got[1], want[1]):
        if left != right:
            return f"{str(left)[:1500]}\n   != {str(right)[:1500]}"
    return None if got[1] else "both empty"
