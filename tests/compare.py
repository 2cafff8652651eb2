"""Run a registered query and its SQL side by side."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES.split():
        if Path(f"{sf_dir}/{name}.parquet").exists():
            con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float) and not math.isnan(value):
        return round(value, 6)
    return value


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted((tuple(plain(row[i]) for i in order) for row in rows), key=repr)


def compare(spark, sf_dir: str, query, sql: str) -> None:
    result = query(spark, sf_dir)
    columns, rows = canonical(result.columns, [tuple(r) for r in result.collect()])
    con = duck(sf_dir)
    answer = con.sql(sql)
    expected_columns, expected = canonical(answer.columns, answer.fetchall())
    con.close()
    assert columns == expected_columns
    assert len(rows) == len(expected), f"{len(rows)} rows, expected {len(expected)}"
    for got, want in zip(rows, expected):
        assert got == want
