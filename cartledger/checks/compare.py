"""Runs a query on Spark and its SQL on DuckDB and reports how they differ."""

from __future__ import annotations

import datetime as dt
import decimal
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

from cartledger.checks.oracle import oracle_sql
from cartledger.checks.registry import queries


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, dt.datetime):
        return value.isoformat(sep=" ")
    return value


def _bag(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def compare_rows(columns, rows, answer) -> list[str]:
    """What is wrong with ``rows`` against an executed DuckDB query."""
    expected_columns = [d[0] for d in answer.description]
    expected_rows = answer.fetchall()
    if sorted(columns) != sorted(expected_columns):
        return [f"columns {columns} != {expected_columns}"]
    got, want = _bag(columns, rows), _bag(expected_columns, expected_rows)
    if got == want:
        return []
    return [
        f"rows {len(rows)} vs {len(expected_rows)}",
        *[f"only Spark: {r}" for r in list((got - want))[:3]],
        *[f"only SQL: {r}" for r in list((want - got))[:3]],
    ]


def differences(spark: SparkSession, name: str, sf_dir: str) -> tuple[int, list[str]]:
    """Rows of the Spark result, and what is wrong with it (nothing when equal)."""
    result = queries()[name](spark, sf_dir)
    rows = result.collect()
    with connect(sf_dir) as con:
        return len(rows), compare_rows(result.columns, rows, con.execute(oracle_sql()[name]))
