"""Runs queries beside their SQL counterparts and compares rows, names and values."""

from __future__ import annotations

import datetime as dt
import math
from collections import Counter
from decimal import Decimal
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        path = Path(folder, f"{table}.parquet")
        if path.exists():
            connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{path}')")
    return connection


def normal(value: object) -> object:
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        value = round(value, 6)
        return int(value) if value.is_integer() else value
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, dt.date):
        return value.isoformat()
    return value


def compare(spark_frame, sql: str, connection: duckdb.DuckDBPyConnection) -> list[str]:
    """Differences between the two results; empty when they agree."""
    cursor = connection.execute(sql)
    oracle_names = [d[0] for d in cursor.description]
    oracle_rows = cursor.fetchall()
    spark_names = spark_frame.columns
    if sorted(oracle_names) != sorted(spark_names):
        only = set(oracle_names) ^ set(spark_names)
        return [f"columns differ: {sorted(only)}"]
    names = sorted(spark_names)
    oracle_at = [oracle_names.index(n) for n in names]
    spark_at = [spark_names.index(n) for n in names]
    expected = Counter(tuple(normal(row[i]) for i in oracle_at) for row in oracle_rows)
    actual = Counter(tuple(normal(row[i]) for i in spark_at) for row in spark_frame.collect())
    problems = []
    if sum(expected.values()) != sum(actual.values()):
        problems.append(f"rows: spark {sum(actual.values())}, sql {sum(expected.values())}")
    for label, extra in (("only spark", actual - expected), ("only sql", expected - actual)):
        if extra:
            sample = [dict(zip(names, row)) for row in list(extra)[:2]]
            problems.append(f"{label}: {sum(extra.values())} rows, e.g. {sample}")
    return problems
