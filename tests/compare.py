"""Run registered queries on Spark and DuckDB side by side."""

from __future__ import annotations

import math
import os
from collections import Counter
from datetime import datetime, timezone

import duckdb

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        if os.path.exists(f"{sf_dir}/{name}.parquet"):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.12g}")
    return value


def rows_of(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_cell(row[i]) for i in order) for row in rows)


def differences(spark_df, con, sql: str) -> str | None:
    """None if both give the same rows under the same column names, else what differs."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    expected = rows_of(names, result.fetchall())
    if sorted(spark_df.columns) != sorted(names):
        return f"columns differ: {sorted(set(spark_df.columns) ^ set(names))}"
    actual = rows_of(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    if actual == expected:
        return None
    return f"rows {actual.total()} vs {expected.total()}; only spark {list((actual - expected).items())[:2]}; only sql {list((expected - actual).items())[:2]}"


def at(text: str) -> datetime:
    """A moment in UTC."""
    return datetime.fromisoformat(text).replace(tzinfo=timezone.utc)
