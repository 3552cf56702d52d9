"""Run a registered query and its SQL check side by side."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return connection


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return str(value)


def bag(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_cell(row[i]) for i in order) for row in rows)


def differences(spark_df, connection, sql: str) -> list[str]:
    """Empty if columns and rows agree as a bag."""
    columns, rows = spark_df.columns, spark_df.collect()
    result = connection.execute(sql)
    wanted_columns = [d[0] for d in result.description]
    wanted = result.fetchall()
    if sorted(columns) != sorted(wanted_columns):
        return [f"columns {sorted(columns)} != {sorted(wanted_columns)}"]
    if not wanted:
        return ["the check gives no rows"]
    got, expected = bag(columns, rows), bag(wanted_columns, wanted)
    if got == expected:
        return []
    return [
        f"{len(rows)} rows, expected {len(wanted)}",
        f"only in Spark: {list((got - expected).items())[:3]}",
        f"only in SQL: {list((expected - got).items())[:3]}",
    ]
