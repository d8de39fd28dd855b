"""Comparing a Spark result with its expected SQL, as multisets of rows."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    return value


def compare(result, connection, sql: str) -> str | None:
    """None when equal, else what differs."""
    cursor = connection.execute(sql)
    names = [column[0] for column in cursor.description]
    if sorted(names) != sorted(result.columns):
        return f"columns {sorted(result.columns)} against {sorted(names)}"
    order = sorted(names)
    wanted = Counter(
        tuple(_plain(row[names.index(name)]) for name in order) for row in cursor.fetchall()
    )
    found = Counter(
        tuple(_plain(value) for value in row) for row in result.select(*order).collect()
    )
    if wanted == found:
        return None if sum(wanted.values()) else "both are empty"
    extra, missing = found - wanted, wanted - found
    return (
        f"{sum(found.values())} rows against {sum(wanted.values())}; "
        f"extra {list(extra)[:2]}; missing {list(missing)[:2]}; columns {order}"
    )
