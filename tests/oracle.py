"""Compares registered queries with their SQL on the driver's tables."""

from __future__ import annotations

import math
from datetime import date, datetime
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')"
        )
    return connection


def _cell(value):
    if isinstance(value, (float, Decimal)):
        return "nan" if math.isnan(value) else repr(float(value))
    if isinstance(value, datetime):
        return value.isoformat(sep=" ")
    if isinstance(value, date):
        return value.isoformat()
    return repr(value)


def _sorted_rows(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def differences(query, sql, spark, connection, sf_dir) -> str | None:
    """What differs, or None."""
    frame = query(spark, sf_dir)
    relation = connection.execute(sql)
    sql_columns = [d[0] for d in relation.description]
    if sorted(frame.columns) != sorted(sql_columns):
        return f"columns {sorted(frame.columns)} != {sorted(sql_columns)}"
    ours = _sorted_rows([tuple(r) for r in frame.collect()], frame.columns)
    theirs = _sorted_rows(relation.fetchall(), sql_columns)
    if len(ours) != len(theirs):
        return f"{len(ours)} rows != {len(theirs)} rows"
    for a, b in zip(ours, theirs, strict=True):
        if a != b:
            return f"{a} != {b}"
    return None
