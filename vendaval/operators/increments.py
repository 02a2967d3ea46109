"""Watermark-based increments of an operational table."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vendaval.functions import row_version

VERSION_COLUMNS = ("criacao", "atualizacao")


def version_columns_of(rows: DataFrame) -> list[str]:
    """The version columns a table has, always in the same order."""
    return [c for c in VERSION_COLUMNS if c in rows.columns]


def changed_since(
    rows: DataFrame,
    since: str,
    version_columns: Sequence[str],
    *,
    until: str | None = None,
) -> DataFrame:
    """Rows created (or, for mutable tables, updated) strictly after ``since``.

    A plain disjunction over the stored columns, so it reaches the Parquet or JDBC scan
    as a pushed filter. A null ``atualizacao`` does not hide a new row. With ``until``
    rows created beyond that moment wait for the next run, which lets several tables share
    one upper bound. A row created before and updated beyond it is not put off: it comes as
    it is now.
    """
    newer = [F.col(c) > F.lit(since) for c in version_columns]
    condition = reduce(lambda a, b: a | b, newer)
    if until is not None:
        created = F.col(version_columns[0])
        condition = condition & (created.isNull() | (created <= F.lit(until)))
    return rows.where(condition)


def delta_profile(
    rows: DataFrame,
    since: str,
    version_columns: Sequence[str],
    id_column: str,
    *,
    connections: int | Column = 3,
    until: str | None = None,
) -> DataFrame:
    """One row on the pending delta: connections, id range, row count and watermark."""
    delta = changed_since(rows, since, version_columns, until=until)
    limit = connections if isinstance(connections, Column) else F.lit(connections)
    return delta.agg(
        F.min(id_column).alias("low_bound"),
        F.max(id_column).alias("upper_bound"),
        F.count(F.lit(1)).alias("qtd_linhas"),
        F.max(row_version(version_columns)).alias("watermark"),
    ).select(limit.alias("max_conn"), "low_bound", "upper_bound", "qtd_linhas", "watermark")


def watermark(rows: DataFrame, version_columns: Sequence[str] | None = None) -> DataFrame:
    """One row with the newest version timestamp of the table."""
    columns = version_columns or version_columns_of(rows)
    return rows.agg(F.max(row_version(columns)).alias("watermark"))
