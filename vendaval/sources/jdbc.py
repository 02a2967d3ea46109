"""Incremental, parallel reads from an operational database."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from vendaval.specs import TableSpec


def _literal(moment: str) -> str:
    """SQL timestamp literal; anything that is not a timestamp is refused."""
    parsed = datetime.fromisoformat(moment)
    return f"TIMESTAMP '{parsed:%Y-%m-%d %H:%M:%S.%f}'"


def delta_condition(spec: TableSpec, since: str, until: str | None = None) -> str:
    """SQL form of :func:`vendaval.operators.changed_since`."""
    condition = " OR ".join(f"{c} > {_literal(since)}" for c in spec.version_columns)
    if until is None:
        return condition
    created = spec.version_columns[0]
    return f"({condition}) AND ({created} IS NULL OR {created} <= {_literal(until)})"


def delta_query(spec: TableSpec, since: str, until: str | None = None) -> str:
    """Subquery with the changed rows, to be used as a table."""
    return f"(SELECT * FROM {spec.name} WHERE {delta_condition(spec, since, until)}) delta"


def profile_query(spec: TableSpec, since: str, until: str | None = None) -> str:
    """Subquery with the delta's profile: the database sends one row."""
    if spec.mutable:
        newest = (
            "CASE WHEN atualizacao > criacao OR criacao IS NULL "
            "THEN atualizacao ELSE criacao END"
        )
    else:
        newest = "criacao"
    key = spec.split_column
    return (
        f"(SELECT MIN({key}) AS low_bound, MAX({key}) AS upper_bound, "
        f"COUNT(*) AS qtd_linhas, MAX({newest}) AS watermark "
        f"FROM {spec.name} WHERE {delta_condition(spec, since, until)}) profile"
    )


@dataclass(frozen=True)
class JdbcSource:
    """A database reached over JDBC; its driver jar must be on Spark's class path.

    ``connections`` is the number of connections the account may hold, and so the number
    of parallel range reads.
    """

    url: str
    driver: str
    user: str
    password: str = field(repr=False)
    connections: int = 3
    fetch_size: int = 10_000

    def options(self, query: str) -> dict[str, Any]:
        # MySQL's driver heeds the fetch size only with a cursor.
        mysql = self.url.startswith("jdbc:mysql:")
        return ({"useCursorFetch": "true"} if mysql else {}) | {
            "url": self.url,
            "driver": self.driver,
            "user": self.user,
            "password": self.password,
            "dbtable": query,
            "fetchsize": self.fetch_size,
        }

    def read_options(
        self, spec: TableSpec, since: str, until: str | None, low: int, high: int
    ) -> dict[str, Any]:
        """Options of the range-partitioned read. The bounds only place the splits."""
        return self.options(delta_query(spec, since, until)) | {
            "partitionColumn": spec.split_column,
            "lowerBound": low,
            "upperBound": high,
            "numPartitions": self.connections,
        }

    def profile(
        self, spark: SparkSession, spec: TableSpec, since: str, until: str | None = None
    ) -> DataFrame:
        options = self.options(profile_query(spec, since, until))
        return spark.read.format("jdbc").options(**options).load()

    def delta(
        self,
        spark: SparkSession,
        spec: TableSpec,
        since: str,
        until: str | None,
        low: int,
        high: int,
    ) -> DataFrame:
        options = self.read_options(spec, since, until, low, high)
        rows = spark.read.format("jdbc").options(**options).load()
        return rows.select(*[F.col(f.name).cast(f.dataType) for f in spec.schema])
