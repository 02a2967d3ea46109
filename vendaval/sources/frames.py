"""Operational tables that Spark already sees as DataFrames (a replica, a lake table, files)."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from vendaval.operators.increments import changed_since, delta_profile
from vendaval.specs import TableSpec


@dataclass(frozen=True)
class FrameSource:
    """Same interface as :class:`vendaval.sources.JdbcSource`, over DataFrames."""

    tables: Mapping[str, DataFrame]

    def profile(
        self, spark: SparkSession, spec: TableSpec, since: str, until: str | None = None
    ) -> DataFrame:
        return delta_profile(
            self.tables[spec.name], since, spec.version_columns, spec.split_column, until=until
        )

    def delta(
        self,
        spark: SparkSession,
        spec: TableSpec,
        since: str,
        until: str | None,
        low: int,
        high: int,
    ) -> DataFrame:
        return changed_since(self.tables[spec.name], since, spec.version_columns, until=until)
