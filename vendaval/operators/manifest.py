"""Questions asked of the snapshot manifest (table, date, path)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vendaval.specs import RETENTION_DAYS


def of_table(manifest: DataFrame, table: str) -> DataFrame:
    return manifest.where(F.col("table") == table)


def latest(manifest: DataFrame) -> DataFrame:
    """Newest snapshot watermark per table: a max, not a sort."""
    return manifest.groupBy("table").agg(F.max(_moment(manifest)).alias("date"))


def snapshot_of(path: str = "path") -> Column:
    """Name of the snapshot a path leads to; names sort in the order of the extractions."""
    return F.element_at(F.split(path, "/"), -1)


def pending(manifest: DataFrame, table: str, done: str | None) -> DataFrame:
    """Snapshots of a table that come after the last one ingested, if any was."""
    entries = of_table(manifest, table)
    return entries if done is None else entries.where(snapshot_of() > F.lit(done))


def split_expired(
    manifest: DataFrame, today: str | None = None, days: int = RETENTION_DAYS
) -> tuple[DataFrame, DataFrame]:
    """Entries to keep, and entries whose snapshot is ``days`` old or older.

    An entry whose date cannot be read is kept.
    """
    day = F.current_date() if today is None else F.to_date(F.lit(today))
    moment = _moment(manifest)
    expired = F.coalesce(moment <= F.date_sub(day, days).cast("timestamp"), F.lit(False))
    return manifest.where(~expired), manifest.where(expired)


def _moment(manifest: DataFrame) -> Column:
    """The date as a timestamp, also where it was stored as text; malformed text is null."""
    if isinstance(manifest.schema["date"].dataType, T.StringType):
        return F.try_to_timestamp(F.col("date"))
    return F.col("date")
