"""Ingestion: pending snapshots become part of each table's master dataset."""

from __future__ import annotations

import logging
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vendaval.operators import manifest as manifests
from vendaval.operators.upsert import (
    append_missing,
    newest_per_key,
    oldest_per_key,
    upsert,
)
from vendaval.plans.extract import read_manifest
from vendaval.plans.layout import Layout
from vendaval.plans.masters import (
    facts_path,
    finish_ranges,
    key_range,
    last_ingest,
    ranges_path,
    read_facts,
    read_ranges,
    write_facts,
    write_ranges,
)
from vendaval.plans.outcomes import Outcome, run_each
from vendaval.sources.files import read_snapshots
from vendaval.specs import TABLES, TableSpec

log = logging.getLogger(__name__)

MODES = ("upsert", "append", "replace")

def read_master(
    spark: SparkSession, layout: Layout, spec: TableSpec, *, since: str | None = None
) -> DataFrame:
    """Master dataset of a table.

    ``since`` keeps the rows created at or after a moment; files and parts of files are
    skipped by their range of times, which is narrow, as each ingest writes files of its own.
    """
    read = read_ranges if spec.mutable else read_facts
    rows = read(spark, layout, spec)
    return rows if since is None else rows.where(F.col("criacao") >= F.lit(since))


def pending_snapshots(spark: SparkSession, layout: Layout, spec: TableSpec) -> DataFrame:
    """Manifest entries the master does not hold yet; their names sort oldest first.

    An ingest is named after the newest snapshot in it, so this compares names and never
    reads the master.
    """
    done = last_ingest(spark, layout, spec.name)
    entries = manifests.pending(read_manifest(spark, layout), spec.name, done)
    date = F.date_format("date", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("date")
    return entries.select(date, "path", manifests.snapshot_of().alias("name"))


def ingest_table(
    spark: SparkSession, layout: Layout, spec: TableSpec, mode: str | None = None
) -> Outcome:
    """Bring one master up to date.

    * ``append`` (default for tables that only grow) adds a lot with the rows whose key is
      not stored yet; of a key that comes several times the first row created stays. Of the
      master only the key columns are read, in the delta's range of ids, without a shuffle.
    * ``upsert`` (default for mutable tables) keeps the newest version per key. Only the
      ranges of the keys that come in are read and written again.
    * ``replace`` makes the new rows the whole master.

    A master holds one row per key in every mode, so a mutable table is never appended to.
    """
    mode = mode or ("upsert" if spec.mutable else "append")
    if mode not in MODES:
        raise ValueError(f"unknown ingest mode {mode!r}")
    if mode == "append" and spec.mutable:
        raise ValueError(f"appending to {spec.name} would store several versions of a row")
    if mode == "upsert" and not spec.mutable:
        raise ValueError(f"rows of {spec.name} do not change; append them")
    if spec.mutable:
        finish_ranges(spark, layout, spec)
    # Metadata only: a row per snapshot.
    entries = sorted(pending_snapshots(spark, layout, spec).collect(), key=lambda e: e["name"])
    if not entries:
        return Outcome(spec.name, 0)
    delta = read_snapshots(spark, spec.schema, [e["path"] for e in entries])
    pick = newest_per_key if spec.mutable else oldest_per_key
    name = entries[-1]["name"]
    if mode == "append":
        stored = read_facts(spark, layout, spec, listed=False)
        rows = append_missing(stored, delta, spec.key, bound=spec.split_column)
    elif mode == "upsert":
        # Metadata as well: a row per range.
        of_key = key_range(spec, ranges_path(spark, layout, spec))
        touched = [r[0] for r in delta.select(of_key).distinct().collect()]
        stored = read_ranges(spark, layout, spec, only=touched)
        rows = upsert(stored, delta, spec.key, spec.version_columns)
    else:
        rows = delta
    if mode != "upsert":
        rows = pick(rows, spec.key, spec.version_columns)
    if spec.mutable:
        path = ranges_path(spark, layout, spec)
        count = write_ranges(rows, layout, spec, name, mode)
    else:
        path = facts_path(spark, layout, spec)
        count = write_facts(rows, layout, spec, name, replace=mode == "replace")

    log.info("%s: %s rows written by %s", spec.name, count, mode)
    return Outcome(spec.name, count, entries[-1]["date"], path)


def ingest_all(
    spark: SparkSession,
    layout: Layout,
    tables: Iterable[str] = tuple(TABLES),
    mode: str | None = None,
    *,
    workers: int = 3,
) -> list[Outcome]:
    """Ingest every table, several at a time."""
    return run_each(
        spark,
        lambda table: ingest_table(spark, layout, TABLES[table], mode),
        tables,
        workers=workers,
    )
