"""Extraction: changed rows of each table become a snapshot plus a manifest entry."""

from __future__ import annotations

import logging
from collections.abc import Iterable, Sequence
from datetime import datetime, timedelta
from typing import Protocol

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from vendaval.operators import manifest as manifests
from vendaval.plans.layout import Layout
from vendaval.plans.masters import last_ingest
from vendaval.plans.outcomes import Outcome, run_each
from vendaval.sources.files import delete_path
from vendaval.sources.versioned import (
    append_rows,
    last_state,
    publish,
    read_current,
)
from vendaval.specs import (
    BASE_WATERMARK,
    MANIFEST_SCHEMA,
    OVERLAP_SECONDS,
    RETENTION_DAYS,
    TABLES,
    TableSpec,
)

log = logging.getLogger(__name__)

_TEXT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


class Source(Protocol):
    def profile(
        self, spark: SparkSession, spec: TableSpec, since: str, until: str | None = None
    ) -> DataFrame: ...

    def delta(
        self,
        spark: SparkSession,
        spec: TableSpec,
        since: str,
        until: str | None,
        low: int,
        high: int,
    ) -> DataFrame: ...


def read_manifest(spark: SparkSession, layout: Layout) -> DataFrame:
    return read_current(spark, layout.manifest, MANIFEST_SCHEMA)


def last_extracted(
    spark: SparkSession, layout: Layout, table: str, base: str = BASE_WATERMARK
) -> str:
    """Watermark of the table's newest snapshot, or the base watermark."""
    entries = manifests.of_table(read_manifest(spark, layout), table)
    row = manifests.latest(entries).select(F.date_format("date", _TEXT).alias("date")).first()
    return row["date"] if row and row["date"] else base


def extract_table(
    spark: SparkSession,
    source: Source,
    spec: TableSpec,
    layout: Layout,
    *,
    until: str | None = None,
    overlap_seconds: float = OVERLAP_SECONDS,
    base: str = BASE_WATERMARK,
) -> Outcome:
    """Write the rows newer than the last snapshot, and record them.

    The profile fixes the new watermark, and the read that follows takes the rows created up
    to it, even while the table keeps growing; one of them updated meanwhile comes in its
    newer version, now and again in the next run. ``until`` gives the tables of one run a
    common upper bound. Rows of ``overlap_seconds`` before the old watermark are read again,
    which catches rows committed late within the same second; ingesting is safe against the
    repetition. The manifest entry is written only after the snapshot. Snapshots are named
    after watermark and number, so their order depends on no clock.
    """
    last = last_extracted(spark, layout, spec.name, base)
    since = last
    if last != base:
        since = _text(datetime.fromisoformat(last) - timedelta(seconds=overlap_seconds))
    profile = (
        source.profile(spark, spec, since, until)
        .select(
            "low_bound",
            "upper_bound",
            "qtd_linhas",
            F.date_format("watermark", _TEXT).alias("watermark"),
        )
        .first()
    )
    if profile["qtd_linhas"] == 0:
        log.info("%s: nothing newer than %s", spec.name, since)
        return Outcome(spec.name, 0, since)

    newest = max(profile["watermark"], last)
    if until is not None:
        newest = min(newest, max(_text(datetime.fromisoformat(until)), last))
    delta = source.delta(
        spark, spec, since, newest, profile["low_bound"], profile["upper_bound"]
    )
    name = f"{snapshot_name(newest)}-{_next_number(spark, layout, spec.name):08d}"
    path = f"{layout.snapshots(spec.name)}/{name}"
    written = Observation()
    delta.observe(written, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(path)
    record_snapshot(spark, layout, spec.name, newest, path, since)
    log.info("%s: %s rows up to %s", spec.name, written.get["rows"], newest)
    return Outcome(spec.name, written.get["rows"], newest, path)


def extract_all(
    spark: SparkSession,
    source: Source,
    layout: Layout,
    tables: Sequence[str] = tuple(TABLES),
    **options,
) -> list[Outcome]:
    """Extract every table, one after another: they share the source's connection limit.

    A table comes before those its rows refer to. A row is made after the rows it refers to,
    so when its parents' profiles are taken, later, they find these: however much is inserted
    meanwhile, no line comes without its sale, nor a sale without its customer.
    """
    outcomes = run_each(
        spark,
        lambda table: extract_table(spark, source, TABLES[table], layout, **options),
        children_first(tables),
    )
    by_name = {outcome.name: outcome for outcome in outcomes}
    return [by_name[table] for table in tables]


def children_first(tables: Iterable[str]) -> list[str]:
    """Table names in an order in which each comes before its parents."""
    left, ordered = list(tables), []
    while left:
        parents = {p for name in left for p in TABLES[name].parents}
        free = [name for name in left if name not in parents]
        ordered += free
        left = [name for name in left if name in parents]
    return ordered


def record_snapshot(
    spark: SparkSession, layout: Layout, table: str, watermark: str, path: str, since: str
) -> None:
    values = {"table": table, "date": watermark, "path": path, "since": since}
    columns = [F.lit(values[f.name]).cast(f.dataType).alias(f.name) for f in MANIFEST_SCHEMA]
    append_rows(spark.range(1, numPartitions=1).select(*columns), layout.manifest)


def purge_snapshots(
    spark: SparkSession,
    layout: Layout,
    *,
    today: str | None = None,
    days: int = RETENTION_DAYS,
) -> list[str]:
    """Forget and delete old snapshots that are already in their master dataset.

    The shorter manifest, compacted to one file, is published first and the directories go
    last, so no entry ever points at a deleted path. Returns the deleted paths.
    """
    if last_state(spark, layout.manifest) is None:
        return []
    manifest = read_manifest(spark, layout)
    _, expired = manifests.split_expired(manifest, today, days)
    rows = expired.select("table", "path").collect()  # metadata: a row per old snapshot
    ingested = {t: last_ingest(spark, layout, t) or "" for t in {r["table"] for r in rows}}
    doomed = [r["path"] for r in rows if r["path"].rsplit("/", 1)[-1] <= ingested[r["table"]]]
    gone = spark.createDataFrame([(path,) for path in doomed], "path string")
    publish(manifest.join(gone, "path", "left_anti").coalesce(1), layout.manifest)
    for path in doomed:
        delete_path(spark, path)
    return doomed


def _next_number(spark: SparkSession, layout: Layout, table: str) -> int:
    """One more than the number of the table's last snapshot, whether still listed or ingested."""
    number = F.element_at(F.split("path", "-"), -1).cast("long")
    entries = manifests.of_table(read_manifest(spark, layout), table)
    listed = entries.agg(F.max(number).alias("n")).first()["n"] or 0
    done = last_ingest(spark, layout, table)
    return max(listed, int(done.rsplit("-", 1)[-1]) if done else 0) + 1


def snapshot_name(watermark: str) -> str:
    """Directory-safe, sortable form of a watermark."""
    parsed = datetime.fromisoformat(watermark)
    return parsed.strftime("%Y%m%dT%H%M%S%f")


def _text(moment: datetime) -> str:
    return moment.strftime("%Y-%m-%d %H:%M:%S.%f")
