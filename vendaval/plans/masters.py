"""Master datasets: bucketed tables of Spark's catalog, and tables partitioned by key range.

Tables that only grow are bucketed and sorted by the sale's id, all in as many buckets, so that
joins, key checks and aggregates on that id read them without a shuffle. A task takes a whole
bucket then, so their number follows the size of the first load, and a master whose buckets have
outgrown a task is read without them. Every row carries the
lot it came with, and readers take the lots the table's log lists: an append that failed half
way stays invisible, and running it again adds only what is missing.

Tables whose rows change are partitioned by ranges of the key, so their number follows the
table's size. An upsert writes the ranges it touches next to the master, complete, and then
overwrites just these with Spark's dynamic partition overwrite; one that failed half way is
repeated from what it wrote first.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vendaval.plans.layout import Layout
from vendaval.sources.files import delete_path, empty, folder_bytes, list_names, path_exists
from vendaval.sources.versioned import append_rows, read_current
from vendaval.specs import INGEST_SCHEMA, TABLES, TableSpec

LOT = "lote"
"""Name of the newest snapshot in the ingest that stored a row; names sort in time."""

RANGE = "faixa"
"""Partition of mutable masters: the key divided by the width of a range."""

BUCKET_BYTES = 16 << 20
"""Snapshots of the first load to a bucket; sorting a bucket takes some ten times as much memory."""

FULL_BUCKET_BYTES = 128 << 20
"""Stored size from which on a bucket is too much for one task."""

_BUCKETS, _WIDTH, _REDO = "baldes=", "largura=", "refazer"


def read_log(spark: SparkSession, layout: Layout, table: str) -> DataFrame:
    """(name, mode, rows) of the ingests of a table that are complete."""
    return read_current(spark, layout.ingests(table), INGEST_SCHEMA)


def last_ingest(spark: SparkSession, layout: Layout, table: str) -> str | None:
    return read_log(spark, layout, table).agg(F.max("name")).first()[0]


def last_replacement(spark: SparkSession, layout: Layout, table: str) -> str | None:
    log = read_log(spark, layout, table).where("mode = 'replace'")
    return log.agg(F.max("name")).first()[0]


def record_ingest(spark: SparkSession, layout: Layout, table: str, name: str, mode: str, rows: int) -> None:
    """Makes an ingest visible; one writer per table."""
    values = {"name": name, "mode": mode, "rows": rows}
    columns = [F.lit(values[f.name]).cast(f.dataType).alias(f.name) for f in INGEST_SCHEMA]
    append_rows(spark.range(1, numPartitions=1).select(*columns), layout.ingests(table))


def facts_path(spark: SparkSession, layout: Layout, spec: TableSpec) -> str:
    """Where an append-only master lies; the folder tells its number of buckets."""
    buckets = _known_buckets(spark, layout, spec) or first_buckets(spark, layout)
    return f"{layout.master(spec.name)}/{_BUCKETS}{buckets}"


def first_buckets(spark: SparkSession, layout: Layout) -> int:
    """Buckets of an append-only master that is not there yet.

    As many as another one has, else those of the layout; doubled until the snapshots of the
    largest such table fit, so that all tables of a first load get the same number.
    """
    facts = [spec for spec in TABLES.values() if not spec.mutable]
    known = [n for n in (_known_buckets(spark, layout, spec) for spec in facts) if n]
    buckets = max(known, default=layout.buckets)
    largest = max(folder_bytes(spark, layout.snapshots(spec.name)) for spec in facts)
    while buckets * BUCKET_BYTES < largest:
        buckets *= 2
    return buckets


def _known_buckets(spark: SparkSession, layout: Layout, spec: TableSpec) -> int | None:
    known = [n for n in list_names(spark, layout.master(spec.name)) if n.startswith(_BUCKETS)]
    return int(known[0].removeprefix(_BUCKETS)) if known else None


def facts_table(spark: SparkSession, layout: Layout, spec: TableSpec, path: str | None = None) -> str:
    """Name in the catalog of an append-only master, declared there if it is not yet."""
    path = path or facts_path(spark, layout, spec)
    name = f"mestre_{spec.name}_{hashlib.md5(path.encode()).hexdigest()[:12]}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spec.schema)
    by, buckets = spec.split_column, path.rsplit("=", 1)[-1]
    location = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS `{name}` ({columns}, `{LOT}` string) USING parquet"
        f" CLUSTERED BY (`{by}`) SORTED BY (`{by}`) INTO {buckets} BUCKETS LOCATION '{location}'"
    )
    # Other sessions may have added files.
    spark.catalog.refreshTable(name)
    return name


def read_facts(
    spark: SparkSession, layout: Layout, spec: TableSpec, *, after: str | None = None, listed: bool = True
) -> DataFrame:
    """Rows of an append-only master, those of the lots after ``after``.

    Without ``listed`` also those of an append that is not complete. Buckets that have grown
    too large for a task each are left aside: joins shuffle the rows then, in partitions that
    adaptive execution sizes.
    """
    done, buckets = last_ingest(spark, layout, spec.name), _known_buckets(spark, layout, spec)
    if buckets is None or (listed and done is None):
        return empty(spark, spec.schema)
    path = facts_path(spark, layout, spec)
    if folder_bytes(spark, path) > buckets * FULL_BUCKET_BYTES:
        rows = spark.read.schema(T.StructType([*spec.schema.fields, T.StructField(LOT, T.StringType())])).parquet(path)
    else:
        rows = spark.table(facts_table(spark, layout, spec, path))
    if listed:
        rows = rows.where(F.col(LOT) <= F.lit(done))
    if after is not None:
        rows = rows.where(F.col(LOT) > F.lit(after))
    return rows.select(*spec.schema.fieldNames())


def write_facts(rows: DataFrame, layout: Layout, spec: TableSpec, lot: str, *, replace: bool = False) -> int:
    """Add rows to an append-only master, or make them all it holds; returns how many.

    One file per bucket, as the initial number of partitions is that of the buckets; Spark
    splits a bucket that is much larger than the others.
    """
    spark = rows.sparkSession
    path = facts_path(spark, layout, spec)
    name = facts_table(spark, layout, spec, path)
    laid = rows.select(*spec.schema.fieldNames(), F.lit(lot).alias(LOT))
    laid = laid.hint("rebalance", int(path.rsplit("=", 1)[-1]), spec.split_column)
    laid.write.insertInto(name, overwrite=replace)
    added = spark.table(name).where(F.col(LOT) == F.lit(lot)).count()
    record_ingest(spark, layout, spec.name, lot, "replace" if replace else "append", added)
    return added


def ranges_path(spark: SparkSession, layout: Layout, spec: TableSpec) -> str:
    """Where a mutable master lies; the folder tells the width of its ranges."""
    root = layout.master(spec.name)
    known = [n for n in list_names(spark, root) if n.startswith(_WIDTH)]
    return f"{root}/{known[0] if known else f'{_WIDTH}{layout.range_width}'}"


def key_range(spec: TableSpec, path: str) -> Column:
    """The range of a row's key; keys are numbers given one after the other."""
    width = int(path.rsplit("=", 1)[-1])
    return F.floor(F.col(spec.key[0]) / width).cast("long")


def read_ranges(spark: SparkSession, layout: Layout, spec: TableSpec, only: list | None = None) -> DataFrame:
    """Rows of a mutable master; with ``only`` those of some ranges, and no file of the others."""
    path = ranges_path(spark, layout, spec)
    if not list_names(spark, path):
        return empty(spark, spec.schema)
    rows = spark.read.schema(_with_range(spec)).parquet(path)
    if only is not None:
        wanted = F.col(RANGE).isin([r for r in only if r is not None])
        rows = rows.where(wanted | F.col(RANGE).isNull() if None in only else wanted)
    return rows.select(*spec.schema.fieldNames())


def write_ranges(rows: DataFrame, layout: Layout, spec: TableSpec, name: str, mode: str) -> int:
    """Overwrite the ranges that ``rows`` hold (``upsert``), or the whole master (``replace``).

    Returns how many rows were written.

    ``rows`` must be all rows of their ranges. They are written in full before a range is
    touched, so a failure in between loses nothing: :func:`finish_ranges` goes on.
    """
    spark = rows.sparkSession
    path = ranges_path(spark, layout, spec)
    laid = rows.withColumn(RANGE, key_range(spec, path)).hint("rebalance", RANGE)
    laid.write.mode("overwrite").partitionBy(RANGE).parquet(_redo(layout, spec, name, mode))
    return finish_ranges(spark, layout, spec)


def finish_ranges(spark: SparkSession, layout: Layout, spec: TableSpec) -> int:
    """Carry out what an upsert or replacement had written in full, and forget what had not.

    Returns how many rows that were.
    """
    folder, written_rows = f"{layout.master(spec.name)}/{_REDO}", 0
    done = last_ingest(spark, layout, spec.name) or ""
    for entry in list_names(spark, folder):
        written, (name, mode) = f"{folder}/{entry}", entry.rsplit(".", 1)
        if name > done and path_exists(spark, f"{written}/_SUCCESS"):
            rows = spark.read.schema(_with_range(spec)).parquet(written)
            writer = rows.hint("rebalance", RANGE).write.mode("overwrite").partitionBy(RANGE)
            kind = "static" if mode == "replace" else "dynamic"
            writer.option("partitionOverwriteMode", kind).parquet(ranges_path(spark, layout, spec))
            written_rows = rows.count()
            record_ingest(spark, layout, spec.name, name, mode, written_rows)
        delete_path(spark, written)
    return written_rows


def _redo(layout: Layout, spec: TableSpec, name: str, mode: str) -> str:
    return f"{layout.master(spec.name)}/{_REDO}/{name}.{mode}"


def _with_range(spec: TableSpec) -> T.StructType:
    return T.StructType([*spec.schema.fields, T.StructField(RANGE, T.LongType())])
