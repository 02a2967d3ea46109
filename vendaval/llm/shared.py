"""What several operators need: word pattern, kept tables, running totals, task batches."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vendaval.session import shared_folder
from vendaval.sources.files import delete_path

#: A word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def keep(rows: DataFrame, name: str) -> DataFrame:
    """``rows`` written to the shared folder and read again: lineage ends here.

    The files are plain Parquet in the folder ``spark.checkpoint.dir`` names, so they
    outlive lost executors.
    """
    spark = rows.sparkSession
    path = f"{shared_folder(spark)}/llm_{name}_{uuid.uuid4().hex}"
    rows.write.parquet(path)
    kept = spark.read.schema(rows.schema).parquet(path)
    kept.kept_path = path
    return kept


def discard(kept: DataFrame) -> None:
    """Delete what ``keep`` wrote; only once nothing that still runs reads it."""
    delete_path(kept.sparkSession, kept.kept_path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: Column, remainder: int) -> Column:
    """Whether crc32 of the id as text leaves ``remainder`` mod 5; a null id is not held out."""
    found = F.crc32(doc_id.cast("string").cast("binary")) % 5 == remainder
    return F.coalesce(found, F.lit(False))


def running_total(
    rows: DataFrame, group: str, order: Sequence[str], amount: str, out: str, buckets: int = 1024
) -> DataFrame:
    """Adds ``out``: the sum of ``amount`` over the rows of the group that come before.

    A group is laid out as ``buckets`` hash buckets of its ``order`` values, one after the
    other and each sorted by ``order``, so no window holds more than a bucket and a group
    with a third of all rows spreads over 1024 of them. Totals of the buckets (one row per
    group and bucket) give each bucket its start. ``group`` must not be null. Rows alike in
    ``order`` share a bucket and stand in any order.
    """
    bucketed = rows.withColumn("__bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)))
    sums = bucketed.groupBy(group, "__bucket").agg(F.sum(amount).alias("__sum"))
    earlier = Window.partitionBy(group).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(
        group, "__bucket", F.coalesce(F.sum("__sum").over(earlier), F.lit(0)).alias("__start")
    )
    within = (
        Window.partitionBy(group, "__bucket")
        .orderBy(*[F.col(c).asc_nulls_last() for c in order])
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    numbered = bucketed.withColumn("__before", F.coalesce(F.sum(amount).over(within), F.lit(0)))
    joined = numbered.join(starts, [group, "__bucket"])
    return joined.select(*rows.columns, (F.col("__start") + F.col("__before")).alias(out))
