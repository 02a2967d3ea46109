"""Parquet reads that tolerate missing data, and the few path operations jobs need."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """No rows, in a form the optimizer recognises, so joins with it vanish from the plan."""
    columns = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema]
    return spark.range(0).where(F.lit(False)).select(*columns)


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Parquet at ``path``, or an empty frame of that schema when nothing is there yet.

    Data that is there but cannot be read is an error.
    """
    if not path_exists(spark, path):
        return empty(spark, schema)
    return spark.read.schema(schema).parquet(path)


def read_snapshots(
    spark: SparkSession, schema: T.StructType, paths: Sequence[str]
) -> DataFrame:
    """All snapshots of one table as one scan, columns aligned by name.

    A snapshot that lacks a column is an error, not a column of nulls.
    """
    if not paths:
        return empty(spark, schema)
    for path in paths:  # footers only
        missing = set(schema.fieldNames()) - set(spark.read.parquet(path).columns)
        if missing:
            raise ValueError(f"{path} lacks the columns {', '.join(sorted(missing))}")
    return spark.read.schema(schema).parquet(*paths)


def _resolve(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop = _resolve(spark, path)
    return fs.exists(hadoop)


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly under a directory, sorted; empty when it does not exist."""
    fs, hadoop = _resolve(spark, path)
    if not fs.exists(hadoop):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(hadoop))


def folder_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of all files under a directory; none when it does not exist."""
    fs, hadoop = _resolve(spark, path)
    return fs.getContentSummary(hadoop).getLength() if fs.exists(hadoop) else 0


def delete_path(spark: SparkSession, path: str) -> bool:
    fs, hadoop = _resolve(spark, path)
    return fs.delete(hadoop, True)
