"""Parquet datasets replaced without readers seeing a half-written state.

A state lies in a folder of its own and counts once Spark has written its ``_SUCCESS`` marker;
readers take the newest one that counts. Names must sort in the order of the writes;
repeating a write under the same name overwrites it, which makes a rerun after a failure
safe. One writer per dataset.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from vendaval.sources.files import delete_path, empty, list_names, path_exists

_STATE = "state="


def run_name(moment: datetime | None = None) -> str:
    """Sortable name of a run, to the microsecond, in UTC."""
    return (moment or datetime.now(timezone.utc)).strftime("%Y%m%dT%H%M%S%f")


def last_state(spark: SparkSession, root: str) -> str | None:
    """Name of the state readers see."""
    names = [n for n in list_names(spark, root) if n.startswith(_STATE)]
    while names and not path_exists(spark, f"{root}/{names[-1]}/_SUCCESS"):
        names.pop()
    return names[-1].removeprefix(_STATE) if names else None


def read_current(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """The dataset as last published; empty when nothing was."""
    name = last_state(spark, root)
    if name is None:
        return empty(spark, schema)
    return spark.read.schema(schema).parquet(f"{root}/{_STATE}{name}")


def publish(rows: DataFrame, root: str, name: str | None = None) -> str:
    """Replace the dataset; the state before stays for running readers, older ones go."""
    spark = rows.sparkSession
    before = last_state(spark, root)
    name = name or run_name()
    path = f"{root}/{_STATE}{name}"
    rows.write.mode("overwrite").parquet(path)
    for folder in list_names(spark, root):
        if _STATE <= folder < f"{_STATE}{before or name}":
            delete_path(spark, f"{root}/{folder}")
    return path


def append_rows(rows: DataFrame, root: str) -> None:
    """Add a few rows to the current state; Spark makes the new files visible together."""
    name = last_state(rows.sparkSession, root)
    if name is None:
        publish(rows, root)
    else:
        rows.write.mode("append").parquet(f"{root}/{_STATE}{name}")
