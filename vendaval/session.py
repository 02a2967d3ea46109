"""Session defaults the jobs rely on."""

from __future__ import annotations

import tempfile
from collections.abc import Mapping

from pyspark.sql import SparkSession

DEFAULTS = {
    # Watermarks travel as text between runs, so every session must read them alike.
    "spark.sql.session.timeZone": "UTC",
    # Runtime broadcast decisions, partition sizes and skew splits.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Masters bucketed by a part of the key serve joins on the whole key.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    # Window state outside the heap.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def session(app_name: str = "vendaval", settings: Mapping[str, str] | None = None) -> SparkSession:
    """A session with the defaults above; master and resources are left to the cluster."""
    builder = SparkSession.builder.appName(app_name)
    for name, value in (DEFAULTS | dict(settings or {})).items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local session may do without the setting; it gets a fresh temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder shared by all executors")
    return tempfile.mkdtemp(prefix="vendaval-")
