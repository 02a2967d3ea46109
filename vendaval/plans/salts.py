"""Which salt a layer's pseudonyms were made with: a fingerprint, never the salt itself."""

from __future__ import annotations

import hashlib

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vendaval.plans.layout import Layout
from vendaval.sources.versioned import publish, read_current

_SCHEMA = T.StructType([T.StructField("fingerprint", T.StringType())])


def fingerprint(salt: str | None) -> str:
    return hashlib.sha256(f"pseudonyms {salt or ''}".encode()).hexdigest()[:16]


def noted_salt(spark: SparkSession, layout: Layout, layer: str) -> str | None:
    """Fingerprint of the salt a layer was written with; none if it was never written."""
    row = read_current(spark, layout.salt(layer), _SCHEMA).first()
    return row["fingerprint"] if row else None


def note_salt(spark: SparkSession, layout: Layout, layer: str, salt: str | None) -> None:
    if noted_salt(spark, layout, layer) != fingerprint(salt):
        row = spark.range(1, numPartitions=1).select(F.lit(fingerprint(salt)).alias("fingerprint"))
        publish(row, layout.salt(layer))


def same_salt(layer: str, noted: str | None, other: str, wanted: str | None) -> None:
    """Pseudonyms of different salts never meet, so merging them would only look right."""
    if noted is not None and wanted is not None and noted != wanted:
        raise ValueError(f"the {layer} layer has pseudonyms of another salt than the {other} layer")
