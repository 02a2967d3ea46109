"""Windows the speed views have not emitted yet, read from the query's own checkpoint."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vendaval.functions import EVENT_TOTAL, money_of_parts
from vendaval.operators.rollup import finished_windows
from vendaval.plans.gold_views import speed_store
from vendaval.plans.layout import Layout
from vendaval.sources.files import empty, list_names
from vendaval.specs import VIEWS, WINDOW_SCHEMA

# The buffers of the aggregation of ``rollup_views``, in its order: sums of money are two.
_BUFFERS = "struct<maior_id: bigint, menor_id: bigint, qtd_vendas: bigint, high: bigint, low: bigint, n: bigint>"
_KEY = "struct<window: struct<start: timestamp, end: timestamp>, visao: string, chave: string>"


def open_windows(spark: SparkSession, layout: Layout, *, salt: str | None = None) -> DataFrame:
    """Rows like those of the speed store, for the windows still in the stream's state.

    Read with Spark's state store reader as of the last micro-batch that is complete. One that
    was stored and not completed may have emitted some of these windows; what is stored
    counts, so every window is in either the store or here.
    """
    if not list_names(spark, f"{layout.speed_checkpoint}/state"):
        return empty(spark, WINDOW_SCHEMA)
    state = spark.read.format("statestore").load(layout.speed_checkpoint)
    named = state.select(F.col("key").cast(_KEY).alias("k"), F.col("value").cast(_BUFFERS).alias("v"))
    grouped = named.select(
        "k.visao",
        "k.window",
        F.col("k.chave").alias("_key"),
        "v.maior_id",
        "v.menor_id",
        "v.qtd_vendas",
        money_of_parts("v.high", "v.low", EVENT_TOTAL).alias("total"),
        F.col("v.n").alias("_amounts"),
    )
    waiting = finished_windows(grouped, VIEWS.values(), salt).withColumn("dia", F.to_date("window.start"))
    waiting = waiting.select(*WINDOW_SCHEMA.fieldNames())
    _, closed = speed_store(layout).mark(spark)
    stored = speed_store(layout).read(spark, after=closed).alias("s")
    alike = F.col("w.chave").eqNullSafe(F.col("s.chave"))
    for column in ("visao", "window"):
        alike &= F.col(f"w.{column}") == F.col(f"s.{column}")
    return waiting.alias("w").join(stored, alike, "left_anti")


def all_windows(spark: SparkSession, layout: Layout, *, salt: str | None = None) -> DataFrame:
    """Stored and open windows together: everything the stream has read so far."""
    return speed_store(layout).read(spark).unionByName(open_windows(spark, layout, salt=salt))
