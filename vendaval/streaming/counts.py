"""Counts of a stream that outlive its process: rows read, rows too late, per query."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from vendaval.plans.layout import Layout
from vendaval.sources.versioned import publish, read_current
from vendaval.specs import STREAM_COUNTS_SCHEMA


def read_stream_counts(spark: SparkSession, layout: Layout) -> DataFrame:
    """(consulta, nome, micro, lidas, atrasadas): a row per query, over all its runs."""
    return read_current(spark, layout.stream_counts, STREAM_COUNTS_SCHEMA)


class StreamCounts(StreamingQueryListener):
    """Adds every micro-batch's counts to a small table, one row per query.

    ``spark.streams.recentProgress`` forgets after a hundred micro-batches and with its
    process; a query keeps its id over restarts, so its row goes on. Progress comes once per
    micro-batch and in order; a micro-batch already counted is not counted again.
    """

    def __init__(self, spark: SparkSession, layout: Layout):
        self.spark, self.layout = spark, layout

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        late = sum(operator.numRowsDroppedByWatermark for operator in progress.stateOperators)
        self.count(str(progress.id), progress.name, progress.batchId, progress.numInputRows, late)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def count(self, query: str, name: str | None, batch: int, read: int, late: int) -> None:
        known = {r["consulta"]: r for r in read_stream_counts(self.spark, self.layout).collect()}
        before = known.pop(query, None)
        if before is not None and before["micro"] >= batch:
            # An idle trigger reports the last micro-batch again.
            return
        sums = (before["lidas"] + read, before["atrasadas"] + late) if before else (read, late)
        rows = [tuple(r) for r in known.values()] + [(query, name, batch, *sums)]
        table = self.spark.createDataFrame(rows, STREAM_COUNTS_SCHEMA).coalesce(1)
        publish(table, self.layout.stream_counts)


def late_total(spark: SparkSession, layout: Layout) -> int:
    counts = read_stream_counts(spark, layout)
    return counts.agg(F.coalesce(F.sum("atrasadas"), F.lit(0))).first()[0]
