"""Speed views: the three rollups over ten-second windows of the sales stream."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from vendaval.functions import event_money
from vendaval.operators.rollup import highest_id, rollup, rollup_views
from vendaval.plans.batch_views import read_batch_view
from vendaval.plans.gold_views import event_store, speed_store
from vendaval.plans.layout import Layout
from vendaval.plans.salts import fingerprint, note_salt, noted_salt, same_salt
from vendaval.sources.day_store import DayStore
from vendaval.sources.events import decode_events, quarantined_events
from vendaval.specs import (
    DAILY_REVENUE,
    REJECTED_SCHEMA,
    VIEWS,
    WATERMARK_DELAY,
    WINDOW,
    ViewSpec,
)


def starting_cutoff(spark: SparkSession, layout: Layout) -> int | None:
    """Highest sale id the batch layer covers, read once when the stream starts; else None."""
    return highest_id(read_batch_view(spark, layout, DAILY_REVENUE)).first()["maior_id"]


def newer_than(events: DataFrame, cutoff: int | None, id_column: str = "id_venda") -> DataFrame:
    """Events beyond the batch, or all with an id if there is no batch yet."""
    identified = events.where(F.col(id_column).isNotNull())
    return identified if cutoff is None else identified.where(F.col(id_column) > F.lit(cutoff))


def speed_view(
    events: DataFrame,
    view: ViewSpec,
    *,
    amount: str = "valor_total",
    id_column: str = "id_venda",
    time_column: str = "timestamp",
    window: str = WINDOW,
    delay: str = WATERMARK_DELAY,
    salt: str | None = None,
) -> DataFrame:
    """One speed view, over a stream or over stored events.

    The watermark only acts on streams: a window is emitted once the watermark has passed
    its end, and events behind the watermark are dropped. An event whose amount cannot be
    an amount still counts as a sale.
    """
    if events.isStreaming:
        events = events.withWatermark(time_column, delay)
    return rollup(
        events.withColumn(amount, event_money(amount)),
        view,
        amount,
        id_column=id_column,
        window=F.window(time_column, window),
        salt=salt,
        wide=True,
    )


def speed_windows(
    events: DataFrame,
    *,
    amount: str = "valor_total",
    id_column: str = "id_venda",
    time_column: str = "timestamp",
    window: str = WINDOW,
    delay: str = WATERMARK_DELAY,
    salt: str | None = None,
) -> DataFrame:
    """The windows of all three speed views, from one pass over the events."""
    if events.isStreaming:
        events = events.withWatermark(time_column, delay)
    return rollup_views(
        events.withColumn(amount, event_money(amount)),
        VIEWS.values(),
        amount,
        F.window(time_column, window),
        id_column=id_column,
        salt=salt,
    )


def start_speed_views(
    events: DataFrame,
    layout: Layout,
    *,
    trigger: Mapping[str, Any] | None = None,
    fold_every: int = 64,
    salt: str | None = None,
) -> StreamingQuery:
    """Start the one query that keeps the three speed views.

    ``events`` are decoded sale events, already cut with :func:`newer_than`. They are read
    once: a single stateful aggregation serves all views. Closed windows go to a store by day,
    a micro-batch at a time; one that is repeated after a failure adds nothing, and every
    ``fold_every`` micro-batches their files are folded into few.
    """
    spark = events.sparkSession
    same_salt("speed", noted_salt(spark, layout, "speed"), "given", fingerprint(salt))
    note_salt(spark, layout, "speed", salt)
    store = speed_store(layout, fold_every)

    def add(rows: DataFrame, batch_id: int) -> None:
        store.add(rows.withColumn("dia", F.to_date("window.start")), batch_id)

    writer = (
        speed_windows(events, salt=salt)
        .writeStream.queryName("speed_views")
        .outputMode("append")
        .foreachBatch(add)
        .option("checkpointLocation", layout.speed_checkpoint)
    )
    return (writer.trigger(**trigger) if trigger else writer).start()


def start_event_store(
    records: DataFrame,
    layout: Layout,
    *,
    trigger: Mapping[str, Any] | None = None,
    fold_every: int = 64,
) -> StreamingQuery:
    """Store the decoded events by day, and apart from them the records quarantined.

    ``records`` are (value, timestamp), read once for both. The events serve exact gold
    views; the quarantined records, with their reason, are there to be counted and looked at.
    """
    accepted = event_store(layout, fold_every)
    rejected = rejected_store(layout, fold_every)
    day = F.to_date("timestamp")

    def add(rows: DataFrame, batch_id: int) -> None:
        rows = rows.persist()
        try:
            events = decode_events(rows).where(F.col("id_venda").isNotNull())
            accepted.add(events.withColumn("dia", day), batch_id)
            rejected.add(quarantined_events(rows).withColumn("dia", day), batch_id)
        finally:
            rows.unpersist()

    writer = (
        records.writeStream.queryName("events")
        .foreachBatch(add)
        .option("checkpointLocation", layout.event_checkpoint)
    )
    return (writer.trigger(**trigger) if trigger else writer).start()


def rejected_store(layout: Layout, fold_every: int = 64) -> DayStore:
    return DayStore(layout.rejected_events, REJECTED_SCHEMA, closes=False, fold_every=fold_every)


def read_stored_events(spark: SparkSession, layout: Layout) -> DataFrame:
    return event_store(layout).read(spark).drop("dia")


def read_rejected_events(spark: SparkSession, layout: Layout) -> DataFrame:
    return rejected_store(layout).read(spark).drop("dia")


def late_rows(query: StreamingQuery) -> int:
    """Rows the query dropped for being behind the watermark, in its retained progress.

    :class:`StreamCounts` keeps the numbers of all progress, also over restarts.
    """
    return sum(
        operator["numRowsDroppedByWatermark"]
        for progress in query.recentProgress
        for operator in progress["stateOperators"]
    )
