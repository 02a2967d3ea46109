"""Gold views kept fresh by the speed views themselves."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from vendaval.plans.gold_views import event_store, refresh_gold_views, speed_store
from vendaval.plans.layout import Layout
from vendaval.streaming.speed_views import read_stored_events


def start_gold_refresh(
    spark: SparkSession,
    layout: Layout,
    *,
    exact: bool = False,
    salt: str | None = None,
    trigger: Mapping[str, Any] | None = None,
) -> StreamingQuery:
    """Refresh the gold views whenever a micro-batch has stored windows, instead of in a loop.

    With ``exact`` whenever it has stored events, and from these, sale by sale. The refresh
    reads all layers as they are at that moment, so running it again for the same files
    changes nothing; the new files only say that it is time. The folder they come to must
    exist. A refresh after a new batch view is the batch job's to ask for.
    """
    store = event_store(layout) if exact else speed_store(layout)

    def refresh(_rows, _batch_id) -> None:
        recent = {"recent_sales": read_stored_events(spark, layout), "salt": salt} if exact else {}
        for outcome in refresh_gold_views(spark, layout, **recent):
            if outcome.error is not None:
                raise outcome.error

    writer = (
        # Only that there are new files matters, not what is in them.
        spark.readStream.schema(T.StructType(store.schema.fields[:1]))
        .parquet(f"{store.root}/open")
        .writeStream.queryName("gold_views")
        .foreachBatch(refresh)
        .option("checkpointLocation", layout.gold_checkpoint)
    )
    return (writer.trigger(**trigger) if trigger else writer).start()
