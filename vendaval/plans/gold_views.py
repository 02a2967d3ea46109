"""Gold views: a batch view completed with the newer sales of the speed layer."""

from __future__ import annotations

import logging
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vendaval.functions import event_money, mean_money
from vendaval.operators.rollup import rollup, rows_of_view
from vendaval.plans.batch_views import read_batch_view
from vendaval.plans.layout import Layout
from vendaval.plans.outcomes import Outcome, run_each
from vendaval.plans.salts import fingerprint, noted_salt, same_salt
from vendaval.sources.day_store import DayStore
from vendaval.sources.versioned import last_state, publish, read_current
from vendaval.specs import EVENT_STORE_SCHEMA, VIEWS, WINDOW_SCHEMA, ViewSpec

log = logging.getLogger(__name__)


def beyond_batch(id_column: str, batch: DataFrame) -> Column:
    """Whether an id is beyond a batch view; every id is, if the view is empty.

    The view's highest id is a scalar subquery inside the plan that uses it.
    """
    cutoff = batch.agg(F.max("maior_id").alias("maior_id")).scalar()
    return F.col(id_column).isNotNull() & (cutoff.isNull() | (F.col(id_column) > cutoff))


def gold_view(batch: DataFrame, speed: DataFrame, view: ViewSpec) -> DataFrame:
    """Batch rows plus the speed windows that end beyond the batch, merged per key.

    Keeps the contract of the serving layer: totals in whole units and the plain mean of
    the window means. Windows are taken whole, so one that straddles the cutoff counts its
    older sales again; :func:`straddling_windows` finds them and :func:`exact_gold_view`
    avoids them. Sums are decimal until the last step.
    """
    newer = speed.where(beyond_batch("maior_id", batch))
    return view_of_gold_state(gold_state(batch, view).unionByName(gold_state(newer, view)), view)


def gold_state(rows: DataFrame, view: ViewSpec) -> DataFrame:
    """What batch rows or windows add to a gold view, one row each; states add up per key."""
    return rows.select(
        view.key,
        "qtd_vendas",
        F.col(view.total).cast("decimal(38,2)").alias(view.total),
        F.col("ticket_medio").cast("decimal(38,2)").alias("_tickets"),
        F.col("ticket_medio").isNotNull().cast("long").alias("_means"),
    )


def merge_gold_states(states: DataFrame, view: ViewSpec) -> DataFrame:
    columns = ["qtd_vendas", view.total, "_tickets", "_means"]
    kinds = {f.name: f.dataType for f in view.gold_state_schema}
    return states.groupBy(view.key).agg(*[F.sum(c).cast(kinds[c]).alias(c) for c in columns])


def view_of_gold_state(states: DataFrame, view: ViewSpec) -> DataFrame:
    """Totals in whole units and the mean of the means, from states of any number per key."""
    mean = (F.col("_tickets") / F.nullif(F.col("_means"), F.lit(0))).cast("decimal(25,6)")
    return merge_gold_states(states, view).select(
        view.key,
        "qtd_vendas",
        F.col(view.total).cast("long").alias(view.total),
        F.round(mean, 2).cast("double").alias("ticket_medio"),
    )


def exact_gold_view(
    batch: DataFrame,
    recent_sales: DataFrame,
    view: ViewSpec,
    amount: str,
    *,
    id_column: str = "id_venda",
    salt: str | None = None,
) -> DataFrame:
    """Batch rows plus every sale with an id beyond the batch, merged per key.

    Sales are cut at the batch's highest id one by one, so none counts twice, cents are
    kept, and the mean is total over count. ``recent_sales`` may hold older sales as well.
    """
    newer = recent_sales.where(beyond_batch(id_column, batch))
    newer = newer.withColumn(amount, event_money(amount))
    columns = [view.key, "qtd_vendas", view.total]
    recent = rollup(newer, view, amount, id_column=id_column, salt=salt, wide=True)
    return (
        batch.select(*columns)
        .unionByName(recent.select(*columns))
        .groupBy(view.key)
        .agg(F.sum("qtd_vendas").alias("qtd_vendas"), F.sum(view.total).alias(view.total))
        .withColumn("ticket_medio", mean_money(view.total, "qtd_vendas", wide=True))
    )


def straddling_windows(batch: DataFrame, speed: DataFrame) -> DataFrame:
    """Speed windows with sales on both sides of the batch cutoff."""
    return speed.where(~beyond_batch("menor_id", batch) & beyond_batch("maior_id", batch))


def speed_store(layout: Layout, fold_every: int = 64) -> DayStore:
    """Where the windows of all speed views are kept."""
    return DayStore(layout.speed_windows, WINDOW_SCHEMA, by="visao", fold_every=fold_every)


def read_speed_view(
    spark: SparkSession, layout: Layout, view: ViewSpec, after: date | None = None, upto: date | None = None
) -> DataFrame:
    """Windows of a speed view; with ``after`` and ``upto`` those of some days."""
    return rows_of_view(speed_store(layout).read(spark, after, upto), view)


def refresh_gold_view(
    spark: SparkSession,
    layout: Layout,
    view: ViewSpec,
    *,
    recent_sales: DataFrame | None = None,
    amount: str = "valor_total",
    salt: str | None = None,
) -> Outcome:
    """Publish one gold view; exact when the recent raw sales are given.

    A state per key holds the batch view and the windows of all closed days beyond it. A
    refresh adds the days closed since, and puts the windows of the open days on top: only
    these are read. A new batch view starts a new state.
    """
    of_batch = last_state(spark, layout.batch_view(view.name))
    if of_batch is None:
        log.info("%s: no batch view yet, gold view left as it is", view.name)
        return Outcome(view.name)
    noted = noted_salt(spark, layout, "batch")
    batch = read_batch_view(spark, layout, view)
    if recent_sales is not None:
        same_salt("batch", noted, "given", fingerprint(salt))
        rows = exact_gold_view(batch, recent_sales, view, amount, salt=salt)
    else:
        same_salt("batch", noted, "speed", noted_salt(spark, layout, "speed"))
        closed = _closed_days(spark, layout, view, batch, of_batch)
        newer = read_speed_view(spark, layout, view, after=closed).where(beyond_batch("maior_id", batch))
        kept = read_current(spark, layout.gold_state(view.name), view.gold_state_schema)
        rows = view_of_gold_state(kept.unionByName(gold_state(newer, view)), view)
    return Outcome(view.name, path=publish(rows.orderBy(view.key), layout.gold_view(view.name)))


def _closed_days(
    spark: SparkSession, layout: Layout, view: ViewSpec, batch: DataFrame, of_batch: str
) -> date | None:
    """Bring the state of a gold view up to the last closed day, and return that day."""
    _, closed = speed_store(layout).mark(spark)
    path = layout.gold_state(view.name)
    wanted = f"{of_batch}.{closed or date.min}"
    known = last_state(spark, path)
    if known != wanted:
        begun, _, until = (known or ".").partition(".")
        done = date.fromisoformat(until) if begun == of_batch else None
        state = gold_state(batch, view)
        if done is not None:
            state = read_current(spark, path, view.gold_state_schema)
        if closed is not None:
            after = None if done in (None, date.min) else done
            windows = read_speed_view(spark, layout, view, after=after, upto=closed)
            windows = windows.where(beyond_batch("maior_id", batch))
            state = state.unionByName(gold_state(windows, view))
        publish(merge_gold_states(state, view), path, wanted)
    return closed


def purge_speed(spark: SparkSession, layout: Layout) -> dict[str, list[str]]:
    """Delete the days of speed windows and stored events that lie wholly within the batch views.

    Nothing reads them any more: gold views take what is beyond the least of the batch views'
    highest ids. Run after the batch views are published.
    """
    ends = [read_batch_view(spark, layout, v).agg(F.max("maior_id")).first()[0] for v in VIEWS.values()]
    if any(end is None for end in ends):
        return {}
    return {
        "windows": speed_store(layout).purge(spark, "maior_id", min(ends)),
        "events": event_store(layout).purge(spark, "id_venda", min(ends)),
    }


def event_store(layout: Layout, fold_every: int = 64) -> DayStore:
    """Where the accepted sale events are kept; late ones may belong to any day."""
    return DayStore(layout.events, EVENT_STORE_SCHEMA, closes=False, fold_every=fold_every)


def refresh_gold_views(
    spark: SparkSession, layout: Layout, *, workers: int = 3, **options
) -> list[Outcome]:
    """Publish every gold view once. Repetition belongs to the caller or to the stream."""
    return run_each(
        spark,
        lambda name: refresh_gold_view(spark, layout, VIEWS[name], **options),
        VIEWS,
        workers=workers,
    )
