"""The sales rollup behind the batch, speed and gold views."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vendaval.functions import EVENT_TOTAL, TOTAL, mean_money, pseudonym, sum_money
from vendaval.specs import ViewSpec


def rollup(
    sales: DataFrame,
    view: ViewSpec,
    amount: str,
    *,
    id_column: str = "id_venda",
    window: Column | None = None,
    salt: str | None = None,
    wide: bool = False,
) -> DataFrame:
    """Highest id, number, sum and mean of the sales per view key.

    Works on batch and streaming frames. Groups on the raw identifier and hashes the
    finished groups: one hash per key instead of one per sale. Every aggregate has a
    partial form, so a key that holds a third of the sales leaves each map task as a
    single row. With ``window`` the groups are per window and key, and ``menor_id``
    (the lowest id) is kept too, which shows windows that straddle a batch cutoff.
    ``wide`` is for amounts from outside, which may be longer than the tables' own.
    """
    key = F.col(view.source_key)
    keys = [(key.cast(view.key_type) if not view.hashed else key).alias("_key")]
    aggregates = [
        F.max(id_column).cast("long").alias("maior_id"),
        F.count(id_column).alias("qtd_vendas"),
        sum_money(amount, EVENT_TOTAL if wide else TOTAL).alias(view.total),
        F.count(amount).alias("_amounts"),
    ]
    columns = ["maior_id", "qtd_vendas", view.total]
    if window is not None:
        keys.insert(0, window.alias("window"))
        aggregates.append(F.min(id_column).cast("long").alias("menor_id"))
        columns.insert(1, "menor_id")

    grouped = sales.groupBy(*keys).agg(*aggregates)
    view_key = pseudonym("_key", salt) if view.hashed else F.col("_key")
    return grouped.select(
        *(["window"] if window is not None else []),
        view_key.alias(view.key),
        *columns,
        mean_money(view.total, "_amounts", wide=wide).alias("ticket_medio"),
    )


def rollup_views(
    sales: DataFrame,
    views: Iterable[ViewSpec],
    amount: str,
    window: Column,
    *,
    id_column: str = "id_venda",
    salt: str | None = None,
) -> DataFrame:
    """The windowed rollups of several views in one aggregation: (window, visao, chave, ...).

    Each sale becomes a row per view with the view's key as text, so one pass over the sales,
    and on a stream one source and one state, serve all views. Partial aggregates take the
    added rows back before the shuffle. :func:`rows_of_view` gives a view its own columns.
    """
    views = list(views)
    entries = [F.struct(F.lit(v.name).alias("visao"), F.col(v.source_key).cast("string").alias("chave")) for v in views]
    expanded = sales.withColumn("_view", F.explode(F.array(*entries)))
    grouped = expanded.groupBy(
        window.alias("window"), F.col("_view.visao").alias("visao"), F.col("_view.chave").alias("_key")
    ).agg(
        F.max(id_column).cast("long").alias("maior_id"),
        F.min(id_column).cast("long").alias("menor_id"),
        F.count(id_column).alias("qtd_vendas"),
        sum_money(amount, EVENT_TOTAL).alias("total"),
        F.count(amount).alias("_amounts"),
    )
    return finished_windows(grouped, views, salt)


def finished_windows(grouped: DataFrame, views: Iterable[ViewSpec], salt: str | None = None) -> DataFrame:
    """Pseudonyms and means of the grouped rows of :func:`rollup_views`."""
    hashed = F.col("visao").isin([v.name for v in views if v.hashed])
    return grouped.select(
        "visao",
        "window",
        F.when(hashed, pseudonym("_key", salt)).otherwise(F.col("_key")).alias("chave"),
        "maior_id",
        "menor_id",
        "qtd_vendas",
        "total",
        mean_money("total", "_amounts", wide=True).alias("ticket_medio"),
    )


def rows_of_view(rows: DataFrame, view: ViewSpec) -> DataFrame:
    """One view's rows of :func:`rollup_views`, with its own columns."""
    return rows.where(F.col("visao") == view.name).select(
        "window",
        F.col("chave").cast(view.key_type).alias(view.key),
        "maior_id",
        "menor_id",
        "qtd_vendas",
        F.col("total").alias(view.total),
        "ticket_medio",
    )


def sales_state(sales: DataFrame, view: ViewSpec, amount: str) -> DataFrame:
    """What a batch view is made of, per raw key; states of disjoint sales merge exactly."""
    key = F.col(view.source_key)
    return sales.groupBy(key.cast(view.state_type).alias("_key")).agg(
        F.max("id_venda").cast("long").alias("maior_id"),
        F.count("id_venda").alias("qtd_vendas"),
        sum_money(amount).alias(view.total),
        F.count(amount).alias("_amounts"),
    )


def merge_states(states: DataFrame, view: ViewSpec) -> DataFrame:
    return states.groupBy("_key").agg(
        F.max("maior_id").alias("maior_id"),
        F.sum("qtd_vendas").alias("qtd_vendas"),
        F.sum(view.total).cast(TOTAL).alias(view.total),
        F.sum("_amounts").alias("_amounts"),
    )


def view_of_state(state: DataFrame, view: ViewSpec, salt: str | None = None) -> DataFrame:
    return state.select(
        (pseudonym("_key", salt) if view.hashed else F.col("_key")).alias(view.key),
        "maior_id",
        "qtd_vendas",
        view.total,
        mean_money(view.total, "_amounts").alias("ticket_medio"),
    )


def highest_id(view_rows: DataFrame, column: str = "maior_id") -> DataFrame:
    """One row with the highest id of a view: a partial max, no sort."""
    return view_rows.agg(F.max(column).alias(column))


def view_since(view_rows: DataFrame, moment: str, column: str = "data") -> DataFrame:
    """Rows of a view or table strictly after a date or timestamp, in its order."""
    return view_rows.where(F.col(column) > F.lit(moment)).orderBy(column)
