"""Batch views: the three rollups over the sales master, kept up commit by commit."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession

from vendaval.operators.rollup import merge_states, rollup, sales_state, view_of_state
from vendaval.plans.layout import Layout
from vendaval.plans.masters import last_ingest, last_replacement, read_facts
from vendaval.plans.outcomes import Outcome, run_each
from vendaval.plans.salts import note_salt
from vendaval.sources.versioned import last_state, publish, read_current
from vendaval.specs import TABLES, VIEWS, ViewSpec

log = logging.getLogger(__name__)


def batch_view(sales: DataFrame, view: ViewSpec, salt: str | None = None) -> DataFrame:
    """One batch view. Only the three columns it needs are read from the master."""
    return rollup(sales, view, "total", salt=salt)


def read_batch_view(spark: SparkSession, layout: Layout, view: ViewSpec) -> DataFrame:
    return read_current(spark, layout.batch_view(view.name), view.batch_schema)


def refresh_batch_views(
    spark: SparkSession,
    layout: Layout,
    *,
    salt: str | None = None,
    full: bool = False,
    workers: int = 3,
) -> list[Outcome]:
    """Publish the batch views, each stored in the order of its key.

    Each view keeps a state per raw key. The sales master only grows, so just the lots since
    the last refresh are read and merged into it. A master that was replaced since, or
    ``full``, starts a new state from all sales.
    """
    spec = TABLES["vendas"]
    newest = last_ingest(spark, layout, spec.name)
    if newest is None:
        log.info("no sales master yet, batch views left as they are")
        return []
    note_salt(spark, layout, "batch", salt)
    replaced = last_replacement(spark, layout, spec.name) or ""

    def refresh(name: str) -> Outcome:
        view = VIEWS[name]
        kept = layout.batch_state(name)
        done = last_state(spark, kept)
        if full or (done is not None and done < replaced):
            done = None
        if done is None or done < newest:
            state = sales_state(read_facts(spark, layout, spec, after=done), view, "total")
            if done is not None:
                stored = read_current(spark, kept, view.state_schema)
                state = merge_states(stored.unionByName(state), view)
            publish(state, kept, newest)
        rows = view_of_state(read_current(spark, kept, view.state_schema), view, salt)
        return Outcome(name, path=publish(rows.orderBy(view.key), layout.batch_view(name)))

    return run_each(spark, refresh, VIEWS, workers=workers)
