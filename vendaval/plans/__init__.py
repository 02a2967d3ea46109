"""Jobs: extract, ingest, batch views, gold views and reports."""

from vendaval.plans.batch_views import batch_view, refresh_batch_views
from vendaval.plans.extract import extract_all, extract_table, purge_snapshots
from vendaval.plans.gold_views import (
    exact_gold_view,
    gold_view,
    refresh_gold_views,
    straddling_windows,
)
from vendaval.plans.ingest import ingest_all, ingest_table, read_master
from vendaval.plans.layout import Layout
from vendaval.plans.sql_views import register_views

__all__ = [
    "Layout",
    "batch_view",
    "exact_gold_view",
    "extract_all",
    "extract_table",
    "gold_view",
    "ingest_all",
    "ingest_table",
    "purge_snapshots",
    "read_master",
    "refresh_batch_views",
    "refresh_gold_views",
    "register_views",
    "straddling_windows",
]
