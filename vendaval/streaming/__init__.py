"""Structured Streaming jobs."""

from vendaval.streaming.counts import StreamCounts, late_total, read_stream_counts
from vendaval.streaming.gold_refresh import start_gold_refresh
from vendaval.streaming.open_windows import all_windows, open_windows
from vendaval.streaming.speed_views import (
    late_rows,
    newer_than,
    read_rejected_events,
    read_stored_events,
    speed_view,
    speed_windows,
    start_event_store,
    start_speed_views,
    starting_cutoff,
)

__all__ = [
    "StreamCounts",
    "all_windows",
    "late_rows",
    "late_total",
    "newer_than",
    "open_windows",
    "read_rejected_events",
    "read_stored_events",
    "read_stream_counts",
    "speed_view",
    "speed_windows",
    "start_event_store",
    "start_gold_refresh",
    "start_speed_views",
    "starting_cutoff",
]
