"""Where the jobs keep their datasets."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Layout:
    """Paths under one root, which all executors must be able to reach.

    ``buckets`` and ``range_width`` count when a master is first written. ``buckets`` is the least
    number: a first load that is larger gets more, see :func:`vendaval.plans.masters.first_buckets`.
    Choose more yourself if later loads will be many times the first, and so many keys to
    a range that its rows make one file of a few hundred MB. An existing master keeps its own.
    """

    root: str
    buckets: int = 8
    range_width: int = 1_000_000

    @property
    def manifest(self) -> str:
        return f"{self.root}/snapshots/manifest"

    def snapshots(self, table: str) -> str:
        return f"{self.root}/snapshots/{table}"

    def master(self, table: str) -> str:
        return f"{self.root}/masters/{table}"

    def ingests(self, table: str) -> str:
        return f"{self.root}/ingests/{table}"

    def batch_view(self, view: str) -> str:
        return f"{self.root}/views/batch/{view}"

    def batch_state(self, view: str) -> str:
        return f"{self.root}/views/batch_states/{view}"

    def salt(self, layer: str) -> str:
        return f"{self.root}/views/salts/{layer}"

    @property
    def events(self) -> str:
        return f"{self.root}/events/accepted"

    @property
    def rejected_events(self) -> str:
        return f"{self.root}/events/rejected"

    @property
    def event_checkpoint(self) -> str:
        return f"{self.root}/events/checkpoint"

    @property
    def speed_windows(self) -> str:
        return f"{self.root}/views/speed"

    @property
    def speed_checkpoint(self) -> str:
        return f"{self.root}/views/speed_checkpoint"

    @property
    def stream_counts(self) -> str:
        return f"{self.root}/views/stream_counts"

    def gold_view(self, view: str) -> str:
        return f"{self.root}/views/gold/{view}"

    def gold_state(self, view: str) -> str:
        return f"{self.root}/views/gold_states/{view}"

    @property
    def gold_checkpoint(self) -> str:
        return f"{self.root}/views/gold_checkpoint"
