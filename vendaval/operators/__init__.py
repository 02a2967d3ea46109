"""Operators: functions from DataFrames to DataFrames, without side effects."""

from vendaval.operators.increments import (
    changed_since,
    delta_profile,
    version_columns_of,
    watermark,
)
from vendaval.operators.pricing import price_lines
from vendaval.operators.quality import (
    duplicate_keys,
    entity_rules,
    flag_failures,
    orphan_keys,
    orphans,
    split_valid,
)
from vendaval.operators.rollup import highest_id, rollup, view_since
from vendaval.operators.upsert import (
    append_missing,
    insert_if_absent,
    newest_per_key,
    upsert,
    upsert_small_delta,
)

__all__ = [
    "append_missing",
    "changed_since",
    "delta_profile",
    "duplicate_keys",
    "entity_rules",
    "flag_failures",
    "highest_id",
    "insert_if_absent",
    "newest_per_key",
    "orphan_keys",
    "orphans",
    "price_lines",
    "rollup",
    "split_valid",
    "upsert",
    "upsert_small_delta",
    "version_columns_of",
    "view_since",
    "watermark",
]
