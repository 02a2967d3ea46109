"""Column expressions shared by every layer."""

from vendaval.functions.columns import (
    EVENT_TOTAL,
    MONEY,
    TOTAL,
    event_money,
    in_any_range,
    mean,
    mean_money,
    money,
    money_of_parts,
    pseudonym,
    row_version,
    sum_money,
)

__all__ = [
    "EVENT_TOTAL",
    "MONEY",
    "TOTAL",
    "event_money",
    "in_any_range",
    "mean",
    "mean_money",
    "money",
    "money_of_parts",
    "pseudonym",
    "row_version",
    "sum_money",
]
