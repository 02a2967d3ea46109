"""Built-in column expressions, kept inside whole-stage codegen (no UDFs)."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY = T.DecimalType(10, 2)
EVENT_MONEY = T.DecimalType(18, 2)  # amounts from outside
TOTAL = T.DecimalType(20, 2)  # what Spark gives to sum(MONEY)
EVENT_TOTAL = T.DecimalType(28, 2)
_WHOLE = T.DecimalType(26, 0)
_BITS = 20
_MEAN = T.DecimalType(14, 6)  # what Spark gives to avg(MONEY)
_EVENT_MEAN = T.DecimalType(24, 6)


def _column(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def money(amount: str | Column) -> Column:
    """Amount in exact cents, whatever numeric type it arrives in."""
    return _column(amount).cast(MONEY)


def event_money(amount: str | Column) -> Column:
    """Like :func:`money` for amounts from outside, up to sixteen digits before the point.

    What is no such amount (not a number, infinite, longer) is null, because a stream must
    not end on a single absurd record; such records are quarantined.
    """
    return _column(amount).try_cast(EVENT_MONEY)


def sum_money(amount: str | Column, total: T.DecimalType = TOTAL) -> Column:
    """Exact sum of amounts as ``total``; null when there are none.

    A sum of decimals needs 16-byte values in every buffer and shuffled row, and one bigint
    of cents could overflow on very large groups. So the cents are summed as two bigints,
    the multiples of 2**20 and the rest, which holds for 2**43 amounts of up to 10**10 cents
    per group, or 2**23 of the largest.
    """
    kind = MONEY if total == TOTAL else EVENT_MONEY
    cents = (_column(amount).cast(kind) * 100).cast("long")
    high = F.sum(F.shiftright(cents, _BITS))
    low = F.sum(cents.bitwiseAND(F.lit((1 << _BITS) - 1)))
    return money_of_parts(high, low, total)


def money_of_parts(high: str | Column, low: str | Column, total: T.DecimalType = TOTAL) -> Column:
    """The amount whose cents :func:`sum_money` summed in two bigints."""
    high, low = _column(high).cast(_WHOLE), _column(low).cast(_WHOLE)
    return ((high * (1 << _BITS) + low) * F.lit(Decimal("0.01"))).cast(total)


def mean(total: str | Column, count: str | Column, *, wide: bool = False) -> Column:
    """``avg(x)`` of amounts from their sum and count, so only one sum is kept per group.

    Null when nothing was counted. ``wide`` is for amounts from outside.
    """
    kinds = (EVENT_TOTAL, _EVENT_MEAN) if wide else (TOTAL, _MEAN)
    return (_column(total).cast(kinds[0]) / F.nullif(_column(count), F.lit(0))).cast(kinds[1])


def mean_money(total: str | Column, count: str | Column, *, wide: bool = False) -> Column:
    """``round(avg(x), 2)`` from the sum and the count."""
    return F.round(mean(total, count, wide=wide), 2)


def pseudonym(identifier: str | Column, salt: str | None = None) -> Column:
    """SHA-256 of the identifier's text; null stays null.

    Without a salt the hash of a small integer can be looked up, so pass one where
    the views leave the team that owns the identifiers.
    """
    text = _column(identifier).cast("string")
    if salt:
        text = F.concat(F.lit(salt), text)
    return F.sha2(text, 256)


def row_version(columns: Sequence[str]) -> Column:
    """Latest of the row's version timestamps; nulls are skipped."""
    if len(columns) == 1:
        return F.col(columns[0])
    return F.greatest(*[F.col(c) for c in columns])


def in_any_range(column: str | Column, ranges: Iterable[tuple[str, str]]) -> Column:
    """True where ``low < column < high`` for at least one of the open ranges."""
    column = _column(column)
    tests = [(column > F.lit(low)) & (column < F.lit(high)) for low, high in ranges]
    return reduce(lambda a, b: a | b, tests, F.lit(False))
