"""Latest version per key, and merging a delta into a master dataset."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vendaval.functions import row_version

_RANK = "_source_rank"


def newest_per_key(
    rows: DataFrame,
    key: Sequence[str],
    version_columns: Sequence[str],
    *,
    prefer: str | None = None,
) -> DataFrame:
    """One row per key: the newest version.

    Ties go to the higher ``prefer`` value, then to the greatest remaining columns in
    order, so the choice never depends on arrival order. Spark limits each map task to
    one row per key before the shuffle (``WindowGroupLimit``), so a key with very many
    versions does not pile up in one reducer.
    """
    ordering = [row_version(version_columns).desc_nulls_last()]
    if prefer:
        ordering.append(F.col(prefer).desc_nulls_last())
    rest = [c for c in rows.columns if c not in key and c != prefer]
    ordering += [F.col(c).desc_nulls_last() for c in rest]
    position = F.row_number().over(Window.partitionBy(*key).orderBy(*ordering))
    return rows.withColumn("_position", position).where("_position = 1").drop("_position")


def oldest_per_key(
    rows: DataFrame, key: Sequence[str], version_columns: Sequence[str]
) -> DataFrame:
    """One row per key: the first created, as a table that only grows keeps it.

    Ties go to the least remaining columns in order.
    """
    rest = [c for c in rows.columns if c not in key]
    ordering = [row_version(version_columns).asc_nulls_last()]
    ordering += [F.col(c).asc_nulls_last() for c in rest]
    position = F.row_number().over(Window.partitionBy(*key).orderBy(*ordering))
    return rows.withColumn("_position", position).where("_position = 1").drop("_position")


def upsert(
    master: DataFrame,
    delta: DataFrame,
    key: Sequence[str],
    version_columns: Sequence[str],
) -> DataFrame:
    """Master plus delta with one row per key, the newest version; delta wins ties.

    Suits a delta of any size and a master that repeats keys: both are shuffled once, on the
    key.
    """
    rows = master.withColumn(_RANK, F.lit(0)).unionByName(delta.withColumn(_RANK, F.lit(1)))
    return newest_per_key(rows, key, version_columns, prefer=_RANK).drop(_RANK)


def upsert_small_delta(
    master: DataFrame,
    delta: DataFrame,
    key: Sequence[str],
    version_columns: Sequence[str],
) -> DataFrame:
    """Same result as :func:`upsert`, for a master that already has one row per key.

    Only master rows whose key is in the delta take part in the comparison; the rest
    pass through. No hint forces a broadcast: Spark broadcasts the delta's keys when
    their measured size is below its threshold, and then the master is never shuffled;
    beyond it both joins are ordinary shuffle joins.
    """
    keys = delta.select(*key).distinct()
    untouched = _null_safe_join(master, keys, key, "left_anti")
    touched = _null_safe_join(master, keys, key, "left_semi")
    return untouched.unionByName(upsert(touched, delta, key, version_columns))


def append_missing(
    master: DataFrame, delta: DataFrame, key: Sequence[str], *, bound: str | None = None
) -> DataFrame:
    """Delta rows whose key the master does not hold yet; nulls in a key equal one another.

    With ``bound``, a column of the key, the master is read between the delta's least and
    greatest value of it: its files are skipped by their range. Whole keys are compared
    plainly, so a master bucketed by them is not shuffled; the few rows that lack a part of
    their key are compared apart.
    """
    stored = master.select(*key)
    lacks = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in key])
    known = stored.where(~lacks)
    if bound is not None:
        ends = delta.agg(F.min(bound).alias("low"), F.max(bound).alias("high"))
        known = known.where(F.col(bound).between(ends.select("low").scalar(), ends.select("high").scalar()))
    whole = delta.where(~lacks).join(known, list(key), "left_anti")
    partly = _null_safe_join(delta.where(lacks), stored.where(lacks), key, "left_anti")
    return whole.select(*delta.columns).unionByName(partly)


def insert_if_absent(
    incoming: DataFrame,
    existing: DataFrame,
    natural_key: str,
    order: Sequence[str],
) -> DataFrame:
    """Incoming rows to insert: natural key not stored yet, first arrival per key.

    ``order`` says which arrival is first. A null natural key identifies nothing, so such
    rows are all kept and take no part in the shuffle.
    """
    key = F.col(natural_key)
    keyed = incoming.where(key.isNotNull())
    first = F.row_number().over(
        Window.partitionBy(natural_key).orderBy(*[F.col(c).asc_nulls_last() for c in order])
    )
    first_arrivals = keyed.withColumn("_position", first).where("_position = 1").drop("_position")
    # Only the keys in question: few arrivals leave the stored keys out of the shuffle.
    arrived = incoming.select(natural_key).distinct()
    stored = existing.select(natural_key).join(arrived, natural_key, "left_semi").distinct()
    new = first_arrivals.join(stored, natural_key, "left_anti")
    return new.unionByName(incoming.where(key.isNull()))


def _null_safe_join(left: DataFrame, right: DataFrame, key: Sequence[str], how: str) -> DataFrame:
    left, right = left.alias("l"), right.alias("r")
    condition = F.lit(True)
    for c in key:
        condition = condition & F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}"))
    return left.join(right, condition, how)
