"""Row checks on incoming entities and key checks between tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Java regular expressions, matched on the whole text: \z, unlike $, also refuses a final
# line break. Fixed values are the formats of cpf and phone and the lists of origin, sex and
# status. The others follow the intent and differ: names may have accents, digits and more than
# two words, prices may have cents, states and e-mail addresses are matched whole.
COLUMN_PATTERNS: dict[str, str] = {
    "telefone": r"\A\([1-9]{2}\) 9?[0-9]{4}-[0-9]{4}\z",
    "cpf": r"\A[0-9]{3}\.[0-9]{3}\.[0-9]{3}-[0-9]{2}\z",
    "email": r"(?i)\A[a-z0-9._]+@[a-z0-9]+(\.[a-z]+){1,2}\z",
    "cliente": r"\A[\p{L}0-9.]{2,}( [\p{L}0-9.]{2,})+\z",
    "nome": r"\A[\p{L}0-9.]{2,}( [\p{L}0-9.]{2,})+\z",
    "estado": r"(?i)\A[a-z]{2}\z",
    "origem_racial": r"(?iu)\A(indígena|branca|preta|parda|amarela)\z",
    "sexo": r"(?i)\A[MF]\z",
    "status": r"(?i)\A(Silver|Gold|Platinum)\z",
    "produto": r"\A[\p{L} ]{5,}\z",
    "preco": r"\A[0-9]{1,8}(\.[0-9]{1,2})?\z",
}

# The columns an entity must bring to be registered.
REQUIRED_COLUMNS: dict[str, tuple[str, ...]] = {
    "clientes": (
        "cpf",
        "telefone",
        "email",
        "cliente",
        "estado",
        "origem_racial",
        "sexo",
        "status",
    ),
    "produtos": ("produto", "preco"),
    "vendedores": ("cpf", "telefone", "email", "origem_racial", "nome"),
}


def entity_rules(entity: str) -> dict[str, str]:
    """Pattern per required column of an entity."""
    return {c: COLUMN_PATTERNS[c] for c in REQUIRED_COLUMNS[entity]}


def flag_failures(rows: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """Adds ``failed_rules``: the columns that are null or do not match their pattern."""
    missing = [c for c in rules if c not in rows.columns]
    if missing:
        raise ValueError(f"required columns are missing: {', '.join(missing)}")
    failures = [
        F.when(~F.coalesce(F.col(c).cast("string").rlike(pattern), F.lit(False)), F.lit(c))
        for c, pattern in rules.items()
    ]
    return rows.withColumn("failed_rules", F.array_compact(F.array(*failures)))


def split_valid(rows: DataFrame, rules: Mapping[str, str]) -> tuple[DataFrame, DataFrame]:
    """Rows that pass every rule, and the others with their ``failed_rules``."""
    flagged = flag_failures(rows, rules)
    passed = F.size("failed_rules") == 0
    return flagged.where(passed).drop("failed_rules"), flagged.where(~passed)


def orphans(
    child: DataFrame,
    parent: DataFrame,
    child_key: str,
    parent_key: str | None = None,
) -> DataFrame:
    """Child rows whose non-null key no parent row has."""
    # Once each: a parent key with very many rows crosses the shuffle as one per task.
    keys = parent.select(F.col(parent_key or child_key).alias(child_key)).distinct()
    return child.where(F.col(child_key).isNotNull()).join(keys, child_key, "left_anti")


def orphan_keys(
    child: DataFrame,
    parent: DataFrame,
    child_key: str,
    parent_key: str | None = None,
) -> DataFrame:
    """Orphaned keys with their number of child rows.

    Counts per key before the join, so a hot key crosses the shuffle as one row per task. Suits
    masters bucketed by the key, which it reads without a shuffle; for others see
    :func:`unmatched_keys`.
    """
    counted = (
        child.where(F.col(child_key).isNotNull())
        .groupBy(child_key)
        .agg(F.count(F.lit(1)).alias("linhas"))
    )
    keys = parent.select(F.col(parent_key or child_key).alias(child_key)).distinct()
    return counted.join(keys, child_key, "left_anti")


def unmatched_keys(
    child: DataFrame,
    parent: DataFrame,
    child_key: str,
    parent_key: str | None = None,
) -> DataFrame:
    """Same result as :func:`orphan_keys`, by one aggregate over the keys of both sides.

    Suits tables that are shuffled anyway: a task holds each key once and sorts nothing, where a
    join holds and sorts the keys of both sides.
    """
    key, none = F.col(child_key), F.lit(None).cast("int")
    children = child.select(key, F.lit(1).alias("linhas"), none.alias("_parents"))
    parents = parent.select(F.col(parent_key or child_key), none, F.lit(1))
    return (
        children.union(parents)
        .where(key.isNotNull())
        .groupBy(child_key)
        .agg(F.count("linhas").alias("linhas"), F.count("_parents").alias("_parents"))
        .where("_parents = 0")
        .select(key.cast(child.schema[child_key].dataType).alias(child_key), "linhas")
    )


def duplicate_keys(rows: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with the number of rows."""
    return rows.groupBy(*key).agg(F.count(F.lit(1)).alias("linhas")).where("linhas > 1")
