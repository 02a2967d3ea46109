"""Operator 4, sharding: weighted rendezvous hashing of stable record keys.

Every shard draws a number from the record's key; the shard with the best number gets the
record. A new shard can only win records for itself, all others stay where they are. With
weight w a shard's number is -ln(u) / w, so shares follow the weights.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vendaval.llm.shared import running_total

SEED = 20240229


def shard_of(key: Column, weights: Sequence[float], seed: int = SEED) -> Column:
    """Shard number of a key: 0 to ``len(weights) - 1``; a shard of weight 0 gets nothing.

    A null key is a key like any other: all null keys share a shard.
    """
    if not weights or min(weights) < 0 or max(weights) == 0:
        raise ValueError("weights must be non-negative and not all zero")

    def draw(shard: int, weight: float) -> Column:
        bits = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.lit(shard), key), 11)
        uniform = (bits + F.lit(0.5)) / F.lit(float(2**53))
        return F.struct((-F.log(uniform) / F.lit(float(weight))).alias("draw"), F.lit(shard).alias("shard"))

    draws = [draw(shard, weight) for shard, weight in enumerate(weights) if weight > 0]
    best = draws[0] if len(draws) == 1 else F.least(*draws)
    return best["shard"]


def assign_shards(
    rows: DataFrame,
    weights: Sequence[float],
    key: str = "doc_id",
    text: str = "text",
    shard: str = "shard",
    slot: str = "slot",
) -> DataFrame:
    """``rows`` with their shard and their place in it, counted from 0 without gaps.

    Empty and null texts and null keys take a place like all others. Repeated rows go to the
    same shard and get a place each. Columns of ``rows`` named like the new ones are replaced.
    An empty table stays empty. Place order depends on key and text alone; the places of
    rows alike in both are interchangeable.
    """
    kept = [c for c in rows.columns if c not in (shard, slot)]
    placed = rows.select(
        F.col(key).alias("key"),
        F.xxhash64(text).alias("hash"),
        F.lit(1).cast("long").alias("one"),
        shard_of(F.col(key), weights).cast("int").alias("shard"),
        # A first field, because a struct may not be empty.
        F.struct(F.lit(0), *[F.col(f"`{c}`") for c in kept]).alias("row"),
    )
    numbered = running_total(placed, "shard", ["key", "hash"], "one", "slot")
    columns = [F.col(f"row.`{c}`").alias(c) for c in kept]
    return numbered.select(*columns, F.col("shard").alias(shard), F.col("slot").alias(slot))


def shard_report(rows: DataFrame, shards: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Size, checksum, shard, place and the shard after one more is added, per row."""
    narrow = rows.select(
        F.col(key).alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.col(text).cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("text_hash"),
    )
    placed = assign_shards(narrow, [1.0] * shards, "doc_id", "text_hash")
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("key").alias("law"),
        "shard",
        "slot",
        shard_of(F.col("doc_id"), [1.0] * (shards + 1)).cast("int").alias("grown_shard"),
    )


def write_shards(rows: DataFrame, weights: Sequence[float], path: str, per_file: int = 200_000) -> None:
    """Writes one folder per shard, each split into files of about ``per_file`` rows."""
    placed = assign_shards(rows, weights)
    placed.repartition("shard", F.floor(F.col("slot") / per_file)).write.partitionBy("shard").parquet(path)
