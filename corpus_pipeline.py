"""From raw documents to sharded training text, as five stages over the documents table.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the
columns of ``documents``. ``run`` writes each stage's rows to the shared folder and hands the
written rows to the next.

In every stage null, empty and blank texts, repeated rows, rows without an id, ties and very
long texts are treated as the stage's operator says in its docstring; an empty table stays
empty; columns beyond those of ``documents`` are kept, whatever their names, unless a stage
makes one of that name (``shard``, ``slot``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vendaval.llm.decontaminate import drop_contaminated
from vendaval.llm.mixing import Mix, mix_texts
from vendaval.llm.neardup import keep_one
from vendaval.llm.quality import keep_good
from vendaval.llm.sharding import assign_shards
from vendaval.llm.shared import keep, table

SHARDS = 8


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents the quality classifier scores under 0.3."""
    return keep_good(docs, table(spark, sf_dir, "labels"), least=0.3)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest doc_id of each group of texts with linked fingerprints."""
    return keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Gives each source its share: texts cut to, or repeated in, the words the mix takes."""
    return mix_texts(docs, Mix())


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds shard and slot."""
    return assign_shards(docs, [1.0] * SHARDS)


STAGES = [
    ("quality classifier", quality),
    ("near duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("sharding", sharding),
]

#: Compression, XXH64 and the draws of the mix cannot be said in SQL; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = keep(stage(spark, docs, sf_dir), f"stage{number}")
    return docs
