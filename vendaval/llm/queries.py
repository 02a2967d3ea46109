"""The registered queries of the numbered operators, with their production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from vendaval.llm.decontaminate import Rule, contaminations
from vendaval.llm.hnsw import Search, neighbour_report
from vendaval.llm.importance import Draw, importance_report
from vendaval.llm.katz import Katz, score_documents
from vendaval.llm.lexical import Ranking, search
from vendaval.llm.mixing import Mix, mix_report
from vendaval.llm.neardup import near_duplicate_report
from vendaval.llm.quality import Training, score_quality
from vendaval.llm.shared import table
from vendaval.llm.sharding import shard_report
from vendaval.llm.spans import Runs, repeat_report
from vendaval.llm.sql import importance_sql, search_sql
from vendaval.llm.tokens import token_counts
from vendaval.llm.toxicity import Training as ToxicTraining
from vendaval.llm.toxicity import score_toxicity
from vendaval.llm.urls import judge

Query = Callable[[SparkSession, str], DataFrame]


def _substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeat_report(table(spark, sf_dir, "documents"), Runs())


def _mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_report(table(spark, sf_dir, "documents"), Mix())


def _toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return score_toxicity(documents, labels, ToxicTraining())


def _sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_report(table(spark, sf_dir, "documents"), shards=8)


def _neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbour_report(table(spark, sf_dir, "embeddings"), every=50, search=Search())


def _tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    return token_counts(table(spark, sf_dir, "documents"), path, limit=512)


def _decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminations(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), Rule())


def _quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return score_quality(documents, labels, least=0.3, training=Training())


def _near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_report(table(spark, sf_dir, "documents"))


def _lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"), Katz())


def _search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), Ranking())


def _importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), Draw())


def _urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"))


QUERIES: dict[str, Query] = {
    "op1_substring_dedup": _substrings,
    "op2_mixing": _mixing,
    "op3_toxicity": _toxicity,
    "op4_sharding": _sharding,
    "op5_neighbours": _neighbours,
    "op6_token_counts": _tokens,
    "op7_decontamination": _decontamination,
    "op8_quality": _quality,
    "op9_near_duplicates": _near_duplicates,
    "op10_lm_scoring": _lm_scoring,
    "op11_lexical_search": _search,
    "op12_importance": _importance,
    "op13_url_filter": _urls,
}

#: For the others Spark's hashes, compression and trained models have no counterpart in the
#: checking engine: those queries are tested against brute force and held-out rows in tests/llm.
ORACLE_SQL: dict[str, str] = {
    "op11_lexical_search": search_sql(),
    "op12_importance": importance_sql(),
}
