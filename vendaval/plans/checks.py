"""Key checks between the five tables, as one report."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vendaval.operators.quality import flag_failures, unmatched_keys


def referential_report(
    sales: DataFrame,
    lines: DataFrame,
    products: DataFrame,
    customers: DataFrame,
    sellers: DataFrame,
) -> DataFrame:
    """Keys that break a foreign key, and sales left without lines, with their row counts."""
    checks = {
        "vendas.id_vendedor": (sales, sellers, "id_vendedor"),
        "vendas.id_cliente": (sales, customers, "id_cliente"),
        "itens_venda.id_produto": (lines, products, "id_produto"),
        "itens_venda.id_venda": (lines, sales, "id_venda"),
        "vendas sem itens_venda": (sales, lines, "id_venda"),
    }
    found = [
        unmatched_keys(child, parent, key).select(
            F.lit(name).alias("regra"), F.col(key).cast("long").alias("chave"), "linhas"
        )
        for name, (child, parent, key) in checks.items()
    ]
    return reduce(DataFrame.unionByName, found)


VALID = "valido"


def store_checked(rows: DataFrame, rules: Mapping[str, str], path: str) -> None:
    """Write rows that pass every rule and those that fail one, in a single pass over them.

    Both go to one dataset, partitioned by validity, so a reader of either reads only its files.
    """
    flagged = flag_failures(rows, rules).withColumn(VALID, F.size("failed_rules") == 0)
    flagged.write.mode("overwrite").partitionBy(VALID).parquet(path)


def read_checked(spark: SparkSession, path: str, valid: bool) -> DataFrame:
    """The valid rows, or the others with their ``failed_rules``."""
    rows = spark.read.parquet(path).where(F.col(VALID) == F.lit(valid)).drop(VALID)
    return rows.drop("failed_rules") if valid else rows
