"""Small invented shop data used by the tests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vendaval.specs import TABLES

# id_venda, id_vendedor, id_cliente, data, total, criacao
GOLDEN_SALES = [
    (1, 1, 10, "2025-04-10", "100.00", "2025-04-10 10:00:01"),
    (2, 2, 10, "2025-04-10", "50.55", "2025-04-10 10:00:02"),
    (3, 1, 11, "2025-04-11", "20.00", "2025-04-11 09:00:01"),
    (4, 2, 11, "2025-04-11", "30.45", "2025-04-11 09:00:04"),
    (5, 1, 10, "2025-04-11", "40.00", "2025-04-11 09:00:08"),
    (6, 2, 10, "2025-04-11", "10.10", "2025-04-11 09:00:12"),
    (7, 1, 11, "2025-04-12", "70.00", "2025-04-12 08:00:00"),
]


def table(spark: SparkSession, name: str, rows: list[tuple]) -> DataFrame:
    """Rows of text-like values, typed as the shop's table."""
    schema = TABLES[name].schema
    raw = ", ".join(f"{f.name} string" for f in schema)
    text = [tuple(None if v is None else str(v) for v in row) for row in rows]
    frame = spark.createDataFrame(text, raw)
    return frame.select(*[F.col(f.name).cast(f.dataType) for f in schema])


def sales(spark: SparkSession, rows=GOLDEN_SALES) -> DataFrame:
    return table(spark, "vendas", rows)


def events(spark: SparkSession, rows=GOLDEN_SALES) -> DataFrame:
    """The same sales as decoded events, stamped with their creation time."""
    return sales(spark, rows).select(
        "id_vendedor",
        "id_cliente",
        "id_venda",
        F.col("total").cast("double").alias("valor_total"),
        "data",
        F.col("criacao").alias("timestamp"),
    )


def product(key, name="Parafuso", price="9.90", created="2025-04-01 08:00:00", updated=None):
    return (key, name, price, created, updated)


def rows_of(frame: DataFrame, *columns: str) -> list[tuple]:
    """Rows as comparable texts, sorted."""
    picked = frame.select(*[F.col(c).cast("string") for c in columns or frame.columns])
    return sorted((tuple(r) for r in picked.collect()), key=str)
