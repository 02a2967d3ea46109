"""Pricing of sale lines from the product list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vendaval.functions import money


def price_lines(
    lines: DataFrame,
    products: DataFrame,
    *,
    percent: str = "percentual_desconto",
) -> DataFrame:
    """Adds unit price, line total and discount to lines of (product, quantity, percent).

    Total = price x quantity and discount = percent/100 x total, each rounded half up to
    cents in decimal arithmetic. The discount is reported, not taken off the total. Spark
    broadcasts the product list only if its size is below the threshold.
    """
    prices = products.select("id_produto", money("preco").alias("valor_unitario"))
    total = F.round(F.col("valor_unitario") * F.col("quantidade").cast("decimal(10,0)"), 2)
    discount = F.round(F.col("valor_total") * F.col(percent).cast("decimal(10,0)") / 100, 2)
    return (
        lines.join(prices, "id_produto")
        .withColumn("valor_total", money(total))
        .withColumn("desconto", money(discount))
    )
