"""Relational reports over the five tables.

Fact tables are aggregated on the join key before the join, so what crosses the network is
one row per key and task, also for a key that holds a third of the sales. Dimensions carry
no broadcast hint: Spark broadcasts them only while their size is below its threshold, and
adaptive execution splits skewed partitions of the shuffle joins that remain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vendaval.functions import mean, sum_money


def customer_profile(customers: DataFrame) -> DataFrame:
    return customers.select(
        "id_cliente",
        "cliente",
        "estado",
        "sexo",
        "origem_racial",
        "status",
        F.year("criacao").alias("ano_entrada"),
    )


def daily_revenue(sales: DataFrame) -> DataFrame:
    return sales.groupBy("data").agg(
        F.count("id_venda").alias("qtd_vendas"),
        sum_money("total").alias("total_faturado"),
    )


def item_detail(
    lines: DataFrame, products: DataFrame, sales: DataFrame, sellers: DataFrame
) -> DataFrame:
    """Every sale line with its product and seller; only the needed columns are joined.

    The facts are joined first, on the sale's id: masters bucketed by it need no shuffle for
    that, nor for the dimensions while these are small enough to be broadcast.
    """
    sold_lines = lines.select(
        "id_venda", "id_produto", "quantidade", "valor_unitario", "valor_total", "desconto"
    )
    return (
        sold_lines.join(sales.select("id_venda", "id_vendedor"), "id_venda")
        .join(sellers.select("id_vendedor", F.col("nome").alias("nome_vendedor")), "id_vendedor")
        .join(products.select("id_produto", "produto"), "id_produto")
        .select(
            "id_venda",
            "id_produto",
            "produto",
            "id_vendedor",
            "nome_vendedor",
            "quantidade",
            "valor_unitario",
            "valor_total",
            "desconto",
        )
    )


def customer_ticket(customers: DataFrame, sales: DataFrame) -> DataFrame:
    """Sales, amount and mean sale per customer; the mean is not rounded to cents."""
    per_customer = sales.groupBy("id_cliente").agg(
        F.count("id_venda").alias("num_vendas"),
        sum_money("total").alias("total_gasto"),
        F.count("total").alias("_amounts"),
    )
    return (
        customers.select("id_cliente", "cliente")
        .join(per_customer, "id_cliente")
        .groupBy("id_cliente", "cliente")
        .agg(
            F.sum("num_vendas").alias("num_vendas"),
            F.sum("total_gasto").alias("total_gasto"),
            F.sum("_amounts").alias("_amounts"),
        )
        .withColumn("ticket_medio", mean("total_gasto", "_amounts"))
        .drop("_amounts")
    )


def product_sales(lines: DataFrame, products: DataFrame) -> DataFrame:
    """Quantity, gross, discount and net per product.

    Net equals gross for lines stored without the discount taken off.
    """
    totals = ("total_quantidade", "total_bruto", "total_desconto", "total_liquido")
    per_product = lines.groupBy("id_produto").agg(
        F.sum("quantidade").alias("total_quantidade"),
        F.sum(F.col("valor_unitario") * F.col("quantidade")).alias("total_bruto"),
        sum_money("desconto").alias("total_desconto"),
        sum_money("valor_total").alias("total_liquido"),
    )
    return (
        products.select("id_produto", "produto")
        .join(per_product, "id_produto")
        .groupBy("id_produto", "produto")
        .agg(*[F.sum(c).alias(c) for c in totals])
    )


def seller_sales(sales: DataFrame, sellers: DataFrame) -> DataFrame:
    per_seller = sales.groupBy("id_vendedor").agg(
        F.count("id_venda").alias("total_vendas"),
        sum_money("total").alias("total_faturado"),
    )
    return (
        sellers.select("id_vendedor", "nome")
        .join(per_seller, "id_vendedor")
        .groupBy("id_vendedor", "nome")
        .agg(
            F.sum("total_vendas").alias("total_vendas"),
            F.sum("total_faturado").alias("total_faturado"),
        )
    )
