"""The master tables and reports under their SQL names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vendaval.plans import reports
from vendaval.plans.ingest import read_master
from vendaval.plans.layout import Layout
from vendaval.specs import TABLES


def report_frames(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The six reports by view name, over the five tables by table name."""
    sales, lines = tables["vendas"], tables["itens_venda"]
    products, customers, sellers = tables["produtos"], tables["clientes"], tables["vendedores"]
    return {
        "vw_clientes_perfil": reports.customer_profile(customers),
        "vw_faturamento_diario": reports.daily_revenue(sales),
        "vw_itens_detalhados": reports.item_detail(lines, products, sales, sellers),
        "vw_ticket_medio_cliente": reports.customer_ticket(customers, sales),
        "vw_vendas_por_produto": reports.product_sales(lines, products),
        "vw_vendas_por_vendedor": reports.seller_sales(sales, sellers),
    }


def register_views(spark: SparkSession, layout: Layout) -> list[str]:
    """Make masters and reports available to ``spark.sql``; returns the names.

    The views show the masters as they are now; register again after an ingest.
    """
    tables = {name: read_master(spark, layout, spec) for name, spec in TABLES.items()}
    frames = tables | report_frames(tables)
    for name, frame in frames.items():
        frame.createOrReplaceTempView(name)
    return list(frames)
