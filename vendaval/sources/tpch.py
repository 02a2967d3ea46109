"""TPC-H-like Parquet tables read as the shop's tables.

``orders`` are the sales, ``lineitem`` the sale lines, ``part`` the products, ``customer``
the customers, ``supplier`` the sellers and ``events`` the sale events. Amounts become
exact decimals; columns the shop has and these tables lack are stood in for by a column
of similar shape.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vendaval.functions import money
from vendaval.specs import TABLES, TableSpec


@dataclass(frozen=True)
class TpchShop:
    spark: SparkSession
    directory: str

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.directory}/{name}.parquet")

    @property
    def sales(self) -> DataFrame:
        return self.table("orders").select(
            F.col("o_orderkey").alias("id_venda"),
            F.col("o_custkey").alias("id_cliente"),
            F.to_date("o_orderdate").alias("data"),
            money("o_totalprice").alias("total"),
            F.col("o_orderdate").alias("criacao"),
        )

    @property
    def lines(self) -> DataFrame:
        total = money("l_extendedprice")
        quantity = F.col("l_quantity").cast("int")
        return self.table("lineitem").select(
            F.col("l_orderkey").alias("id_venda"),
            F.col("l_partkey").alias("id_produto"),
            F.col("l_suppkey").alias("id_vendedor"),
            quantity.alias("quantidade"),
            money(F.round(total / quantity, 2)).alias("valor_unitario"),
            total.alias("valor_total"),
            F.round(F.col("l_discount") * 100).cast("int").alias("percentual_desconto"),
            money(F.round(total * F.col("l_discount").cast("decimal(4,2)"), 2)).alias("desconto"),
            F.col("l_shipdate").alias("criacao"),
        )

    @property
    def seller_sales(self) -> DataFrame:
        """Sale lines as sales of their seller; orders name no seller."""
        return self.lines.select(
            "id_venda", "id_vendedor", F.col("valor_total").alias("total"), "criacao"
        )

    @property
    def sales_with_seller(self) -> DataFrame:
        """Sales with the lowest seller id among their lines; null without lines."""
        sellers = self.lines.groupBy("id_venda").agg(F.min("id_vendedor").alias("id_vendedor"))
        return self.sales.join(sellers, "id_venda", "left")

    @property
    def sale_versions(self) -> DataFrame:
        """Sales as a mutable table: updated by the last shipment after the order, if any."""
        shipped = self.lines.groupBy("id_venda").agg(F.max("criacao").alias("_shipped"))
        later = F.when(F.col("_shipped") > F.col("criacao"), F.col("_shipped"))
        joined = self.sales.join(shipped, "id_venda", "left")
        return joined.select("id_venda", "total", "criacao", later.alias("atualizacao"))

    @property
    def products(self) -> DataFrame:
        return self.table("part").select(
            F.col("p_partkey").alias("id_produto"),
            F.col("p_name").alias("produto"),
            money("p_retailprice").alias("preco"),
        )

    @property
    def sellers(self) -> DataFrame:
        return self.table("supplier").select(
            F.col("s_suppkey").alias("id_vendedor"), F.col("s_name").alias("nome")
        )

    @property
    def customers(self) -> DataFrame:
        """Customers with nation as state and region as origin."""
        nations = self.table("nation").join(
            self.table("region"), F.col("n_regionkey") == F.col("r_regionkey")
        )
        return (
            self.table("customer")
            .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
            .select(
                F.col("c_custkey").alias("id_cliente"),
                F.col("c_name").alias("cliente"),
                F.col("n_name").alias("estado"),
                F.substring("c_mktsegment", 1, 1).alias("sexo"),
                F.col("r_name").alias("origem_racial"),
                F.col("c_mktsegment").alias("status"),
                money("c_acctbal").alias("saldo"),
            )
        )

    @property
    def customers_since(self) -> DataFrame:
        """Customers created by their first sale; null while they have none."""
        first = self.sales.groupBy("id_cliente").agg(F.min("criacao").alias("criacao"))
        return self.customers.join(first, "id_cliente", "left")

    def operational_tables(self, created: str = "1995-01-01 00:00:00") -> dict[str, DataFrame]:
        """The five tables with exactly the shop's columns; the missing ones are null.

        Dimensions have no creation time here, so all get ``created``.
        """
        new = F.lit(created)
        frames = {
            "vendas": self.sales_with_seller,
            "itens_venda": self.lines,
            "produtos": self.products.withColumn("criacao", new),
            "clientes": self.customers.withColumn("criacao", new),
            "vendedores": self.sellers.withColumn("criacao", new),
        }
        return {name: _typed(rows, TABLES[name]) for name, rows in frames.items()}

    @property
    def events(self) -> DataFrame:
        """Sale events; the event type stands in for the seller."""
        return event_columns(self.table("events"))


def _typed(rows: DataFrame, spec: TableSpec) -> DataFrame:
    present = set(rows.columns)
    columns = [
        (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in spec.schema
    ]
    return rows.select(*columns)


def event_columns(events: DataFrame) -> DataFrame:
    """Sale-event columns of an ``events`` table, stored or streaming."""
    return events.select(
        F.col("event_id").alias("id_venda"),
        F.col("user_id").alias("id_cliente"),
        F.col("event_type").alias("id_vendedor"),
        F.col("value").alias("valor_total"),
        F.to_date("ts").alias("data"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    )
