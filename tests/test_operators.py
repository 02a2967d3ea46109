"""Upsert, quality, pricing, reports and the database queries."""

from __future__ import annotations

import random

import pytest
import shop
from pyspark.sql import functions as F

from vendaval.functions import in_any_range, row_version
from vendaval.operators import (
    changed_since,
    delta_profile,
    duplicate_keys,
    entity_rules,
    flag_failures,
    insert_if_absent,
    newest_per_key,
    orphan_keys,
    orphans,
    price_lines,
    split_valid,
    upsert,
    upsert_small_delta,
    view_since,
)
from vendaval.plans import reports
from vendaval.plans.checks import referential_report
from vendaval.sources import JdbcSource, empty, read_or_empty, read_snapshots
from vendaval.sources.events import quarantined_events
from vendaval.sources.jdbc import delta_query, profile_query
from vendaval.specs import TABLES

PRODUTOS, VENDAS = TABLES["produtos"], TABLES["vendas"]
KEY, VERSIONS = PRODUTOS.key, PRODUTOS.version_columns


def products(spark, rows):
    return shop.table(spark, "produtos", rows)


def random_products(seed, count, keys=20):
    draw = random.Random(seed)
    return [
        shop.product(
            draw.randint(1, keys),
            price=f"{draw.randint(100, 999)}.00",
            updated=f"2025-04-0{draw.randint(1, 9)} 12:00:00" if draw.random() < 0.8 else None,
        )
        for _ in range(count)
    ]


def brute_force_newest(master, delta):
    best = {}
    for rank, rows in ((0, master), (1, delta)):
        for row in rows:
            version = max(v for v in row[3:] if v is not None)
            order = (version, rank, row[1], float(row[2]), row[3], row[4] or "")
            if row[0] not in best or order > best[row[0]][0]:
                best[row[0]] = (order, row)
    return sorted(tuple(str(v) if v is not None else None for v in r) for _, r in best.values())


@pytest.mark.parametrize("merge", [upsert, upsert_small_delta])
@pytest.mark.parametrize("seed", [1, 2])
def test_upsert_against_brute_force(spark, merge, seed):
    master = {r[0]: r for r in random_products(seed, 40)}.values()
    delta = random_products(seed + 100, 60, keys=30)
    result = merge(products(spark, master), products(spark, delta), KEY, VERSIONS)
    assert shop.rows_of(result) == sorted(brute_force_newest(master, delta), key=str)


def test_upsert_does_not_depend_on_order_and_repeats_safely(spark):
    master = products(spark, list({r[0]: r for r in random_products(5, 30)}.values()))
    rows = random_products(6, 50)
    once = upsert(master, products(spark, rows), KEY, VERSIONS).cache()
    shuffled = upsert(master, products(spark, rows[::-1]).repartition(3), KEY, VERSIONS)
    again = upsert(once, products(spark, rows), KEY, VERSIONS)
    assert shop.rows_of(once) == shop.rows_of(shuffled) == shop.rows_of(again)
    once.unpersist()


def test_hot_key_is_reduced_before_the_shuffle(spark):
    rows = products(spark, random_products(7, 50))
    plan = newest_per_key(rows, KEY, VERSIONS)._jdf.queryExecution().toString()
    physical = plan.split("Physical Plan")[1]
    partial = physical.index("Partial")
    assert "WindowGroupLimit" in physical and physical.rindex("Exchange") < partial


def test_small_delta_leaves_the_master_unshuffled(spark):
    master = products(spark, random_products(8, 40))
    delta = products(spark, random_products(9, 3))
    merged = upsert_small_delta(master, delta, KEY, VERSIONS)
    merged.collect()
    plan = merged._jdf.queryExecution().executedPlan().toString()
    final = plan.split("Initial Plan")[0]
    assert final.count("BroadcastHashJoin") >= 2 and "SortMergeJoin" not in final


def test_insert_if_absent(spark):
    schema = "ordem int, cpf string, nome string"
    existing = spark.createDataFrame([(0, "111", "Ana")], schema)
    incoming = spark.createDataFrame(
        [
            (1, "222", "Bia"),
            (2, "222", "Caio"),
            (3, "111", "Duda"),
            (4, None, "Eva"),
            (5, None, "Ivo"),
        ],
        schema,
    )
    result = insert_if_absent(incoming, existing, "cpf", ["ordem"])
    assert shop.rows_of(result, "ordem") == [("1",), ("4",), ("5",)]


CUSTOMER = {
    "cpf": "123.456.789-00",
    "telefone": "(11) 91234-5678",
    "email": "ana.lima@exemplo.com.br",
    "cliente": "Ana Conceição de Lima",
    "estado": "SP",
    "origem_racial": "Indígena",
    "sexo": "F",
    "status": "gold",
}


def customers(spark, *changes):
    schema = ", ".join(f"{c} string" for c in CUSTOMER)
    return spark.createDataFrame([tuple((CUSTOMER | c).values()) for c in changes], schema)


@pytest.mark.parametrize(
    "column, value, passes",
    [
        ("cpf", "123.456.789-00", True),
        ("cpf", "x123.456.789-00", False),
        ("cpf", None, False),
        ("telefone", "(11) 1234-5678", True),
        ("telefone", "(01) 91234-5678", False),
        ("email", "ANA_1@exemplo.com", True),
        ("email", "ana@exemplo", False),
        ("cliente", "Ana", False),
        ("cliente", "José Antônio Jr.", True),
        ("estado", "sp", True),
        ("estado", "SPA", False),
        ("origem_racial", "parda", True),
        ("origem_racial", "pardaa", False),
        ("sexo", "M", True),
        ("sexo", "Mx", False),
        ("status", "Platinum", True),
        ("status", "Silver plus", False),
    ],
)
def test_customer_rules(spark, column, value, passes):
    flagged = flag_failures(customers(spark, {column: value}), entity_rules("clientes"))
    assert flagged.first()["failed_rules"] == ([] if passes else [column])


def test_split_valid_keeps_every_row(spark):
    rows = customers(spark, {}, {"sexo": "X", "cpf": None}, {"estado": "1"})
    valid, rejected = split_valid(rows, entity_rules("clientes"))
    assert valid.columns == rows.columns and valid.count() == 1
    assert sorted(r["failed_rules"] for r in rejected.collect()) == [["cpf", "sexo"], ["estado"]]


def test_missing_required_column_is_an_error(spark):
    with pytest.raises(ValueError, match="cpf"):
        flag_failures(customers(spark, {}).drop("cpf"), entity_rules("clientes"))


def test_product_prices_may_have_cents(spark):
    rows = products(spark, [shop.product(1, price="120.00"), shop.product(2, "Lixa", "3.5")])
    _, rejected = split_valid(rows, entity_rules("produtos"))
    assert [(r["id_produto"], r["failed_rules"]) for r in rejected.collect()] == [(2, ["produto"])]


def test_orphans_ignore_null_keys(spark):
    child = spark.createDataFrame([(1, 1), (2, 9), (3, 9), (4, None)], "id int, k int")
    parent = spark.createDataFrame([(1,), (2,)], "k int")
    assert shop.rows_of(orphans(child, parent, "k"), "id") == [("2",), ("3",)]
    assert shop.rows_of(orphan_keys(child, parent, "k")) == [("9", "2")]


def test_duplicate_keys(spark):
    rows = spark.createDataFrame([(1, 1), (1, 1), (1, 2)], "a int, b int")
    assert shop.rows_of(duplicate_keys(rows, ["a", "b"])) == [("1", "1", "2")]


def test_line_pricing_rounds_half_up(spark):
    lines = spark.createDataFrame(
        [(1, 10, 3, 5), (2, 11, 1, 5)],
        "id_venda int, id_produto int, quantidade int, percentual_desconto int",
    )
    prices = products(spark, [shop.product(10, price="0.35"), shop.product(11, price="1.70")])
    priced = price_lines(lines, prices)
    assert shop.rows_of(priced, "id_venda", "valor_unitario", "valor_total", "desconto") == [
        ("1", "0.35", "1.05", "0.05"),
        ("2", "1.70", "1.70", "0.09"),
    ]


@pytest.fixture
def small_shop(spark):
    lines = shop.table(
        spark,
        "itens_venda",
        [
            (1, 1, 2, "50.00", "100.00", "5.00", "2025-04-10 10:00:01"),
            (1, 2, 1, "50.55", "50.55", "0.00", "2025-04-10 10:00:02"),
            (2, 3, 4, "5.00", "20.00", "1.00", "2025-04-11 09:00:01"),
            (9, 4, 1, "30.45", "30.45", "0.00", "2025-04-11 09:00:04"),
        ],
    )
    sellers = shop.table(
        spark,
        "vendedores",
        [(1, None, None, None, None, "Rui", "2025-04-01 00:00:00", None)],
    )
    clients = shop.table(
        spark,
        "clientes",
        [
            (10, None, None, None, "Ana", "SP", None, "F", "Gold", "2024-12-31 23:59:59", None),
            (12, None, None, None, "Bia", "RJ", None, "F", "Gold", "2025-01-01 00:00:00", None),
        ],
    )
    goods = products(spark, [shop.product(1), shop.product(2, "Martelo")])
    return shop.sales(spark), lines, goods, clients, sellers


def test_reports(small_shop):
    sales, lines, goods, clients, sellers = small_shop
    assert shop.rows_of(reports.customer_profile(clients), "id_cliente", "ano_entrada") == [
        ("10", "2024"),
        ("12", "2025"),
    ]
    assert shop.rows_of(reports.daily_revenue(sales)) == [
        ("2025-04-10", "2", "150.55"),
        ("2025-04-11", "4", "100.55"),
        ("2025-04-12", "1", "70.00"),
    ]
    assert shop.rows_of(reports.item_detail(lines, goods, sales, sellers)) == [
        ("1", "1", "Parafuso", "1", "Rui", "2", "50.00", "100.00", "5.00"),
        ("3", "2", "Martelo", "1", "Rui", "4", "5.00", "20.00", "1.00"),
    ]
    assert shop.rows_of(reports.customer_ticket(clients, sales)) == [
        ("10", "Ana", "4", "200.65", "50.162500")
    ]
    assert shop.rows_of(reports.product_sales(lines, goods)) == [
        ("1", "Parafuso", "3", "150.55", "5.00", "150.55"),
        ("2", "Martelo", "4", "20.00", "1.00", "20.00"),
    ]
    assert shop.rows_of(reports.seller_sales(sales, sellers)) == [("1", "Rui", "4", "230.00")]


def test_reports_multiply_like_a_join_when_a_dimension_repeats(small_shop):
    """Aggregating before the join gives what aggregating after it would."""
    sales, lines, goods, clients, _ = small_shop
    twice = clients.unionByName(clients.where("id_cliente = 10"))
    plain = twice.join(sales, "id_cliente").groupBy("id_cliente", "cliente").agg(
        F.count("id_venda").alias("num_vendas"),
        F.sum("total").alias("total_gasto"),
        F.avg("total").alias("ticket_medio"),
    )
    assert shop.rows_of(reports.customer_ticket(twice, sales)) == shop.rows_of(plain)


def test_referential_report(small_shop):
    assert shop.rows_of(referential_report(*small_shop)) == [
        ("itens_venda.id_produto", "9", "1"),
        ("vendas sem itens_venda", "5", "1"),
        ("vendas sem itens_venda", "6", "1"),
        ("vendas sem itens_venda", "7", "1"),
        ("vendas.id_cliente", "11", "3"),
        ("vendas.id_vendedor", "2", "3"),
    ]


def test_view_since_and_ranges_are_open(spark):
    sales = shop.sales(spark)
    assert shop.rows_of(view_since(sales, "2025-04-11"), "id_venda") == [("7",)]
    picked = sales.where(
        in_any_range(
            "criacao",
            [
                ("2025-04-10 10:00:01", "2025-04-10 10:00:03"),
                ("2025-04-11 09:00:04", "2025-04-11 09:00:12"),
            ],
        )
    )
    assert shop.rows_of(picked, "id_venda") == [("2",), ("5",)]


def test_row_version_skips_nulls(spark):
    rows = products(
        spark,
        [
            shop.product(1, created="2025-04-02 00:00:00"),
            shop.product(2, created="2025-04-02 00:00:00", updated="2025-04-03 00:00:00"),
            shop.product(3, created="2025-04-02 00:00:00", updated="2025-04-01 00:00:00"),
        ],
    )
    versions = rows.select("id_produto", row_version(VERSIONS).alias("v"))
    assert [r[1][8:10] for r in shop.rows_of(versions)] == ["02", "03", "02"]


@pytest.mark.parametrize("until", [None, "2025-04-06 00:00:00"])
@pytest.mark.parametrize("since", ["2025-04-01 00:00:00", "2025-04-04 12:00:00.000000"])
def test_database_queries_agree_with_the_frame_operators(spark, since, until):
    """The text sent to a database, run by Spark over the same rows."""
    for spec, rows in (
        (PRODUTOS, products(spark, random_products(11, 60))),
        (VENDAS, shop.sales(spark)),
    ):
        rows.createOrReplaceTempView(spec.name)
        delta = spark.sql(f"SELECT * FROM {delta_query(spec, since, until)}")
        expected = changed_since(rows, since, spec.version_columns, until=until)
        assert shop.rows_of(delta) == shop.rows_of(expected)
        profile = spark.sql(f"SELECT * FROM {profile_query(spec, since, until)}")
        columns = ["low_bound", "upper_bound", "qtd_linhas", "watermark"]
        counted = delta_profile(rows, since, spec.version_columns, spec.split_column, until=until)
        assert shop.rows_of(profile, *columns) == shop.rows_of(counted, *columns)


def test_database_read_is_split_on_the_id():
    source = JdbcSource("jdbc:mysql://db/vendas", "com.mysql.cj.jdbc.Driver", "user", "secret")
    options = source.read_options(VENDAS, "2025-04-01 00:00:00", None, 5, 90)
    assert options["partitionColumn"] == "id_venda"
    assert (options["lowerBound"], options["upperBound"], options["numPartitions"]) == (5, 90, 3)
    assert "secret" not in repr(source)
    with pytest.raises(ValueError):
        delta_query(VENDAS, "2025-04-01'; DROP TABLE vendas; --")


def test_absent_path_is_an_empty_typed_frame(spark, tmp_path):
    rows = read_or_empty(spark, str(tmp_path / "nothing"), VENDAS.schema)
    assert rows.schema == empty(spark, VENDAS.schema).schema and rows.count() == 0
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "part-0.parquet").write_text("not parquet")
    with pytest.raises(Exception):
        read_or_empty(spark, str(tmp_path / "bad"), VENDAS.schema).count()


def test_snapshots_are_aligned_by_name(spark, tmp_path):
    sales = shop.sales(spark)
    sales.where("id_venda <= 3").write.parquet(str(tmp_path / "a"))
    sales.where("id_venda > 3").select(*sales.columns[::-1]).write.parquet(str(tmp_path / "b"))
    rows = read_snapshots(spark, VENDAS.schema, [str(tmp_path / "a"), str(tmp_path / "b")])
    assert shop.rows_of(rows) == shop.rows_of(sales)


def test_a_final_line_break_fails_a_format(spark):
    rows = spark.createDataFrame([("123.456.789-00",), ("123.456.789-00\n",)], "cpf string")
    valid, rejected = split_valid(rows, {"cpf": entity_rules("clientes")["cpf"]})
    assert valid.count() == rejected.count() == 1


def test_hot_parent_key_is_reduced_before_the_join(spark):
    sales = spark.range(10).select(F.col("id").alias("id_venda"))
    lines = spark.range(1000).select(F.lit(3).cast("long").alias("id_venda"))
    found = orphans(sales, lines, "id_venda")
    assert found.count() == 9
    plan = found._jdf.queryExecution().toString().split("Physical Plan")[1]
    anti = plan[plan.index("LeftAnti") :]
    assert anti.count("HashAggregate") >= 2


def test_quarantined_events(spark):
    def record(sale, amount):
        return (f'{{"id_venda":{sale},"valor_total":{amount}}}', "2025-04-10 10:00:00")

    texts = [record(1, "5.5"), record('"x"', "1"), record(2, '"NaN"'), record(3, "1e20"), record(4, "1e15"), ("{", None)]
    records = spark.createDataFrame(texts, "value string, timestamp string").withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    found = quarantined_events(records).select("motivo").collect()
    assert sorted(r["motivo"] for r in found) == ["id_venda", "id_venda", "valor_total", "valor_total"]
