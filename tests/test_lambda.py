"""The seven-sale case: batch, speed and gold values worked out by hand."""

from __future__ import annotations

from datetime import date
from decimal import Decimal

import pytest
import shop
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vendaval.functions import sum_money
from vendaval.operators import rollup
from vendaval.plans import (
    batch_view,
    exact_gold_view,
    extract_table,
    gold_view,
    ingest_table,
    refresh_batch_views,
    straddling_windows,
)
from vendaval.plans.batch_views import read_batch_view
from vendaval.sources import FrameSource
from vendaval.sources.files import delete_path, list_names
from vendaval.specs import CUSTOMER_TICKET, DAILY_REVENUE, SELLER_SALES, TABLES, VIEWS
from vendaval.streaming import newer_than, speed_view


@pytest.fixture
def batch(spark):
    return batch_view(shop.sales(spark).where("id_venda <= 4"), DAILY_REVENUE)


@pytest.fixture
def speed(spark):
    return speed_view(newer_than(shop.events(spark), 2), DAILY_REVENUE)


def test_batch_daily_revenue(batch):
    assert batch.schema["total_faturado"].dataType.simpleString() == "decimal(20,2)"
    assert batch.schema["ticket_medio"].dataType.simpleString() == "decimal(11,2)"
    assert shop.rows_of(batch) == [
        ("2025-04-10", "2", "2", "150.55", "75.28"),
        ("2025-04-11", "4", "2", "50.45", "25.23"),
    ]


def test_speed_daily_revenue(speed):
    columns = ["window.start", "data", "maior_id", "qtd_vendas", "total_faturado", "ticket_medio"]
    assert shop.rows_of(speed, *columns) == [
        ("2025-04-11 09:00:00", "2025-04-11", "5", "3", "90.45", "30.15"),
        ("2025-04-11 09:00:10", "2025-04-11", "6", "1", "10.10", "10.10"),
        ("2025-04-12 08:00:00", "2025-04-12", "7", "1", "70.00", "70.00"),
    ]


def test_gold_takes_windows_whole(batch, speed):
    gold = gold_view(batch, speed, DAILY_REVENUE)
    types = [f.dataType.simpleString() for f in gold.schema]
    assert types == ["date", "bigint", "bigint", "double"]
    assert shop.rows_of(gold) == [
        ("2025-04-10", "2", "150", "75.28"),
        ("2025-04-11", "6", "151", "21.83"),
        ("2025-04-12", "1", "70", "70.0"),
    ]


def test_exact_gold_counts_each_sale_once(spark, batch):
    gold = exact_gold_view(batch, shop.events(spark), DAILY_REVENUE, "valor_total")
    assert shop.rows_of(gold) == [
        ("2025-04-10", "2", "150.55", "75.28"),
        ("2025-04-11", "4", "100.55", "25.14"),
        ("2025-04-12", "1", "70.00", "70.00"),
    ]


def test_straddling_window_is_found(batch, speed):
    found = straddling_windows(batch, speed)
    assert shop.rows_of(found, "window.start", "menor_id", "maior_id") == [
        ("2025-04-11 09:00:00", "3", "5")
    ]


def test_empty_batch_keeps_every_speed_row(spark, speed):
    empty = batch_view(shop.sales(spark, []), DAILY_REVENUE)
    assert gold_view(empty, speed, DAILY_REVENUE).agg(F.sum("qtd_vendas")).first()[0] == 5


def test_hashed_keys_and_null_group(spark):
    rows = shop.GOLDEN_SALES + [(8, None, 11, "2025-04-12", "1.00", "2025-04-12 08:00:01")]
    view = batch_view(shop.sales(spark, rows), SELLER_SALES)
    expected = shop.sales(spark, rows).select(F.sha2(F.col("id_vendedor").cast("string"), 256))
    assert {r[0] for r in view.select("hash_id_vendedor").collect()} == {
        r[0] for r in expected.distinct().collect()
    }
    assert view.where("hash_id_vendedor is null").first()["qtd_vendas"] == 1


def test_salt_changes_the_pseudonym(spark):
    plain = batch_view(shop.sales(spark), CUSTOMER_TICKET)
    salted = batch_view(shop.sales(spark), CUSTOMER_TICKET, salt="s")
    assert plain.join(salted, "hash_id_cliente").count() == 0
    assert plain.count() == salted.count() == 2


def test_null_amounts_do_not_enter_the_mean(spark):
    rows = [
        (1, 1, 1, "2025-04-10", "10.00", "2025-04-10 10:00:00"),
        (2, 1, 1, "2025-04-10", None, "2025-04-10 10:00:00"),
        (3, 1, 2, "2025-04-11", None, "2025-04-10 10:00:00"),
    ]
    view = batch_view(shop.sales(spark, rows), DAILY_REVENUE)
    assert shop.rows_of(view) == [
        ("2025-04-10", "2", "2", "10.00", "10.00"),
        ("2025-04-11", "3", "1", None, None),
    ]


def test_mean_equals_round_of_avg(spark):
    """Against Spark's own round(avg(x), 2), over sums that end on awkward fractions."""
    amounts = [
        (i, 1, 1, "2025-04-10", f"{(i * 7919) % 100003 / 100:.2f}", "2025-04-10 00:00:00")
        for i in range(1, 3000)
    ]
    sales = shop.sales(spark, amounts).withColumn("id_cliente", F.col("id_venda") % 613)
    ours = batch_view(sales, CUSTOMER_TICKET)
    key = F.sha2(F.col("id_cliente").cast("string"), 256).alias("hash_id_cliente")
    theirs = sales.groupBy(key).agg(F.round(F.avg("total"), 2).alias("ticket_medio"))
    both = ours.select("hash_id_cliente", "ticket_medio")
    assert both.exceptAll(theirs).count() == 0 and theirs.exceptAll(both).count() == 0


def test_money_sums_are_exact(spark):
    """Against a plain decimal sum, with negative, null and largest amounts."""
    amounts = spark.range(20_000).select(
        (F.col("id") % 7).alias("k"),
        F.when(F.col("id") % 11 == 0, None)
        .when(F.col("id") % 5 == 0, F.lit("99999999.99"))
        .when(F.col("id") % 3 == 0, F.lit("-99999999.99"))
        .otherwise(F.concat(F.lit("-"), F.col("id") % 1000, F.lit(".07")))
        .cast("decimal(10,2)")
        .alias("x"),
    )
    sums = amounts.groupBy("k").agg(sum_money("x").alias("a"), F.sum("x").alias("b"))
    assert sums.where("a = b").count() == 7
    assert sums.schema["a"].dataType == sums.schema["b"].dataType
    assert amounts.where("x is null").agg(sum_money("x")).first()[0] is None


SALES = st.lists(
    st.tuples(
        st.integers(1, 3),
        st.integers(1, 4),
        st.integers(0, 3),
        st.integers(1, 9_999_999),
        st.integers(0, 120),
    ),
    min_size=1,
    max_size=25,
)


@settings(
    max_examples=8,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture],
)
@given(drawn=SALES, cut=st.integers(0, 26))
def test_exact_gold_equals_full_batch_for_any_cutoff(spark, drawn, cut):
    rows = [
        (
            i,
            seller,
            customer,
            f"2025-04-{10 + day}",
            f"{cents / 100:.2f}",
            f"2025-04-{10 + day} 10:{second // 60:02d}:{second % 60:02d}",
        )
        for i, (seller, customer, day, cents, second) in enumerate(drawn, 1)
    ]
    sales = shop.sales(spark, rows).cache()
    for view in VIEWS.values():
        old = batch_view(sales.where(F.col("id_venda") <= cut), view)
        events = sales.withColumnRenamed("total", "valor_total")
        merged = exact_gold_view(old, events, view, "valor_total")
        whole = rollup(sales, view, "total").select(*merged.columns)
        assert shop.rows_of(merged) == shop.rows_of(whole)
    sales.unpersist()


def test_rows_without_an_id_are_dropped(spark):
    events = shop.events(spark).unionByName(
        shop.events(spark).limit(1).withColumn("id_venda", F.lit(None).cast("int"))
    )
    assert newer_than(events, 0).count() == 7
    assert newer_than(events, 4).count() == 3


def test_dates_and_totals_are_python_values(batch):
    row = batch.orderBy("data").first()
    assert row["data"] == date(2025, 4, 10) and row["total_faturado"] == Decimal("150.55")


def test_batch_views_read_only_new_lots(spark, layout):
    spec = TABLES["vendas"]
    for upto in (4, 7):
        source = FrameSource({"vendas": shop.sales(spark, shop.GOLDEN_SALES[:upto])})
        extract_table(spark, source, spec, layout, overlap_seconds=0)
        path = ingest_table(spark, layout, spec).path
        if upto == 7:
            # What the first refresh has read is not looked at again.
            for name in first:
                delete_path(spark, f"{path}/{name}")
        assert all(o.error is None for o in refresh_batch_views(spark, layout))
        first = [n for n in list_names(spark, path) if n.endswith(".parquet")]
    for view in VIEWS.values():
        stored = read_batch_view(spark, layout, view)
        assert shop.rows_of(stored) == shop.rows_of(rollup(shop.sales(spark), view, "total"))


def test_replaced_master_starts_the_batch_views_anew(spark, layout):
    spec = TABLES["vendas"]
    for upto, mode in ((4, None), (7, "replace"), (7, None)):
        source = FrameSource({"vendas": shop.sales(spark, shop.GOLDEN_SALES[:upto])})
        extract_table(spark, source, spec, layout, overlap_seconds=0)
        ingest_table(spark, layout, spec, mode)
        assert all(o.error is None for o in refresh_batch_views(spark, layout))
    newer = shop.sales(spark, shop.GOLDEN_SALES[4:])
    for view in VIEWS.values():
        stored = read_batch_view(spark, layout, view)
        assert shop.rows_of(stored) == shop.rows_of(rollup(newer, view, "total"))


def test_full_refresh_starts_from_all_sales(spark, layout):
    spec = TABLES["vendas"]
    extract_table(spark, FrameSource({"vendas": shop.sales(spark)}), spec, layout)
    ingest_table(spark, layout, spec)
    refresh_batch_views(spark, layout)
    refresh_batch_views(spark, layout, full=True, salt="s")
    for view in VIEWS.values():
        wanted = rollup(shop.sales(spark), view, "total", salt="s")
        assert shop.rows_of(read_batch_view(spark, layout, view)) == shop.rows_of(wanted)


def test_empty_batch_keeps_id_zero(spark):
    batch = rollup(shop.sales(spark).where("false"), DAILY_REVENUE, "total")
    events = shop.events(spark).withColumn("id_venda", F.col("id_venda") - 1)
    gold = gold_view(batch, speed_view(events, DAILY_REVENUE), DAILY_REVENUE)
    assert gold.agg(F.sum("qtd_vendas")).first()[0] == len(shop.GOLDEN_SALES)
