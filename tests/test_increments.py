"""Extraction and ingestion as a sequence of runs over a changing source."""

from __future__ import annotations

import re
from functools import partial

import pytest
import shop
from pyspark.sql import functions as F

from vendaval.operators import changed_since, delta_profile, view_since
from vendaval.operators import manifest as manifests
from vendaval.operators.quality import COLUMN_PATTERNS
from vendaval.plans import (
    extract_all,
    ingest_all,
    ingest_table,
    purge_snapshots,
    read_master,
    refresh_batch_views,
    refresh_gold_views,
)
from vendaval.plans import extract_table as extract_with_overlap
from vendaval.plans.batch_views import read_batch_view
from vendaval.plans.checks import read_checked, store_checked
from vendaval.plans.extract import children_first, last_extracted, read_manifest
from vendaval.plans import ingest as ingests
from vendaval.plans import masters
from vendaval.plans.ingest import pending_snapshots
from vendaval.plans.layout import Layout
from vendaval.plans.masters import RANGE, last_ingest, read_log
from vendaval.sources import FrameSource
from vendaval.sources.files import delete_path, list_names, path_exists
from vendaval.specs import BASE_WATERMARK, TABLES, VIEWS

# Without overlap the numbers of rows are plain; the default is tested by itself.
extract_table = partial(extract_with_overlap, overlap_seconds=0)

VENDAS, PRODUTOS, ITENS = TABLES["vendas"], TABLES["produtos"], TABLES["itens_venda"]


def source(spark, sales=(), products=()):
    return FrameSource(
        {
            "vendas": shop.sales(spark, list(sales)),
            "produtos": shop.table(spark, "produtos", list(products)),
        }
    )


def test_no_manifest_and_no_master(spark, layout):
    assert last_extracted(spark, layout, "vendas") == BASE_WATERMARK
    outcome = ingest_table(spark, layout, VENDAS)
    assert outcome.rows == 0 and outcome.path is None
    assert read_master(spark, layout, VENDAS).count() == 0
    assert not path_exists(spark, layout.master("vendas"))


def test_first_load_delta_and_idle_run(spark, layout):
    old, new = shop.GOLDEN_SALES[:4], shop.GOLDEN_SALES[4:]
    first = extract_table(spark, source(spark, old), VENDAS, layout)
    assert first.rows == 4 and first.watermark.startswith("2025-04-11 09:00:04")
    assert ":" not in first.path.rsplit("/", 1)[1]
    assert ingest_table(spark, layout, VENDAS).rows == 4

    idle = extract_table(spark, source(spark, old), VENDAS, layout)
    assert idle.rows == 0 and idle.path is None
    assert ingest_table(spark, layout, VENDAS).path is None
    assert read_manifest(spark, layout).count() == 1

    second = extract_table(spark, source(spark, old + new), VENDAS, layout)
    assert second.rows == 3
    assert ingest_table(spark, layout, VENDAS).rows == 3
    assert shop.rows_of(read_master(spark, layout, VENDAS)) == shop.rows_of(shop.sales(spark))
    assert ingest_table(spark, layout, VENDAS).path is None


def test_several_pending_snapshots_are_one_ingest(spark, layout):
    for upto in (3, 5, 7):
        extract_table(spark, source(spark, shop.GOLDEN_SALES[:upto]), VENDAS, layout)
    assert pending_snapshots(spark, layout, VENDAS).count() == 3
    assert ingest_table(spark, layout, VENDAS).rows == 7
    assert pending_snapshots(spark, layout, VENDAS).count() == 0


def test_replace_keeps_only_the_new_rows(spark, layout):
    extract_table(spark, source(spark, shop.GOLDEN_SALES[:4]), VENDAS, layout)
    ingest_table(spark, layout, VENDAS)
    extract_table(spark, source(spark, shop.GOLDEN_SALES), VENDAS, layout)
    assert ingest_table(spark, layout, VENDAS, mode="replace").rows == 3
    assert shop.rows_of(read_master(spark, layout, VENDAS), "id_venda") == [("5",), ("6",), ("7",)]


def test_modes_are_checked(spark, layout):
    with pytest.raises(ValueError, match="unknown"):
        ingest_table(spark, layout, VENDAS, mode="merge")
    with pytest.raises(ValueError, match="several versions"):
        ingest_table(spark, layout, PRODUTOS, mode="append")


def test_replace_of_a_mutable_table_keeps_one_row_per_key(spark, layout):
    for day in (1, 2):
        rows = [shop.product(1, price=f"{day}.00", updated=f"2025-04-0{day} 12:00:00")]
        extract_table(spark, source(spark, products=rows), PRODUTOS, layout)
    ingest_table(spark, layout, PRODUTOS, mode="replace")
    assert shop.rows_of(read_master(spark, layout, PRODUTOS), "preco") == [("2.00",)]


def test_updated_row_replaces_its_older_version(spark, layout):
    before = [shop.product(1), shop.product(2, "Martelo", "30.00")]
    extract_table(spark, source(spark, products=before), PRODUTOS, layout)
    ingest_table(spark, layout, PRODUTOS)
    after = [before[0], shop.product(2, "Martelo", "35.50", updated="2025-04-09 12:00:00")]
    outcome = extract_table(spark, source(spark, products=after), PRODUTOS, layout)
    assert outcome.rows == 1 and outcome.watermark.startswith("2025-04-09 12:00:00")
    ingest_table(spark, layout, PRODUTOS)
    assert shop.rows_of(read_master(spark, layout, PRODUTOS), "id_produto", "preco") == [
        ("1", "9.90"),
        ("2", "35.50"),
    ]
    assert extract_table(spark, source(spark, products=after), PRODUTOS, layout).rows == 0


def test_same_second_arrival(spark, layout):
    early = (1, 1, 1, "2025-04-10", "10.00", "2025-04-10 10:00:00")
    late = (2, 1, 1, "2025-04-10", "20.00", "2025-04-10 10:00:00")
    extract_table(spark, source(spark, [early]), VENDAS, layout)
    ingest_table(spark, layout, VENDAS)
    assert extract_table(spark, source(spark, [early, late]), VENDAS, layout).rows == 0
    again = extract_with_overlap(spark, source(spark, [early, late]), VENDAS, layout)
    assert again.rows == 2
    assert ingest_table(spark, layout, VENDAS).rows == 1
    assert shop.rows_of(read_master(spark, layout, VENDAS), "id_venda") == [("1",), ("2",)]


def test_interrupted_append_is_invisible_and_repeatable(spark, layout, monkeypatch):
    extract_table(spark, source(spark, shop.GOLDEN_SALES[:4]), VENDAS, layout)
    outcome = ingest_table(spark, layout, VENDAS)
    extract_table(spark, source(spark, shop.GOLDEN_SALES[:6]), VENDAS, layout)

    def lost(*args):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as broken:
        broken.setattr(masters, "record_ingest", lost)
        with pytest.raises(RuntimeError):
            ingest_table(spark, layout, VENDAS)
    assert read_master(spark, layout, VENDAS).count() == outcome.rows == 4
    assert masters.read_facts(spark, layout, VENDAS, listed=False).count() == 6
    # More has come before the repetition: only what is missing is added.
    extract_table(spark, source(spark, shop.GOLDEN_SALES), VENDAS, layout)
    assert ingest_table(spark, layout, VENDAS).rows == 1
    assert shop.rows_of(read_master(spark, layout, VENDAS)) == shop.rows_of(shop.sales(spark))


@pytest.mark.parametrize("fails", ["parquet", "record_ingest"])
def test_interrupted_upsert_goes_on_from_what_it_wrote(spark, layout, monkeypatch, fails):
    rows = [shop.product(i) for i in range(1, 6)]
    extract_table(spark, source(spark, products=rows), PRODUTOS, layout)
    ingest_table(spark, layout, PRODUTOS)
    rows[2] = shop.product(3, price="1.23", updated="2025-04-09 12:00:00")
    extract_table(spark, source(spark, products=rows), PRODUTOS, layout)

    def lost(*args):
        if fails == "parquet":  # as if the overwrite had deleted a range and not put it back
            for name in list_names(spark, masters.ranges_path(spark, layout, PRODUTOS)):
                if name.startswith(RANGE):
                    delete_path(spark, f"{masters.ranges_path(spark, layout, PRODUTOS)}/{name}")
        raise RuntimeError("driver lost")

    with monkeypatch.context() as broken:
        broken.setattr(masters, "finish_ranges" if fails == "parquet" else "record_ingest", lost)
        if fails == "parquet":
            broken.setattr(ingests, "finish_ranges", lambda *args: None)
        with pytest.raises(RuntimeError):
            ingest_table(spark, layout, PRODUTOS)
    ingest_table(spark, layout, PRODUTOS)
    prices = [("1", "9.90"), ("2", "9.90"), ("3", "1.23"), ("4", "9.90"), ("5", "9.90")]
    assert shop.rows_of(read_master(spark, layout, PRODUTOS), "id_produto", "preco") == prices
    assert pending_snapshots(spark, layout, PRODUTOS).count() == 0


def test_common_upper_bound(spark, layout):
    until = "2025-04-11 09:00:04"
    outcome = extract_table(spark, source(spark, shop.GOLDEN_SALES), VENDAS, layout, until=until)
    assert outcome.rows == 4
    assert extract_table(spark, source(spark, shop.GOLDEN_SALES), VENDAS, layout).rows == 3


def test_failing_table_does_not_stop_the_others(spark, layout):
    outcomes = extract_all(spark, source(spark, shop.GOLDEN_SALES, [shop.product(1)]), layout)
    by_name = {o.name: o for o in outcomes}
    assert by_name["vendas"].rows == 7 and by_name["produtos"].rows == 1
    assert isinstance(by_name["clientes"].error, KeyError)
    assert {r["table"] for r in read_manifest(spark, layout).collect()} == {"vendas", "produtos"}
    assert [o.rows for o in ingest_all(spark, layout)] == [0, 7, 1, 0, 0]


def test_failed_snapshot_is_not_recorded(spark, layout):
    class Broken(FrameSource):
        def delta(self, *args):
            rows = super().delta(*args)
            return rows.withColumn("total", F.raise_error(F.lit("lost")).cast("decimal(10,2)"))

    broken = Broken(source(spark, shop.GOLDEN_SALES).tables)
    assert extract_all(spark, broken, layout, ["vendas"])[0].error is not None
    assert read_manifest(spark, layout).count() == 0


def test_purge_deletes_old_ingested_snapshots_only(spark, layout):
    first = extract_table(spark, source(spark, shop.GOLDEN_SALES[:4]), VENDAS, layout)
    ingest_table(spark, layout, VENDAS)
    second = extract_table(spark, source(spark, shop.GOLDEN_SALES), VENDAS, layout)
    products = extract_table(spark, source(spark, products=[shop.product(1)]), PRODUTOS, layout)

    assert purge_snapshots(spark, layout, today="2025-04-30") == []
    assert purge_snapshots(spark, layout, today="2025-05-30") == [first.path]
    assert not path_exists(spark, first.path)
    assert path_exists(spark, second.path) and path_exists(spark, products.path)
    assert {r["path"] for r in read_manifest(spark, layout).collect()} == {
        second.path,
        products.path,
    }
    assert ingest_table(spark, layout, VENDAS).rows == 3
    assert extract_table(spark, source(spark, shop.GOLDEN_SALES), VENDAS, layout).rows == 0


def files_of(spark, layout, spec):
    path = masters.ranges_path(spark, layout, spec)
    folders = [n for n in list_names(spark, path) if n.startswith(f"{RANGE}=")]
    return {f"{n}/{f}" for n in folders for f in list_names(spark, f"{path}/{n}") if f.endswith(".parquet")}


def test_small_delta_rewrites_few_files(spark, tmp_path):
    """One per cent of the keys, new and changed, side by side: under five per cent of the files."""
    layout = Layout(str(tmp_path / "shop"), range_width=100)
    rows = [shop.product(i) for i in range(1, 4000)]
    extract_table(spark, source(spark, products=rows), PRODUTOS, layout)
    ingest_table(spark, layout, PRODUTOS)
    before = files_of(spark, layout, PRODUTOS)
    changed = [shop.product(i, price="1.23", updated="2025-04-09 12:00:00") for i in range(3980, 4000)]
    changed += [shop.product(i, created="2025-04-09 11:00:00") for i in range(4000, 4020)]
    extract_table(spark, source(spark, products=rows[:3979] + changed), PRODUTOS, layout)
    assert ingest_table(spark, layout, PRODUTOS).rows == 100 + 20  # both ranges whole
    after = files_of(spark, layout, PRODUTOS)
    assert len(before) == 40 and len(after) == 41
    assert len(before - after) / len(before) < 0.05 and len(after - before) == 2
    found = read_master(spark, layout, PRODUTOS)
    assert found.count() == 4019 and found.where("preco = 1.23").count() == 20
    assert found.select("id_produto").distinct().count() == 4019


def test_upsert_reads_only_the_ranges_it_touches(spark, tmp_path):
    layout = Layout(str(tmp_path / "shop"), range_width=10)
    rows = [shop.product(i) for i in range(40)] + [shop.product(None, "Sem chave")]
    extract_table(spark, source(spark, products=rows), PRODUTOS, layout)
    ingest_table(spark, layout, PRODUTOS)
    some = masters.read_ranges(spark, layout, PRODUTOS, only=[2, None])
    assert sorted(r.id_produto or -1 for r in some.collect()) == [-1, *range(20, 30)]
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*faixa", plan)
    # An existing master keeps the width of its ranges.
    assert masters.ranges_path(spark, Layout(layout.root, range_width=77), PRODUTOS).endswith("=10")


def test_append_only_master_keeps_its_buckets(spark, tmp_path):
    layout = Layout(str(tmp_path / "shop"), buckets=4)
    extract_table(spark, source(spark, shop.GOLDEN_SALES[:4]), VENDAS, layout)
    path = ingest_table(spark, layout, VENDAS).path
    extract_table(spark, source(spark, shop.GOLDEN_SALES), VENDAS, layout)
    layout = Layout(layout.root, buckets=16)
    assert ingest_table(spark, layout, VENDAS).path == path and path.endswith("baldes=4")
    assert shop.rows_of(read_master(spark, layout, VENDAS)) == shop.rows_of(shop.sales(spark))
    assert shop.rows_of(read_log(spark, layout, "vendas"), "mode", "rows") == [("append", "3"), ("append", "4")]
    recent = read_master(spark, layout, VENDAS, since="2025-04-12 00:00:00")
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"Filter [^\n]*criacao#\d+ >= 2025-04-12", plan)
    assert shop.rows_of(recent, "id_venda") == [("7",)]
    # What a session before declared in its catalog is found again by its folder.
    spark.sql(f"DROP TABLE {masters.facts_table(spark, layout, VENDAS)}")
    assert read_master(spark, layout, VENDAS).count() == 7


def test_master_with_awkward_folder(spark, tmp_path):
    layout = Layout(str(tmp_path / "the shop's `data` ü"))
    extract_table(spark, source(spark, shop.GOLDEN_SALES, [shop.product(1)]), VENDAS, layout)
    extract_table(spark, source(spark, shop.GOLDEN_SALES, [shop.product(1)]), PRODUTOS, layout)
    assert [o.rows for o in ingest_all(spark, layout, ["vendas", "produtos"])] == [7, 1]
    assert read_master(spark, layout, VENDAS).count() == 7
    assert last_ingest(spark, layout, "produtos") is not None


def test_null_update_time_does_not_hide_a_new_row(spark):
    rows = shop.table(
        spark,
        "produtos",
        [
            shop.product(1, created="2025-04-01 00:00:00"),
            shop.product(2, created="2025-04-03 00:00:00"),
            shop.product(3, created="2025-04-01 00:00:00", updated="2025-04-03 00:00:00"),
        ],
    )
    columns = PRODUTOS.version_columns
    changed = changed_since(rows, "2025-04-02 00:00:00", columns)
    assert shop.rows_of(changed, "id_produto") == [("2",), ("3",)]
    profile = delta_profile(rows, "2025-04-03 00:00:00", columns, "id_produto").first()
    assert (profile["low_bound"], profile["qtd_linhas"], profile["watermark"]) == (None, 0, None)


def test_manifest_questions_on_text_dates(spark):
    manifest = spark.createDataFrame(
        [
            ("vendas", "2025-04-01 00:00:00", "a"),
            ("vendas", "2025-05-01 00:00:00", "b"),
            ("clientes", "2025-04-15 00:00:00", "c"),
            ("clientes", "not a date", "d"),
        ],
        "table string, date string, path string",
    )
    assert shop.rows_of(manifests.latest(manifest)) == [
        ("clientes", "2025-04-15 00:00:00"),
        ("vendas", "2025-05-01 00:00:00"),
    ]
    assert shop.rows_of(manifests.pending(manifest, "vendas", "a"), "path") == [("b",)]
    assert shop.rows_of(manifests.pending(manifest, "vendas", None), "path") == [("a",), ("b",)]
    keep, expired = manifests.split_expired(manifest, "2025-05-15")
    assert shop.rows_of(keep, "path") == [("b",), ("d",)]
    assert shop.rows_of(expired, "path") == [("a",), ("c",)]


def test_first_load_takes_all_rows(spark, layout):
    old = (9, 1, 1, "1990-01-01", "1.00", "1990-01-01 00:00:00")
    assert extract_with_overlap(spark, source(spark, [old]), VENDAS, layout).rows == 1


def test_row_updated_during_the_run_is_not_put_off(spark, layout):
    rows = [
        shop.product(1, created="2025-04-01 00:00:00", updated="2025-04-05 00:00:00"),
        shop.product(2, created="2025-04-03 00:00:00"),
    ]
    until = "2025-04-02 00:00:00"
    outcome = extract_table(spark, source(spark, products=rows), PRODUTOS, layout, until=until)
    assert outcome.rows == 1 and outcome.watermark.startswith("2025-04-02 00:00:00")
    assert extract_table(spark, source(spark, products=rows), PRODUTOS, layout).rows == 2
    ingest_table(spark, layout, PRODUTOS)
    assert read_master(spark, layout, PRODUTOS).count() == 2


def test_one_row_per_key_however_it_arrives(spark, layout):
    def line(quantity, created):
        return (1, 1, quantity, "1.00", "1.00", "0.00", created)

    first, second = line(1, "2025-04-01 00:00:00"), line(2, "2025-04-02 00:00:00")
    lines = FrameSource({"itens_venda": shop.table(spark, "itens_venda", [first, second, first])})
    extract_table(spark, lines, ITENS, layout, until="2025-04-01 12:00:00")
    assert ingest_table(spark, layout, ITENS).rows == 1
    extract_table(spark, lines, ITENS, layout)
    assert ingest_table(spark, layout, ITENS).rows == 0
    assert shop.rows_of(read_master(spark, layout, ITENS), "quantidade") == [("1",)]


def test_ids_beyond_four_bytes(spark, layout):
    big = (3_000_000_000, 1, 1, "2025-04-10", "1.00", "2025-04-10 10:00:00")
    extract_table(spark, source(spark, [big]), VENDAS, layout)
    ingest_table(spark, layout, VENDAS)
    assert shop.rows_of(read_master(spark, layout, VENDAS), "id_venda") == [("3000000000",)]


def test_snapshot_without_a_column_is_refused(spark, layout):
    extract_table(spark, source(spark, shop.GOLDEN_SALES), VENDAS, layout)
    path = pending_snapshots(spark, layout, VENDAS).first()["path"]
    shop.sales(spark).drop("total").write.mode("overwrite").parquet(path)
    with pytest.raises(ValueError, match="total"):
        ingest_table(spark, layout, VENDAS)


def test_no_line_comes_without_its_sale(spark, layout):
    """Sales with their lines are inserted while tables are being profiled and read."""

    class Growing(FrameSource):
        def __init__(self):
            self.n = 10

        @property
        def tables(self):
            self.n += 5  # five more sales at every look at the source
            times = [f"2025-04-10 10:{i // 60:02d}:{i % 60:02d}" for i in range(self.n)]
            sales = [(i, 1, 1, "2025-04-10", "1.00", t) for i, t in enumerate(times)]
            lines = [(p, i, 1, "1.00", "1.00", "0.00", t) for i, t in enumerate(times) for p in (1, 2)]
            return {"vendas": shop.sales(spark, sales), "itens_venda": shop.table(spark, "itens_venda", lines)}

    growing, names = Growing(), ["vendas", "itens_venda"]
    for _ in range(2):
        outcomes = extract_all(spark, growing, layout, names)
        assert [o.name for o in outcomes] == names and all(o.error is None for o in outcomes)
        assert all(o.error is None for o in ingest_all(spark, layout, names))
        lines, sales = (read_master(spark, layout, spec) for spec in (ITENS, VENDAS))
        assert lines.join(sales, "id_venda", "left_anti").count() == 0
        assert lines.count() > 0


def test_tables_come_before_those_they_refer_to():
    order = children_first(TABLES)
    assert sorted(order) == sorted(TABLES)
    assert all(order.index(name) < order.index(p) for name, spec in TABLES.items() for p in spec.parents)


def test_checked_rows_are_written_in_one_pass(spark, tmp_path):
    rows = spark.createDataFrame([(1, "12.50"), (2, "12,50"), (3, None), (4, "0.1")], "id int, preco string")
    path = str(tmp_path / "checked")
    store_checked(rows, {"preco": COLUMN_PATTERNS["preco"]}, path)
    valid, rejected = read_checked(spark, path, True), read_checked(spark, path, False)
    assert shop.rows_of(valid) == [("1", "12.50"), ("4", "0.1")]
    assert shop.rows_of(rejected, "id") == [("2",), ("3",)]
    assert [r.failed_rules for r in rejected.collect()] == [["preco"], ["preco"]]
    plan = valid._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(valido" in plan


def test_published_views_are_in_the_order_of_their_key(spark, layout):
    rows = [(i, i % 7, 97 - i % 13, f"2025-04-{28 - i % 20:02d}", "1.00", "2025-04-10 10:00:00") for i in range(1, 400)]
    extract_table(spark, source(spark, rows), VENDAS, layout)
    ingest_table(spark, layout, VENDAS)
    for published in (refresh_batch_views(spark, layout), refresh_gold_views(spark, layout)):
        for outcome in published:
            view = VIEWS[outcome.name]
            files = [f for f in list_names(spark, outcome.path) if f.endswith(".parquet")]
            keys = [r[0] for f in files for r in spark.read.parquet(f"{outcome.path}/{f}").select(view.key).collect()]
            assert keys == sorted(keys) and len(keys) > 5
    recent = view_since(read_batch_view(spark, layout, VIEWS["faturamento_diario"]), "2025-04-20")
    days = [r.data for r in recent.collect()]
    assert days == sorted(days) and len(days) == 8
