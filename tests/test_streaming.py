"""The stream against the batch rollup of the same events."""

from __future__ import annotations

import json
from datetime import datetime, timedelta

import pytest
import shop
from pyspark.sql import functions as F

from vendaval.operators.rollup import rows_of_view
from vendaval.plans import (
    batch_view,
    extract_table,
    ingest_table,
    refresh_batch_views,
    refresh_gold_views,
)
from vendaval.plans.gold_views import (
    event_store,
    gold_view,
    purge_speed,
    read_speed_view,
    speed_store,
)
from vendaval.plans.batch_views import read_batch_view
from vendaval.sources import FrameSource, decode_events, encode_events, read_event_files
from vendaval.sources.day_store import DayStore
from vendaval.sources.files import delete_path, list_names
from vendaval.sources.versioned import last_state, read_current
from vendaval.specs import DAILY_REVENUE, TABLES, VIEWS
from vendaval.streaming import (
    StreamCounts,
    all_windows,
    late_rows,
    newer_than,
    open_windows,
    read_rejected_events,
    read_stored_events,
    read_stream_counts,
    speed_view,
    start_event_store,
    start_gold_refresh,
    start_speed_views,
    starting_cutoff,
)

START = datetime(2025, 4, 10, 10, 0, 0)
NOW = {"availableNow": True}


def event(number, second, **changes):
    stamp = START + timedelta(seconds=second)
    value = {
        "id_vendedor": number % 3 + 1,
        "id_cliente": number % 5 + 1,
        "id_produto": 1,
        "id_venda": number,
        "quantidade": 1,
        "valor_unitario": 10.25,
        "valor_total": 10.25 + number,
        "desconto": 0.5,
        "data": "2025-04-10",
    } | changes
    return {"value": json.dumps(value), "timestamp": stamp.isoformat()}


def deliver(folder, name, records):
    folder.mkdir(exist_ok=True)
    (folder / f"{name}.json").write_text("\n".join(json.dumps(r) for r in records))


def run(spark, folder, layout, cutoff=0, **options):
    events = newer_than(decode_events(read_event_files(spark, str(folder))), cutoff)
    query = start_speed_views(events, layout, trigger=NOW, **options)
    query.awaitTermination()
    return query


def stored(spark, folder):
    return decode_events(spark.read.schema("value string, timestamp timestamp").json(str(folder)))


def windows(frame):
    columns = [c for c in frame.columns if c != "window"]
    return shop.rows_of(frame.select("window.start", *columns))


def test_closed_windows_equal_the_batch_rollup(spark, layout, tmp_path):
    inbox = tmp_path / "inbox"
    deliver(inbox, "a", [event(n, n * 2) for n in range(1, 40)])
    run(spark, inbox, layout)
    watermark = START + timedelta(seconds=39 * 2 - 10)
    for view in VIEWS.values():
        expected = speed_view(stored(spark, inbox), view)
        closed = expected.where(F.col("window.end") <= F.lit(f"{watermark}"))
        found = read_speed_view(spark, layout, view)
        assert windows(found) == windows(closed)
        assert 0 < found.count() < expected.count()


def test_restart_finishes_open_windows_without_duplicates(spark, layout, tmp_path):
    inbox = tmp_path / "inbox"
    deliver(inbox, "a", [event(1, 1), event(2, 12), event(3, 25)])
    run(spark, inbox, layout)
    first = read_speed_view(spark, layout, DAILY_REVENUE).count()
    deliver(inbox, "b", [event(4, 27), event(5, 60)])
    run(spark, inbox, layout)
    found = read_speed_view(spark, layout, DAILY_REVENUE)
    closed = speed_view(stored(spark, inbox), DAILY_REVENUE).where("maior_id < 5")
    assert first == 1 and windows(found) == windows(closed)


def test_late_rows_are_dropped_and_counted(spark, layout, tmp_path):
    inbox = tmp_path / "inbox"
    deliver(inbox, "a", [event(1, 1), event(2, 40)])
    run(spark, inbox, layout)
    deliver(inbox, "b", [event(3, 2), event(4, 80)])
    query = run(spark, inbox, layout)
    found = read_speed_view(spark, layout, DAILY_REVENUE)
    assert shop.rows_of(found, "maior_id", "qtd_vendas") == [("1", "1"), ("2", "1")]
    assert late_rows(query) == len(VIEWS)  # the late event in each view


def test_malformed_and_old_events_are_left_out(spark, layout, tmp_path):
    inbox = tmp_path / "inbox"
    records = [
        event(1, 1),
        event(5, 2),
        {"value": "{not json", "timestamp": START.isoformat()},
        event(6, 3, id_venda=None),
        event(7, 4, id_venda="seven"),
        event(8, 5, valor_total="cheap"),
        event(11, 5, valor_total=1e15),
        event(12, 5, valor_total=float("nan")),
        event(9, 6),
        event(9, 6),
        event(20, 60),
    ]
    deliver(inbox, "a", records)
    run(spark, inbox, layout, cutoff=4)
    row = read_speed_view(spark, layout, DAILY_REVENUE).first()
    assert (row["menor_id"], row["maior_id"], row["qtd_vendas"]) == (5, 12, 6)
    assert str(row["total_faturado"]) == "1000000000000053.75"
    assert str(row["ticket_medio"]) == "250000000000013.44"


def test_events_survive_encoding(spark):
    lines = shop.table(
        spark,
        "itens_venda",
        [(7, n, 2, "10.25", "20.50", "1.03", "2025-04-10 10:00:00") for n in range(1, 8)],
    )
    decoded = decode_events(encode_events(shop.sales(spark), lines))
    assert decoded.count() == 7
    row = decoded.where("id_venda = 2").first()
    assert (row["id_vendedor"], row["id_cliente"], row["id_produto"]) == (2, 10, 7)
    assert (row["valor_total"], row["desconto"], str(row["data"])) == (20.5, 1.03, "2025-04-10")
    schema = "value binary, timestamp timestamp"
    binary = spark.createDataFrame([(bytearray(b'{"id_venda": 3}'), START)], schema)
    assert decode_events(binary).first()["id_venda"] == 3


def master(spark, layout, rows):
    spec = TABLES["vendas"]
    extract_table(spark, FrameSource({"vendas": shop.sales(spark, rows)}), spec, layout)
    ingest_table(spark, layout, spec)


def test_batch_speed_and_gold_together(spark, layout, tmp_path):
    assert starting_cutoff(spark, layout) is None
    assert refresh_batch_views(spark, layout) == []
    assert all(o.path is None and o.error is None for o in refresh_gold_views(spark, layout))

    master(spark, layout, shop.GOLDEN_SALES[:4])
    assert all(o.error is None for o in refresh_batch_views(spark, layout))
    assert starting_cutoff(spark, layout) == 4
    expected = batch_view(shop.sales(spark, shop.GOLDEN_SALES[:4]), DAILY_REVENUE)
    found = read_current(spark, layout.batch_view("faturamento_diario"), DAILY_REVENUE.batch_schema)
    assert shop.rows_of(found) == shop.rows_of(expected)

    # No speed view yet: gold is the batch alone.
    assert all(o.error is None for o in refresh_gold_views(spark, layout))
    gold = spark.read.parquet(refresh_gold_views(spark, layout)[0].path)
    assert shop.rows_of(gold, "data", "qtd_vendas") == [("2025-04-10", "2"), ("2025-04-11", "2")]

    inbox = tmp_path / "inbox"
    deliver(inbox, "a", [event(5, 1), event(6, 2), event(7, 60)])
    run(spark, inbox, layout, starting_cutoff(spark, layout))
    start_gold_refresh(spark, layout, trigger=NOW).awaitTermination()
    schema = gold.schema
    fresh = read_current(spark, layout.gold_view("faturamento_diario"), schema)
    assert shop.rows_of(fresh, "data", "qtd_vendas") == [("2025-04-10", "4"), ("2025-04-11", "2")]

    recent = shop.events(spark)
    exact = refresh_gold_views(spark, layout, recent_sales=recent)
    assert all(o.error is None for o in exact)
    assert shop.rows_of(spark.read.parquet(exact[0].path), "data", "total_faturado") == [
        ("2025-04-10", "150.55"),
        ("2025-04-11", "100.55"),
        ("2025-04-12", "70.00"),
    ]


def test_stored_and_open_windows_are_all_windows(spark, layout, tmp_path):
    inbox = tmp_path / "inbox"
    assert open_windows(spark, layout).count() == 0
    records = [event(n, n * 3) for n in range(1, 20)] + [event(30, 58, valor_total="cheap", id_cliente=None)]
    deliver(inbox, "a", records)
    for _ in range(2):
        run(spark, inbox, layout)
        found, waiting = all_windows(spark, layout), open_windows(spark, layout).count()
        for view in VIEWS.values():
            whole = speed_view(stored(spark, inbox), view)
            assert windows(rows_of_view(found, view)) == windows(whole)
        assert 0 < waiting < found.count()
        deliver(inbox, "b", [event(40, 61), event(41, 90)])


def test_windows_of_an_uncommitted_micro_batch_count_once(spark, layout, tmp_path):
    inbox = tmp_path / "inbox"
    deliver(inbox, "a", [event(1, 1), event(2, 12)])
    run(spark, inbox, layout)
    before = windows(all_windows(spark, layout).drop("dia"))
    # The next micro-batch stores a window that the last complete state still holds.
    waiting = open_windows(spark, layout)
    speed_store(layout).add(waiting.where("visao = 'faturamento_diario'"), 99)
    assert windows(all_windows(spark, layout).drop("dia")) == before
    assert open_windows(spark, layout).where("visao = 'faturamento_diario'").count() == 0


def test_one_source_and_one_state_serve_all_views(spark, layout, tmp_path):
    inbox = tmp_path / "inbox"
    deliver(inbox, "a", [event(1, 1), event(2, 12), event(3, 60)])
    query = run(spark, inbox, layout)
    progress = query.lastProgress or query.recentProgress[-1]
    assert len(progress["sources"]) == 1 and len(progress["stateOperators"]) == 1
    assert {v.name: read_speed_view(spark, layout, v).count() for v in VIEWS.values()} == dict.fromkeys(VIEWS, 2)


DAYS = "visao string, n long, dia date"


def batches(spark, tmp_path, **options):
    """A store, and a function that adds a micro-batch of one row per (view, day, n)."""
    schema = spark.createDataFrame([], DAYS).schema
    store = DayStore(str(tmp_path / "store"), schema, by="visao", **options)

    def add(batch, *rows):
        frame = spark.createDataFrame([(v, n, d) for v, d, n in rows], "visao string, n long, dia string")
        store.add(frame.withColumn("dia", F.col("dia").cast("date")), batch)

    return store, add


def numbers(store, spark, **days):
    return sorted(r["n"] for r in store.read(spark, **days).collect())


def files(spark, root):
    found = []
    for name in list_names(spark, root):
        path = f"{root}/{name}"
        found += [path] if name.endswith(".parquet") else files(spark, path) if "=" in name or "." not in name and not name.startswith("_") else []
    return found


def test_repeated_micro_batch_or_fold_adds_nothing(spark, tmp_path):
    store, add = batches(spark, tmp_path, fold_every=2)
    steps = [
        (0, [("a", "2025-04-10", 1), ("b", "2025-04-10", 2)]),
        (1, [("a", "2025-04-10", 3)]),
        (2, [("a", "2025-04-11", 4)]),
        (3, [("b", "2025-04-11", 5), ("a", "2025-04-12", 6)]),
        (4, [("a", "2025-04-12", 7)]),
    ]
    for batch, rows in steps:
        add(batch, *rows)
        add(batch, *rows)
        seen = [n for b, own in steps if b <= batch for _, _, n in own]
        assert numbers(store, spark) == seen
    assert store.mark(spark) == (3, datetime(2025, 4, 11).date())
    assert numbers(store, spark, after=datetime(2025, 4, 11).date()) == [6, 7]
    assert numbers(store, spark, upto=datetime(2025, 4, 10).date()) == [1, 2, 3]


@pytest.mark.parametrize("lost", ["closed", "folded", "mark"])
def test_fold_that_failed_half_way_is_repeated(spark, tmp_path, monkeypatch, lost):
    store, add = batches(spark, tmp_path, fold_every=3)
    add(0, ("a", "2025-04-10", 1))
    add(1, ("a", "2025-04-10", 2), ("b", "2025-04-11", 3))
    with monkeypatch.context() as broken:

        def fail(rows, *args):
            raise RuntimeError("driver lost")

        if lost == "mark":
            import vendaval.sources.day_store as module

            broken.setattr(module, "publish", fail)
        else:
            write = DayStore._write
            broken.setattr(
                DayStore, "_write", lambda self, rows, area, parts: fail(rows) if area == lost else write(self, rows, area, parts)
            )
        with pytest.raises(RuntimeError):
            add(2, ("a", "2025-04-12", 4))
    assert numbers(store, spark) == [1, 2, 3, 4]
    add(2, ("a", "2025-04-12", 4))
    assert numbers(store, spark) == [1, 2, 3, 4] and store.mark(spark)[0] == 2


def test_files_stay_few_over_many_micro_batches(spark, tmp_path):
    """200 micro-batches, fifty to a day: files are bounded by the fold, closed days are one file a view."""
    store, add = batches(spark, tmp_path, fold_every=10)
    most = 0
    for batch in range(200):
        day = f"2025-04-{10 + batch // 50}"
        add(batch, ("a", day, 2 * batch), ("b", day, 2 * batch + 1))
        if batch % 25 == 24:
            most = max(most, len(files(spark, store.root)))
    assert numbers(store, spark) == list(range(400))
    closed = files(spark, f"{store.root}/closed")
    assert len(closed) == 3 * 2
    # Two generations of open micro-batches, the folds of two days, the closed days, the marks.
    assert most <= 2 * 2 * 10 + 2 * 2 * 5 + len(closed) + 2


def test_late_rows_of_any_day_are_kept_where_days_never_close(spark, tmp_path):
    store, add = batches(spark, tmp_path, fold_every=2, closes=False)
    for batch, day in enumerate(("2025-04-12", "2025-04-10", "2025-04-13", "2025-04-10", "2025-04-09")):
        add(batch, ("a", day, batch))
    assert numbers(store, spark) == [0, 1, 2, 3, 4]
    assert store.purge(spark, "n", 1) == ["2025-04-12"]
    assert numbers(store, spark) == [1, 2, 3, 4]


def stream_days(spark, layout, tmp_path, *days):
    """Sales of several days through the speed views, a micro-batch and a fold per day."""
    inbox = tmp_path / "inbox"
    for day, numbers_of_day in days:
        deliver(inbox, f"day{day}", [event(n, day * 86_400 + n, data=f"2025-04-{10 + day}") for n in numbers_of_day])
        run(spark, inbox, layout, starting_cutoff(spark, layout), fold_every=1)


def test_second_gold_refresh_reads_only_open_days(spark, layout, tmp_path):
    master(spark, layout, shop.GOLDEN_SALES[:4])
    refresh_batch_views(spark, layout)
    # Windows of the last day but one are all out once the last day has begun.
    stream_days(spark, layout, tmp_path, (0, (5, 6, 40)), (1, (41, 42, 80)), (2, (81, 82, 120)), (3, (121, 160)))
    store = speed_store(layout)
    _, closed = store.mark(spark)
    assert closed == datetime(2025, 4, 12).date()
    windows = read_speed_view(spark, layout, DAILY_REVENUE)
    batch = read_batch_view(spark, layout, DAILY_REVENUE)
    expected = shop.rows_of(gold_view(batch, windows, DAILY_REVENUE))
    for outcome in refresh_gold_views(spark, layout):
        assert outcome.error is None
    state = last_state(spark, layout.gold_state(DAILY_REVENUE.name))
    for name in list_names(spark, f"{store.root}/closed"):
        delete_path(spark, f"{store.root}/closed/{name}")
    outcomes = refresh_gold_views(spark, layout)
    assert all(o.error is None for o in outcomes)
    assert shop.rows_of(spark.read.parquet(outcomes[0].path)) == expected and len(expected) == 4
    assert last_state(spark, layout.gold_state(DAILY_REVENUE.name)) == state


def test_gold_state_takes_in_the_days_closed_since(spark, layout, tmp_path):
    master(spark, layout, shop.GOLDEN_SALES[:4])
    refresh_batch_views(spark, layout)
    steps = [(0, (5, 6, 40)), (1, (41, 42, 80)), (2, (81, 82, 120)), (3, (121, 160)), (4, (161, 200))]
    states = set()
    for step in steps:
        stream_days(spark, layout, tmp_path, step)
        outcomes = {o.name: o for o in refresh_gold_views(spark, layout)}
        for view in VIEWS.values():
            assert outcomes[view.name].error is None
            wanted = gold_view(read_batch_view(spark, layout, view), read_speed_view(spark, layout, view), view)
            assert shop.rows_of(spark.read.parquet(outcomes[view.name].path)) == shop.rows_of(wanted)
        states.add(last_state(spark, layout.gold_state(DAILY_REVENUE.name)))
    assert len(states) > 2
    # A new batch view, of all sales so far, starts a new state; then nothing of speed is left to add.
    rows = [(n, n % 3 + 1, n % 5 + 1, "2025-04-14", "1.00", "2025-04-14 10:00:00") for n in range(8, 201)]
    master(spark, layout, rows)
    refresh_batch_views(spark, layout)
    before = read_speed_view(spark, layout, DAILY_REVENUE).count()
    gold = spark.read.parquet(refresh_gold_views(spark, layout)[0].path)
    batch = read_batch_view(spark, layout, DAILY_REVENUE)
    assert gold.agg(F.sum("qtd_vendas")).first()[0] == batch.agg(F.sum("qtd_vendas")).first()[0]
    assert len(purge_speed(spark, layout)["windows"]) >= 2
    assert read_speed_view(spark, layout, DAILY_REVENUE).count() < before
    again = spark.read.parquet(refresh_gold_views(spark, layout)[0].path)
    assert shop.rows_of(again) == shop.rows_of(gold)


def test_event_store_keeps_accepted_and_rejected_apart(spark, layout, tmp_path):
    inbox = tmp_path / "inbox"
    deliver(inbox, "a", [event(1, 1), event(2, 2, valor_total="cheap"), {"value": "{no", "timestamp": START.isoformat()}])
    for _ in range(2):
        query = start_event_store(read_event_files(spark, str(inbox)), layout, trigger=NOW, fold_every=1)
        query.awaitTermination()
        assert all(len(p["sources"]) == 1 for p in query.recentProgress)
        deliver(inbox, "b", [event(3, 90_000)])
    assert sorted(r.id_venda for r in read_stored_events(spark, layout).collect()) == [1, 2, 3]
    assert sorted(r.motivo for r in read_rejected_events(spark, layout).collect()) == ["id_venda", "valor_total"]
    master(spark, layout, shop.GOLDEN_SALES[:2])
    refresh_batch_views(spark, layout)
    assert purge_speed(spark, layout)["events"] == ["2025-04-10"]
    assert [r.id_venda for r in read_stored_events(spark, layout).collect()] == [3]
    exact = start_gold_refresh(spark, layout, exact=True, trigger=NOW)
    exact.awaitTermination()
    path = layout.gold_view(DAILY_REVENUE.name)
    gold = spark.read.parquet(f"{path}/state={last_state(spark, path)}")
    assert gold.agg(F.sum("qtd_vendas")).first()[0] == 3
    assert event_store(layout).mark(spark)[0] == 1


def test_layers_of_different_salt_are_refused(spark, layout, tmp_path):
    master(spark, layout, shop.GOLDEN_SALES[:4])
    refresh_batch_views(spark, layout, salt="s")
    inbox = tmp_path / "inbox"
    deliver(inbox, "a", [event(5, 1), event(6, 60)])
    run(spark, inbox, layout, 4)
    assert all("another salt" in str(o.error) for o in refresh_gold_views(spark, layout))
    exact = refresh_gold_views(spark, layout, recent_sales=shop.events(spark), salt="t")
    assert all("another salt" in str(o.error) for o in exact)
    with pytest.raises(ValueError, match="another salt"):
        run(spark, inbox, layout, 4, salt="s")
    refresh_batch_views(spark, layout)
    assert all(o.error is None for o in refresh_gold_views(spark, layout))


def test_counts_outlive_the_process(spark, layout, tmp_path):
    import time

    inbox = tmp_path / "inbox"
    deliver(inbox, "a", [event(1, 1), event(2, 40)])
    for step in range(2):
        # As a new process would: another listener, which knows nothing of the first run.
        counts = StreamCounts(spark, layout)
        spark.streams.addListener(counts)
        try:
            run(spark, inbox, layout)
            for _ in range(100):  # progress is reported a moment later
                rows = read_stream_counts(spark, layout).collect()
                if rows and rows[0]["lidas"] == (2, 4)[step] and rows[0]["atrasadas"] == (0, 3)[step]:
                    break
                time.sleep(0.1)
        finally:
            spark.streams.removeListener(counts)
        deliver(inbox, "b", [event(3, 2), event(4, 80)])
    (row,) = read_stream_counts(spark, layout).collect()
    assert (row["nome"], row["lidas"], row["atrasadas"]) == ("speed_views", 4, 3)
    counts.count(row["consulta"], "speed_views", row["micro"], 9, 9)
    assert read_stream_counts(spark, layout).first()["lidas"] == 4


def test_speed_view_needs_no_watermark_on_stored_events(spark):
    plan = speed_view(shop.events(spark), DAILY_REVENUE)._jdf.queryExecution().toString()
    assert "EventTimeWatermark" not in plan


@pytest.mark.parametrize("name", sorted(TABLES))
def test_table_declarations(name):
    spec = TABLES[name]
    assert set(spec.key) | {spec.split_column} <= set(spec.schema.fieldNames())
    assert set(spec.version_columns) <= set(spec.schema.fieldNames())
    assert spec.mutable == ("atualizacao" in spec.schema.fieldNames())
