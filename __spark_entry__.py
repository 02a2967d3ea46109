"""Registered queries over the TPC-H-like tables, with the SQL that checks them.

Amounts are computed in exact decimals and leave a registered query as doubles on both
sides, because engines disagree on the decimal type of a sum. The SQL counts in integer
cents, so both sides round the same exact value. Timestamps leave as zone-less timestamps.
"""

from __future__ import annotations

import sys
from collections.abc import Callable
from functools import reduce
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

sys.path.insert(0, str(Path(__file__).resolve().parent))

from vendaval.functions import in_any_range, row_version
from vendaval.operators import (
    append_missing,
    changed_since,
    delta_profile,
    duplicate_keys,
    entity_rules,
    highest_id,
    insert_if_absent,
    orphans,
    price_lines,
    rollup,
    split_valid,
    upsert,
    upsert_small_delta,
    view_since,
    watermark,
)
from vendaval.operators import manifest as manifests
from vendaval.plans import reports
from vendaval.plans.batch_views import read_batch_view, refresh_batch_views
from vendaval.plans.checks import read_checked, referential_report, store_checked
from vendaval.plans.extract import extract_all, extract_table
from vendaval.plans.gold_views import (
    exact_gold_view,
    gold_view,
    refresh_gold_views,
    straddling_windows,
)
from vendaval.plans.ingest import ingest_all, ingest_table, pending_snapshots, read_master
from vendaval.plans.layout import Layout
from vendaval.session import shared_folder
from vendaval.sources.events import decode_events, encode_events, quarantined_events
from vendaval.sources.files import read_snapshots
from vendaval.sources.frames import FrameSource
from vendaval.sources.tpch import TpchShop, event_columns
from vendaval.sources.versioned import run_name
from vendaval.specs import (
    CUSTOMER_TICKET,
    DAILY_REVENUE,
    SELLER_SALES,
    TABLES,
    VIEWS,
    WINDOW,
    ViewSpec,
)
from vendaval.streaming import (
    all_windows,
    newer_than,
    read_stored_events,
    speed_view,
    start_event_store,
    start_speed_views,
)

Query = Callable[[SparkSession, str], DataFrame]

SINCE = "1999-06-30 00:00:00"
TODAY = "2001-06-15"
RANGES = [("1996-01-01", "1996-03-01"), ("1998-05-10", "1998-05-20"), ("2000-12-24", "2001-01-02")]
CUSTOMER_RULES = {
    "cliente": r"\ACustomer#[0-9]{9}\z",
    "estado": r"\ANATION_[0-9]{1,2}\z",
    "status": r"\A(AUTOMOBILE|BUILDING|FURNITURE)\z",
    "saldo": r"\A[0-9]{1,8}(\.[0-9]{1,2})?\z",
}
PROPS_SCHEMA = T.StructType([T.StructField("k", T.IntegerType())])


def _plain(rows: DataFrame) -> DataFrame:
    """Decimals as doubles, timestamps without zone."""
    columns = []
    for field in rows.schema:
        column = F.col(field.name)
        if isinstance(field.dataType, T.DecimalType):
            column = column.cast("double")
        elif isinstance(field.dataType, T.TimestampType):
            column = column.cast("timestamp_ntz")
        columns.append(column.alias(field.name))
    return rows.select(*columns)


def _flat_window(rows: DataFrame) -> DataFrame:
    return rows.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        *[c for c in rows.columns if c != "window"],
    )


# Batch layer


def _batch(view: ViewSpec) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        shop = TpchShop(spark, sf_dir)
        sales = shop.seller_sales if view is SELLER_SALES else shop.sales
        return _plain(rollup(sales, view, "total"))

    return query


def _top1_cutoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return highest_id(rollup(TpchShop(spark, sf_dir).sales, DAILY_REVENUE, "total"))


def _view_since(spark: SparkSession, sf_dir: str) -> DataFrame:
    view = rollup(TpchShop(spark, sf_dir).sales, DAILY_REVENUE, "total")
    return _plain(view_since(view, "2000-04-12"))


def _sales_in_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    sales = TpchShop(spark, sf_dir).sales
    return _plain(sales.where(in_any_range("criacao", RANGES)))


# Speed and gold layers. The batch covers three fifths of the ids; the stream started
# earlier, at two fifths, so some of its windows straddle the batch cutoff.


def _stream_start(events: DataFrame):
    return events.agg(F.expr("max(id_venda) * 2 div 5")).scalar()


def _batch_end(events: DataFrame):
    return events.agg(F.expr("max(id_venda) * 3 div 5")).scalar()


def _speed_rows(events: DataFrame, view: ViewSpec, window: str = WINDOW) -> DataFrame:
    newer = events.where(F.col("id_venda") > _stream_start(events))
    return speed_view(newer, view, window=window)


def _batch_rows(events: DataFrame, view: ViewSpec) -> DataFrame:
    return rollup(events.where(F.col("id_venda") <= _batch_end(events)), view, "valor_total")


def _speed(view: ViewSpec) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        events = TpchShop(spark, sf_dir).events
        return _plain(_flat_window(_speed_rows(events, view)))

    return query


def _gold(view: ViewSpec) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        events = TpchShop(spark, sf_dir).events
        return _plain(gold_view(_batch_rows(events, view), _speed_rows(events, view), view))

    return query


def _gold_exact(view: ViewSpec) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        events = TpchShop(spark, sf_dir).events
        return _plain(exact_gold_view(_batch_rows(events, view), events, view, "valor_total"))

    return query


def _straddling(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = TpchShop(spark, sf_dir).events
    view = CUSTOMER_TICKET
    speed = _speed_rows(events, view, window="1 day")
    rows = straddling_windows(_batch_rows(events, view), speed)
    return _plain(_flat_window(rows))


def _stream(view: ViewSpec) -> Query:
    """The speed view as an actual stream, drained once; windows still open stay out."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        stored = spark.read.parquet(f"{sf_dir}/events.parquet")
        # A glob, because a stream may not start from the path of a single file.
        stream = spark.readStream.schema(stored.schema).parquet(f"{sf_dir}/events.parquet*")
        folder = f"{shared_folder(spark)}/stream_{view.name}_{run_name()}"
        running = (
            speed_view(newer_than(event_columns(stream), None), view)
            .writeStream.outputMode("append")
            .format("parquet")
            .option("path", f"{folder}/rows")
            .option("checkpointLocation", f"{folder}/checkpoint")
            .trigger(availableNow=True)
            .start()
        )
        running.awaitTermination()
        rows = spark.read.schema(view.speed_schema).parquet(f"{folder}/rows")
        return _plain(_flat_window(rows))

    return query


# Reports


def _customer_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.customer_profile(TpchShop(spark, sf_dir).customers_since)


def _daily_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(reports.daily_revenue(TpchShop(spark, sf_dir).sales))


def _item_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    shop = TpchShop(spark, sf_dir)
    return _plain(
        reports.item_detail(shop.lines, shop.products, shop.sales_with_seller, shop.sellers)
    )


def _customer_ticket(spark: SparkSession, sf_dir: str) -> DataFrame:
    shop = TpchShop(spark, sf_dir)
    return _plain(reports.customer_ticket(shop.customers, shop.sales))


def _product_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    shop = TpchShop(spark, sf_dir)
    return _plain(reports.product_sales(shop.lines, shop.products))


def _seller_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    shop = TpchShop(spark, sf_dir)
    return _plain(reports.seller_sales(shop.seller_sales, shop.sellers))


# Increments


def _delta_append_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(changed_since(TpchShop(spark, sf_dir).sales, SINCE, ["criacao"]))


VERSION = ["criacao", "atualizacao"]


def _delta_mutable(spark: SparkSession, sf_dir: str) -> DataFrame:
    changed = changed_since(TpchShop(spark, sf_dir).sale_versions, SINCE, VERSION)
    version = row_version(VERSION).alias("versao")
    return _plain(changed.select("id_venda", "total", "criacao", version))


def _delta_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delta_profile(TpchShop(spark, sf_dir).sale_versions, SINCE, VERSION, "id_venda")


def _watermark_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    shop = TpchShop(spark, sf_dir)
    marks = {
        "vendas": watermark(shop.sales),
        "itens_venda": watermark(shop.lines),
        "versoes": watermark(shop.sale_versions),
    }
    named = [rows.select(F.lit(name).alias("tabela"), "watermark") for name, rows in marks.items()]
    return reduce(DataFrame.unionByName, named)


def _row_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    versions = TpchShop(spark, sf_dir).sale_versions
    return versions.select("id_venda", row_version(VERSION).alias("versao"))


# Manifest


def _manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One snapshot per table and month; dates are text, as in a manifest of strings."""
    shop = TpchShop(spark, sf_dir)

    def monthly(rows: DataFrame, table: str) -> DataFrame:
        month = F.date_format("criacao", "yyyy-MM")
        grouped = rows.groupBy(month.alias("month")).agg(F.max("criacao").alias("newest"))
        return grouped.select(
            F.lit(table).alias("table"),
            F.col("newest").cast("string").alias("date"),
            F.concat(F.lit(f"snapshots/{table}/"), "month").alias("path"),
        )

    return monthly(shop.sales, "vendas").unionByName(monthly(shop.lines, "itens_venda"))


def _manifest_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(manifests.latest(_manifest(spark, sf_dir)))


def _manifest_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifests.pending(_manifest(spark, sf_dir), "vendas", SINCE[:7])


def _retention_keep(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifests.split_expired(_manifest(spark, sf_dir), TODAY)[0]


def _retention_expired(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifests.split_expired(_manifest(spark, sf_dir), TODAY)[1]


# Ingestion


def _ingest_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two extraction runs write snapshots and manifest; then the pending ones are read."""
    spec = TABLES["vendas"]
    source = FrameSource(TpchShop(spark, sf_dir).operational_tables())
    layout = Layout(f"{shared_folder(spark)}/extract_{run_name()}")
    for until in (SINCE, None):
        extract_table(spark, source, spec, layout, until=until, overlap_seconds=0)
    paths = [row["path"] for row in pending_snapshots(spark, layout, spec).collect()]
    return _plain(read_snapshots(spark, spec.schema, paths))


def _ingest_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extraction and ingestion in turn, each time reading a day of old rows again."""
    spec = TABLES["vendas"]
    source = FrameSource(TpchShop(spark, sf_dir).operational_tables())
    layout = Layout(f"{shared_folder(spark)}/ingest_{run_name()}")
    for until in (SINCE, None):
        extract_table(
            spark,
            source,
            spec,
            layout,
            until=until,
            overlap_seconds=86_400,
        )
        ingest_table(spark, layout, spec)
    return _plain(read_master(spark, layout, spec))


def _ingest_append_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines shipped up to a moment are stored; the delta holds every line again."""
    lines = TpchShop(spark, sf_dir).lines
    stored = lines.where(F.col("criacao") <= F.lit(SINCE))
    return _plain(append_missing(stored, lines, TABLES["itens_venda"].key))


def _upsert_inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Sales as the master; every later shipment of a sale is a changed version of it."""
    shop = TpchShop(spark, sf_dir)
    none = F.lit(None).cast("timestamp_ntz")
    master = shop.sales.select("id_venda", "total", "criacao", none.alias("atualizacao"))
    delta = shop.lines.select(
        "id_venda",
        F.col("valor_total").alias("total"),
        "criacao",
        F.col("criacao").alias("atualizacao"),
    )
    return master, delta


def _ingest_upsert(merge) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        master, delta = _upsert_inputs(spark, sf_dir)
        merged = merge(master, delta, ["id_venda"], VERSION)
        return _plain(merged.select("id_venda", "total", row_version(VERSION).alias("versao")))

    return query


def _ingest_master_mutable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products twice: as they are, then with a price raised for every third of them."""
    spec = TABLES["produtos"]
    before = TpchShop(spark, sf_dir).operational_tables()["produtos"]
    raised = F.col("id_produto") % 3 == 0
    after = before.withColumns(
        {
            "preco": F.when(raised, F.col("preco") + 1).otherwise(F.col("preco")).cast("decimal(10,2)"),
            "atualizacao": F.when(raised, F.lit(SINCE).cast("timestamp")),
        }
    )
    layout = Layout(f"{shared_folder(spark)}/mutable_{run_name()}")
    for rows in (before, after):
        extract_table(spark, FrameSource({"produtos": rows}), spec, layout)
        ingest_table(spark, layout, spec)
    return _plain(read_master(spark, layout, spec))


def _ingest_lines_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines in two extractions; their key repeats, and the first line of each stays."""
    spec = TABLES["itens_venda"]
    source = FrameSource(TpchShop(spark, sf_dir).operational_tables())
    layout = Layout(f"{shared_folder(spark)}/lines_{run_name()}")
    for until in (SINCE, None):
        extract_table(spark, source, spec, layout, until=until)
        ingest_table(spark, layout, spec)
    return _plain(read_master(spark, layout, spec))


# Whole jobs: what they publish, read again


def _job_batch(view: ViewSpec) -> Query:
    """Two extractions and ingests, with a refresh after each: the second adds to the first."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        spec = TABLES["vendas"]
        source = FrameSource(TpchShop(spark, sf_dir).operational_tables())
        layout = Layout(f"{shared_folder(spark)}/batch_{run_name()}")
        for until in (SINCE, None):
            extract_table(spark, source, spec, layout, until=until)
            ingest_table(spark, layout, spec)
            _done(refresh_batch_views(spark, layout))
        return _plain(read_batch_view(spark, layout, view))

    return query


def _done(outcomes):
    for outcome in outcomes:
        if outcome.error is not None:
            raise outcome.error
    return {outcome.name: outcome.path for outcome in outcomes}


def _event_sales(events: DataFrame) -> DataFrame:
    """Events as sales, stored or streaming; the seller is made from the user."""
    return event_columns(events).withColumn("id_vendedor", F.col("id_cliente") % 50)


def _job_gold(view: ViewSpec, exact: bool) -> Query:
    """Stored batch view and stored stream output, merged by the gold job.

    The batch holds the sales up to the moment of three fifths of the ids; the stream
    starts at two fifths. The exact view is made from the events the stream stored.
    """

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        spec = TABLES["vendas"]
        stored = spark.read.parquet(f"{sf_dir}/events.parquet")
        sales = _event_sales(stored).withColumns(
            {"total": F.col("valor_total"), "criacao": F.col("timestamp")}
        )
        typed = sales.select(*[F.col(f.name).cast(f.dataType) for f in spec.schema])
        ends = stored.agg(F.expr("max(event_id) * 2 div 5"), F.expr("max(event_id) * 3 div 5")).first()
        until = stored.where(F.col("event_id") <= ends[1]).agg(F.max("ts").cast("string")).first()[0]
        layout = Layout(f"{shared_folder(spark)}/gold_{run_name()}")
        extract_table(spark, FrameSource({"vendas": typed}), spec, layout, until=until)
        ingest_table(spark, layout, spec)
        _done(refresh_batch_views(spark, layout))
        # A glob, because a stream may not start from the path of a single file.
        stream = spark.readStream.schema(stored.schema).parquet(f"{sf_dir}/events.parquet*")
        events, once = _event_sales(stream), {"availableNow": True}
        if exact:
            value = F.to_json(F.struct(*[c for c in events.columns if c != "timestamp"]))
            running = start_event_store(events.select(value.alias("value"), "timestamp"), layout, trigger=once)
        else:
            running = start_speed_views(newer_than(events, ends[0]), layout, trigger=once)
        running.awaitTermination()
        recent = {"recent_sales": read_stored_events(spark, layout)} if exact else {}
        paths = _done(refresh_gold_views(spark, layout, **recent))
        return _plain(spark.read.parquet(paths[view.name]))

    return query


def _stream_all_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All views from one stream, drained: what it stored and what is still in its state."""
    stored = spark.read.parquet(f"{sf_dir}/events.parquet")
    # A glob, because a stream may not start from the path of a single file.
    stream = spark.readStream.schema(stored.schema).parquet(f"{sf_dir}/events.parquet*")
    layout = Layout(f"{shared_folder(spark)}/windows_{run_name()}")
    events = newer_than(event_columns(stream), None)
    start_speed_views(events, layout, trigger={"availableNow": True}).awaitTermination()
    return _plain(_flat_window(all_windows(spark, layout)).drop("dia"))


def _job_item_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report over the masters: facts bucketed by sale, stored in two lots."""
    tables = TpchShop(spark, sf_dir).operational_tables()
    layout = Layout(f"{shared_folder(spark)}/detail_{run_name()}")
    names = ["itens_venda", "vendas", "produtos", "vendedores"]
    for until in (SINCE, None):
        _done(extract_all(spark, FrameSource(tables), layout, names, until=until))
        _done(ingest_all(spark, layout, names))
    stored = {name: read_master(spark, layout, TABLES[name]) for name in names}
    detail = reports.item_detail(
        stored["itens_venda"], stored["produtos"], stored["vendas"], stored["vendedores"]
    )
    return _plain(detail)


def _dq_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entities checked and written in one pass, then both parts read again."""
    customers = TpchShop(spark, sf_dir).table("customer")
    entities = spark.sql(_ENTITY.replace("FROM customer", "FROM {customers}"), customers=customers)
    path = f"{shared_folder(spark)}/checked_{run_name()}"
    store_checked(entities, entity_rules("clientes"), path)
    failed = F.concat_ws(",", "failed_rules").alias("failed_rules")
    valid = read_checked(spark, path, True).select("id_cliente", F.lit("").alias("failed_rules"))
    return valid.unionByName(read_checked(spark, path, False).select("id_cliente", failed))


# Events and pricing


def _event_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids beyond four bytes; some ids and amounts made unreadable, and counted by reason."""
    records = TpchShop(spark, sf_dir).table("events").selectExpr(
        """concat('{"id_venda":', if(event_id % 97 = 0, '"x"', string(event_id + 3000000000)),
                  ',"valor_total":', case when event_id % 53 = 0 then '"NaN"'
                                          when event_id % 59 = 0 then '1e20'
                                          else string(value * 1000000) end, '}') AS value""",
        "ts AS timestamp",
    )
    rejected = quarantined_events(records)
    return rejected.groupBy("motivo").agg(F.count("*").alias("qtd"))


def _speed_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Speed rows with ids beyond four bytes and amounts beyond ten digits."""
    events = TpchShop(spark, sf_dir).events
    wide = events.withColumns(
        {
            "id_venda": F.col("id_venda") + 3_000_000_000,
            "valor_total": F.col("valor_total").cast("decimal(10,2)") * 10_000_000,
        }
    )
    return _plain(_flat_window(speed_view(newer_than(wide, None), DAILY_REVENUE)))


def _event_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = TpchShop(spark, sf_dir).table("events").select(
        F.col("props").alias("value"), F.col("ts").alias("timestamp")
    )
    return decode_events(records, PROPS_SCHEMA)


def _event_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every sale line to JSON and back; the decoded fields are what is compared."""
    shop = TpchShop(spark, sf_dir)
    seller = shop.sales_with_seller
    return _plain(decode_events(encode_events(seller, shop.lines)))


def _line_pricing(spark: SparkSession, sf_dir: str) -> DataFrame:
    shop = TpchShop(spark, sf_dir)
    lines = shop.lines.select("id_venda", "id_produto", "quantidade", "percentual_desconto")
    return _plain(price_lines(lines, shop.products))


# Quality


def _dq_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(split_valid(TpchShop(spark, sf_dir).customers, CUSTOMER_RULES)[0])


def _dq_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejected = split_valid(TpchShop(spark, sf_dir).customers, CUSTOMER_RULES)[1]
    return _plain(rejected.withColumn("failed_rules", F.concat_ws(",", "failed_rules")))


#: Entities made from the customer table, in SQL that both sides understand; some break a rule.
_ENTITY = """
    SELECT c_custkey AS id_cliente,
           concat(substr(lpad(CAST(c_custkey AS STRING), 9, '0'), 1, 3), '.',
                  substr(lpad(CAST(c_custkey AS STRING), 9, '0'), 4, 3), '.',
                  substr(lpad(CAST(c_custkey AS STRING), 9, '0'), 7, 3), '-0',
                  CAST(c_custkey % 10 AS STRING),
                  CASE WHEN c_custkey % 7 = 0 THEN chr(10) ELSE '' END) AS cpf,
           concat('(1', CAST(c_custkey % 11 AS STRING), ') 9', lpad(CAST(c_custkey % 10000 AS STRING), 4, '0'),
                  '-1234') AS telefone,
           concat('c', CAST(c_custkey AS STRING), CASE WHEN c_custkey % 13 = 0 THEN '@' ELSE '@loja.com' END) AS email,
           concat('Cliente ', CASE WHEN c_custkey % 17 = 0 THEN 'X' ELSE 'Número' END) AS cliente,
           CASE WHEN c_custkey % 19 = 0 THEN 'São Paulo' ELSE 'sp' END AS estado,
           CASE c_custkey % 6 WHEN 0 THEN 'INDÍGENA' WHEN 1 THEN 'Branca' WHEN 2 THEN 'preta'
                WHEN 3 THEN 'parda' WHEN 4 THEN 'amarela' ELSE 'outra' END AS origem_racial,
           CASE WHEN c_custkey % 23 = 0 THEN NULL WHEN c_custkey % 2 = 0 THEN 'm' ELSE 'F' END AS sexo,
           CASE c_custkey % 4 WHEN 0 THEN 'Silver' WHEN 1 THEN 'gold' WHEN 2 THEN 'Platinum'
                ELSE 'Goldish' END AS status
    FROM customer"""


def _dq_entity(valid: bool) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        customers = TpchShop(spark, sf_dir).table("customer")
        entities = spark.sql(_ENTITY.replace("FROM customer", "FROM {customers}"), customers=customers)
        rows = split_valid(entities, entity_rules("clientes"))[0 if valid else 1]
        return rows if valid else rows.withColumn("failed_rules", F.concat_ws(",", "failed_rules"))

    return query


def _insert_if_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One brand is the stored catalogue; the products of all others arrive."""
    parts = (
        TpchShop(spark, sf_dir)
        .table("part")
        .select(
            F.col("p_partkey").alias("id_produto"),
            F.concat_ws(" ", "p_name", "p_type", "p_size").alias("produto"),
            "p_brand",
        )
    )
    stored = F.col("p_brand") == "Brand#1"
    return insert_if_absent(parts.where(~stored), parts.where(stored), "produto", ["id_produto"])


def _dq_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    shop = TpchShop(spark, sf_dir)
    return referential_report(
        shop.sales_with_seller, shop.lines, shop.products, shop.customers, shop.sellers
    )


def _dq_orphan_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales without any line."""
    shop = TpchShop(spark, sf_dir)
    return _plain(orphans(shop.sales, shop.lines, "id_venda"))


def _dq_duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicate_keys(TpchShop(spark, sf_dir).lines, TABLES["itens_venda"].key)


_SHORT = {
    DAILY_REVENUE.name: "daily_revenue",
    CUSTOMER_TICKET.name: "customer_ticket",
    SELLER_SALES.name: "seller_sales",
}


def _training_data() -> tuple[dict[str, Query], dict[str, str]]:
    """Queries and SQL of the subpackage ``llm`` and its pipeline, if they are there."""
    try:
        import corpus_pipeline
        from vendaval.llm.queries import ORACLE_SQL, QUERIES
    except ModuleNotFoundError as error:
        if error.name not in ("corpus_pipeline", "vendaval.llm", "vendaval.llm.queries"):
            raise
        return {}, {}
    sql = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
    return QUERIES | {"pipeline": corpus_pipeline.run}, ORACLE_SQL | sql


def queries() -> dict[str, Query]:
    return _shop_queries() | _training_data()[0]


def _shop_queries() -> dict[str, Query]:
    layers: dict[str, Query] = {}
    for view in VIEWS.values():
        short = _SHORT[view.name]
        layers[f"batch_{short}"] = _batch(view)
        layers[f"speed_{short}"] = _speed(view)
        layers[f"stream_{short}"] = _stream(view)
        layers[f"gold_{short}"] = _gold(view)
        layers[f"gold_{short}_exact"] = _gold_exact(view)
        layers[f"job_batch_{short}"] = _job_batch(view)
        layers[f"job_gold_{short}"] = _job_gold(view, exact=False)
        layers[f"job_gold_{short}_exact"] = _job_gold(view, exact=True)
    return layers | {
        "gold_straddling_windows": _straddling,
        "top1_cutoff": _top1_cutoff,
        "view_since": _view_since,
        "sales_in_ranges": _sales_in_ranges,
        "v_customer_profile": _customer_profile,
        "v_daily_revenue": _daily_revenue,
        "v_item_detail": _item_detail,
        "v_customer_ticket": _customer_ticket,
        "v_product_sales": _product_sales,
        "v_seller_sales": _seller_sales,
        "delta_append_only": _delta_append_only,
        "delta_mutable": _delta_mutable,
        "delta_profile": _delta_profile,
        "watermark_max": _watermark_max,
        "row_version": _row_version,
        "manifest_latest": _manifest_latest,
        "manifest_pending": _manifest_pending,
        "retention_keep": _retention_keep,
        "retention_expired": _retention_expired,
        "ingest_delta": _ingest_delta,
        "ingest_master_mutable": _ingest_master_mutable,
        "ingest_lines_unique": _ingest_lines_unique,
        "event_quarantine": _event_quarantine,
        "speed_wide_amounts": _speed_wide,
        "stream_all_windows": _stream_all_windows,
        "job_item_detail": _job_item_detail,
        "dq_stored": _dq_stored,
        "dq_entity_valid": _dq_entity(True),
        "dq_entity_quarantine": _dq_entity(False),
        "ingest_master": _ingest_master,
        "ingest_append_missing": _ingest_append_missing,
        "ingest_upsert": _ingest_upsert(upsert),
        "ingest_upsert_small_delta": _ingest_upsert(upsert_small_delta),
        "event_decode": _event_decode,
        "event_encode": _event_encode,
        "line_pricing": _line_pricing,
        "dq_valid": _dq_valid,
        "dq_quarantine": _dq_quarantine,
        "insert_if_absent": _insert_if_absent,
        "dq_orphans": _dq_orphans,
        "dq_orphan_rows": _dq_orphan_rows,
        "dq_duplicate_keys": _dq_duplicate_keys,
    }


def entry(spark: SparkSession) -> DataFrame:
    """Flagship query: the daily revenue gold view, exact to the cent."""
    return queries()["gold_daily_revenue_exact"](spark, "/root/testdata/sf0.001")


# --- checking SQL ---------------------------------------------------------------------


def _cents(column: str) -> str:
    return f"CAST(round({column} * 100) AS HUGEINT)"


def _money(cents: str) -> str:
    return f"(CAST({cents} AS DOUBLE) / 100)"


def _micros(cents: str, count: str) -> str:
    """Mean in millionths, rounded half up, of a sum in cents."""
    return f"((2 * ({cents}) * 10000 + {count}) // (2 * {count}))"


def _mean(cents: str, count: str) -> str:
    """Mean in cents: first rounded to millionths, then to cents, both half up."""
    return _money(f"({_micros(cents, count)} + 5000) // 10000")


def _key_sql(view: ViewSpec, column: str) -> str:
    return f"sha256(CAST({column} AS VARCHAR))" if view.hashed else column


def _batch_sql(view: ViewSpec) -> str:
    table, sale, amount, key = {
        DAILY_REVENUE.name: ("orders", "o_orderkey", "o_totalprice", "CAST(o_orderdate AS DATE)"),
        CUSTOMER_TICKET.name: ("orders", "o_orderkey", "o_totalprice", "o_custkey"),
        SELLER_SALES.name: ("lineitem", "l_orderkey", "l_extendedprice", "l_suppkey"),
    }[view.name]
    return f"""
        WITH g AS (
            SELECT {key} AS k, max({sale}) AS maior_id, count({sale}) AS qtd_vendas,
                   sum({_cents(amount)}) AS c
            FROM {table} GROUP BY 1)
        SELECT {_key_sql(view, "k")} AS {view.key}, maior_id, qtd_vendas,
               {_money("c")} AS {view.total}, {_mean("c", "qtd_vendas")} AS ticket_medio
        FROM g"""


_EVENT_KEY = {
    DAILY_REVENUE.name: "CAST(ts AS DATE)",
    CUSTOMER_TICKET.name: "user_id",
    SELLER_SALES.name: "event_type",
}
_AFTER_START = "event_id > (SELECT max(event_id) * 2 // 5 FROM events)"
_IN_BATCH = "event_id <= (SELECT max(event_id) * 3 // 5 FROM events)"


def _window_groups(view: ViewSpec, condition: str, window: str = WINDOW) -> str:
    return f"""
            SELECT time_bucket(INTERVAL '{window}', ts) AS window_start,
                   {_EVENT_KEY[view.name]} AS k, max(event_id) AS maior_id,
                   min(event_id) AS menor_id, count(event_id) AS qtd_vendas,
                   sum({_cents("value")}) AS c
            FROM events WHERE {condition} GROUP BY 1, 2"""


def _window_columns(view: ViewSpec, window: str = WINDOW) -> str:
    return f"""window_start, window_start + INTERVAL '{window}' AS window_end,
               {_key_sql(view, "k")} AS {view.key}, maior_id, menor_id, qtd_vendas,
               {_money("c")} AS {view.total}, {_mean("c", "qtd_vendas")} AS ticket_medio"""


def _speed_sql(view: ViewSpec) -> str:
    return f"""
        WITH g AS ({_window_groups(view, _AFTER_START)})
        SELECT {_window_columns(view)} FROM g"""


def _stream_sql(view: ViewSpec) -> str:
    return f"""
        WITH g AS ({_window_groups(view, "event_id IS NOT NULL")})
        SELECT {_window_columns(view)} FROM g
        WHERE window_start + INTERVAL '10 seconds'
              <= (SELECT date_trunc('milliseconds', max(ts)) - INTERVAL '10 seconds' FROM events)"""


def _all_windows_sql() -> str:
    parts = [
        f"""
        SELECT '{view.name}' AS visao, window_start,
               window_start + INTERVAL '{WINDOW}' AS window_end,
               CAST({_key_sql(view, "k")} AS VARCHAR) AS chave, maior_id, menor_id, qtd_vendas,
               {_money("c")} AS total, {_mean("c", "qtd_vendas")} AS ticket_medio
        FROM ({_window_groups(view, "event_id IS NOT NULL")})"""
        for view in VIEWS.values()
    ]
    return " UNION ALL ".join(parts)


def _job_item_detail_sql() -> str:
    return f"""
        SELECT id_venda, id_produto, p_name AS produto, id_vendedor, s_name AS nome_vendedor,
               quantidade, valor_unitario, valor_total, desconto
        FROM ({_unique_lines_sql()}) JOIN part ON p_partkey = id_produto
        JOIN orders ON o_orderkey = id_venda JOIN {_SELLER} ON k = id_venda
        JOIN supplier ON s_suppkey = id_vendedor"""


def _unique_lines_sql() -> str:
    return f"""
            SELECT id_produto, id_venda, quantidade, {_money("u")} AS valor_unitario, valor_total,
                   {_money("d")} AS desconto, criacao
            FROM (SELECT *, row_number() OVER (
                      PARTITION BY id_produto, id_venda
                      ORDER BY criacao, quantidade, u, valor_total, d) AS n
                  FROM (SELECT l_partkey AS id_produto, l_orderkey AS id_venda,
                               CAST(l_quantity AS INTEGER) AS quantidade, {_UNIT_CENTS} AS u,
                               l_extendedprice AS valor_total, {_DISCOUNT_CENTS} AS d,
                               l_shipdate AS criacao
                        FROM lineitem))
            WHERE n = 1"""


def _batch_and_speed(view: ViewSpec, window: str = WINDOW) -> str:
    mean = f"({_micros('c', 'qtd_vendas')} + 5000) // 10000"
    return f"""
        b AS (
            SELECT k, maior_id, qtd_vendas, c, {mean} AS m FROM (
                SELECT {_EVENT_KEY[view.name]} AS k, max(event_id) AS maior_id,
                       count(event_id) AS qtd_vendas, sum({_cents("value")}) AS c
                FROM events WHERE {_IN_BATCH} GROUP BY 1)),
        s AS (
            SELECT *, {mean} AS m FROM ({_window_groups(view, _AFTER_START, window)}))"""


def _gold_sql(view: ViewSpec) -> str:
    return f"""
        WITH {_batch_and_speed(view)},
        u AS (
            SELECT k, qtd_vendas, c, m FROM b
            UNION ALL
            SELECT k, qtd_vendas, c, m FROM s
            WHERE maior_id > (SELECT max(maior_id) FROM b)),
        g AS (SELECT k, sum(qtd_vendas) AS q, sum(c) AS c, sum(m) AS m, count(*) AS n
              FROM u GROUP BY 1)
        SELECT {_key_sql(view, "k")} AS {view.key}, CAST(q AS BIGINT) AS qtd_vendas,
               CAST(c // 100 AS BIGINT) AS {view.total}, {_mean("m", "n")} AS ticket_medio
        FROM g"""


def _job_batch_sql(view: ViewSpec) -> str:
    if view is not SELLER_SALES:
        return _batch_sql(view)
    sellers = "(SELECT l_orderkey AS s, min(l_suppkey) AS l_suppkey FROM lineitem GROUP BY 1)"
    sql = _batch_sql(view).replace("l_orderkey", "o_orderkey").replace("l_extendedprice", "o_totalprice")
    return sql.replace("FROM lineitem", f"FROM orders LEFT JOIN {sellers} ON s = o_orderkey")


def _job_gold_sql(view: ViewSpec) -> str:
    in_batch = f"ts <= (SELECT max(ts) FROM events WHERE {_IN_BATCH})"
    newer = "WHERE maior_id > (SELECT max(maior_id) FROM b)"
    closed = "(SELECT date_trunc('milliseconds', max(ts)) - INTERVAL '10 seconds' FROM events)"
    sql = _gold_sql(view).replace(_IN_BATCH, in_batch).replace("event_type", "user_id % 50")
    return sql.replace(newer, f"{newer} AND window_start + INTERVAL '10 seconds' <= {closed}")


def _entity_sql(condition: str, *columns: str) -> str:
    tests = [
        f"CASE WHEN NOT coalesce(regexp_matches({c}, '{p.replace('(?iu)', '(?i)')}'), false) THEN '{c}' END"
        for c, p in entity_rules("clientes").items()
    ]
    failed = f"concat_ws(',', {', '.join(tests)})"
    return f"SELECT * {' '.join(columns)} FROM (SELECT *, {failed} AS failed_rules FROM ({_ENTITY})) WHERE {condition}"


def _gold_exact_sql(view: ViewSpec) -> str:
    return f"""
        WITH g AS (
            SELECT {_EVENT_KEY[view.name]} AS k, count(event_id) AS qtd_vendas,
                   sum({_cents("value")}) AS c
            FROM events GROUP BY 1)
        SELECT {_key_sql(view, "k")} AS {view.key}, qtd_vendas,
               {_money("c")} AS {view.total}, {_mean("c", "qtd_vendas")} AS ticket_medio
        FROM g"""


_SALES = """
    SELECT o_orderkey AS id_venda, o_custkey AS id_cliente, CAST(o_orderdate AS DATE) AS data,
           o_totalprice AS total, o_orderdate AS criacao FROM orders"""

_VERSIONS = """
    SELECT o_orderkey AS id_venda, o_totalprice AS total, o_orderdate AS criacao,
           CASE WHEN shipped > o_orderdate THEN shipped END AS atualizacao
    FROM orders LEFT JOIN (
        SELECT l_orderkey, max(l_shipdate) AS shipped FROM lineitem GROUP BY 1)
    ON l_orderkey = o_orderkey"""

_CHANGED = f"criacao > TIMESTAMP '{SINCE}' OR atualizacao > TIMESTAMP '{SINCE}'"

_MANIFEST = """
    SELECT 'vendas' AS "table", CAST(max(o_orderdate) AS VARCHAR) AS date,
           'snapshots/vendas/' || strftime(o_orderdate, '%Y-%m') AS path
    FROM orders GROUP BY strftime(o_orderdate, '%Y-%m')
    UNION ALL
    SELECT 'itens_venda', CAST(max(l_shipdate) AS VARCHAR),
           'snapshots/itens_venda/' || strftime(l_shipdate, '%Y-%m')
    FROM lineitem GROUP BY strftime(l_shipdate, '%Y-%m')"""

_TOTAL_CENTS = _cents("l_extendedprice")
_QTY = "CAST(l_quantity AS HUGEINT)"
_UNIT_CENTS = f"((2 * {_TOTAL_CENTS} + {_QTY}) // (2 * {_QTY}))"
_PERCENT = "CAST(round(l_discount * 100) AS HUGEINT)"
_DISCOUNT_CENTS = f"(({_TOTAL_CENTS} * {_PERCENT} + 50) // 100)"

_SELLER = "(SELECT l_orderkey AS k, min(l_suppkey) AS id_vendedor FROM lineitem GROUP BY 1)"

_STORED_SALES = f"""
    SELECT CAST(id_venda AS INTEGER) AS id_venda, CAST(id_vendedor AS INTEGER) AS id_vendedor,
           CAST(id_cliente AS INTEGER) AS id_cliente, data, total, criacao
    FROM ({_SALES}) LEFT JOIN {_SELLER} ON k = id_venda"""

_CUSTOMERS = """
    SELECT c_custkey AS id_cliente, c_name AS cliente, n_name AS estado,
           substr(c_mktsegment, 1, 1) AS sexo, r_name AS origem_racial, c_mktsegment AS status,
           c_acctbal AS saldo
    FROM customer JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey"""


def _failed_rules() -> str:
    text = {"saldo": "CAST(CAST(saldo AS DECIMAL(10, 2)) AS VARCHAR)"}
    tests = [
        f"CASE WHEN NOT regexp_matches({text.get(c, c)}, '{p}') THEN '{c}' END"
        for c, p in CUSTOMER_RULES.items()
    ]
    return f"concat_ws(',', {', '.join(tests)})"


def _upsert_sql() -> str:
    return """
        WITH versions AS (
            SELECT o_orderkey AS id_venda, o_totalprice AS total, o_orderdate AS criacao,
                   CAST(NULL AS TIMESTAMP) AS atualizacao, 0 AS source FROM orders
            UNION ALL
            SELECT l_orderkey, l_extendedprice, l_shipdate, l_shipdate, 1 FROM lineitem),
        ranked AS (
            SELECT id_venda, total, coalesce(atualizacao, criacao) AS versao,
                   row_number() OVER (
                       PARTITION BY id_venda
                       ORDER BY coalesce(atualizacao, criacao) DESC, source DESC, total DESC
                   ) AS position
            FROM versions)
        SELECT id_venda, total, versao FROM ranked WHERE position = 1"""


def _orphans_sql() -> str:
    def check(name: str, child: str, key: str, parent: str, parent_key: str) -> str:
        return f"""
            SELECT '{name}' AS regra, {key} AS chave, count(*) AS linhas FROM {child} c
            WHERE {key} IS NOT NULL AND NOT EXISTS (
                SELECT 1 FROM {parent} p WHERE p.{parent_key} = c.{key})
            GROUP BY 2"""

    return " UNION ALL ".join(
        [
            check("vendas.id_vendedor", _SELLER, "id_vendedor", "supplier", "s_suppkey"),
            check("vendas.id_cliente", "orders", "o_custkey", "customer", "c_custkey"),
            check("itens_venda.id_produto", "lineitem", "l_partkey", "part", "p_partkey"),
            check("itens_venda.id_venda", "lineitem", "l_orderkey", "orders", "o_orderkey"),
            check("vendas sem itens_venda", "orders", "o_orderkey", "lineitem", "l_orderkey"),
        ]
    )


def oracle_sql() -> dict[str, str]:
    return _shop_sql() | _training_data()[1]


def _shop_sql() -> dict[str, str]:
    layers: dict[str, str] = {}
    for view in VIEWS.values():
        short = _SHORT[view.name]
        layers[f"batch_{short}"] = _batch_sql(view)
        layers[f"speed_{short}"] = _speed_sql(view)
        layers[f"stream_{short}"] = _stream_sql(view)
        layers[f"gold_{short}"] = _gold_sql(view)
        layers[f"gold_{short}_exact"] = _gold_exact_sql(view)
        layers[f"job_batch_{short}"] = _job_batch_sql(view)
        layers[f"job_gold_{short}"] = _job_gold_sql(view)
        layers[f"job_gold_{short}_exact"] = _gold_exact_sql(view).replace("event_type", "user_id % 50")

    daily = _batch_sql(DAILY_REVENUE)
    ranges = " OR ".join(
        f"(criacao > TIMESTAMP '{a} 00:00:00' AND criacao < TIMESTAMP '{b} 00:00:00')"
        for a, b in RANGES
    )
    moment = "CAST(date AS TIMESTAMP)"
    limit = f"CAST(DATE '{TODAY}' - INTERVAL '30 days' AS TIMESTAMP)"
    price = _cents("p_retailprice")
    return layers | {
        "gold_straddling_windows": f"""
            WITH {_batch_and_speed(CUSTOMER_TICKET, "1 day")}
            SELECT {_window_columns(CUSTOMER_TICKET, "1 day")} FROM s
            WHERE menor_id <= (SELECT max(maior_id) FROM b)
              AND maior_id > (SELECT max(maior_id) FROM b)""",
        "top1_cutoff": "SELECT max(o_orderkey) AS maior_id FROM orders",
        "view_since": f"SELECT * FROM ({daily}) WHERE data > DATE '2000-04-12'",
        "sales_in_ranges": f"SELECT * FROM ({_SALES}) WHERE {ranges}",
        "v_customer_profile": f"""
            SELECT id_cliente, cliente, estado, sexo, origem_racial, status,
                   CAST(year(criacao) AS INTEGER) AS ano_entrada
            FROM ({_CUSTOMERS}) LEFT JOIN (
                SELECT o_custkey, min(o_orderdate) AS criacao FROM orders GROUP BY 1)
            ON o_custkey = id_cliente""",
        "v_daily_revenue": f"""
            SELECT CAST(o_orderdate AS DATE) AS data, count(o_orderkey) AS qtd_vendas,
                   {_money(f"sum({_cents('o_totalprice')})")} AS total_faturado
            FROM orders GROUP BY 1""",
        "v_item_detail": f"""
            SELECT l_orderkey AS id_venda, l_partkey AS id_produto, p_name AS produto,
                   id_vendedor, s_name AS nome_vendedor,
                   CAST(l_quantity AS INTEGER) AS quantidade,
                   {_money(_UNIT_CENTS)} AS valor_unitario, l_extendedprice AS valor_total,
                   {_money(_DISCOUNT_CENTS)} AS desconto
            FROM lineitem JOIN part ON p_partkey = l_partkey
            JOIN orders ON o_orderkey = l_orderkey
            JOIN {_SELLER} ON k = o_orderkey
            JOIN supplier ON s_suppkey = id_vendedor""",
        "v_customer_ticket": f"""
            WITH g AS (
                SELECT c_custkey, c_name, count(o_orderkey) AS n,
                       sum({_cents("o_totalprice")}) AS c
                FROM customer JOIN orders ON o_custkey = c_custkey GROUP BY 1, 2)
            SELECT c_custkey AS id_cliente, c_name AS cliente, n AS num_vendas,
                   {_money("c")} AS total_gasto,
                   CAST({_micros("c", "n")} AS DOUBLE) / 1000000 AS ticket_medio
            FROM g""",
        "v_product_sales": f"""
            SELECT p_partkey AS id_produto, p_name AS produto,
                   CAST(sum({_QTY}) AS BIGINT) AS total_quantidade,
                   {_money(f"sum({_UNIT_CENTS} * {_QTY})")} AS total_bruto,
                   {_money(f"sum({_DISCOUNT_CENTS})")} AS total_desconto,
                   {_money(f"sum({_TOTAL_CENTS})")} AS total_liquido
            FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1, 2""",
        "v_seller_sales": f"""
            SELECT l_suppkey AS id_vendedor, s_name AS nome, count(l_orderkey) AS total_vendas,
                   {_money(f"sum({_TOTAL_CENTS})")} AS total_faturado
            FROM lineitem JOIN supplier ON s_suppkey = l_suppkey GROUP BY 1, 2""",
        "delta_append_only": f"SELECT * FROM ({_SALES}) WHERE criacao > TIMESTAMP '{SINCE}'",
        "delta_mutable": f"""
            SELECT id_venda, total, criacao, coalesce(atualizacao, criacao) AS versao
            FROM ({_VERSIONS}) WHERE {_CHANGED}""",
        "delta_profile": f"""
            SELECT CAST(3 AS INTEGER) AS max_conn, min(id_venda) AS low_bound,
                   max(id_venda) AS upper_bound, count(*) AS qtd_linhas,
                   max(coalesce(atualizacao, criacao)) AS watermark
            FROM ({_VERSIONS}) WHERE {_CHANGED}""",
        "watermark_max": f"""
            SELECT 'vendas' AS tabela, max(o_orderdate) AS watermark FROM orders
            UNION ALL SELECT 'itens_venda', max(l_shipdate) FROM lineitem
            UNION ALL SELECT 'versoes', max(coalesce(atualizacao, criacao))
            FROM ({_VERSIONS})""",
        "row_version": f"""
            SELECT id_venda, coalesce(atualizacao, criacao) AS versao FROM ({_VERSIONS})""",
        "manifest_latest": f"""
            SELECT "table", max({moment}) AS date FROM ({_MANIFEST}) GROUP BY 1""",
        "manifest_pending": f"""
            SELECT * FROM ({_MANIFEST})
            WHERE "table" = 'vendas' AND split_part(path, '/', -1) > '{SINCE[:7]}'""",
        "retention_keep": f"SELECT * FROM ({_MANIFEST}) WHERE {moment} > {limit}",
        "retention_expired": f"SELECT * FROM ({_MANIFEST}) WHERE {moment} <= {limit}",
        "ingest_delta": _STORED_SALES,
        "ingest_master_mutable": f"""
            SELECT p_partkey AS id_produto, p_name AS produto,
                   p_retailprice + CASE WHEN p_partkey % 3 = 0 THEN 1 ELSE 0 END AS preco,
                   TIMESTAMP '1995-01-01 00:00:00' AS criacao,
                   CASE WHEN p_partkey % 3 = 0 THEN TIMESTAMP '{SINCE}' END AS atualizacao
            FROM part""",
        "ingest_lines_unique": _unique_lines_sql(),
        "event_quarantine": """
            SELECT CASE WHEN event_id % 97 = 0 THEN 'id_venda' ELSE 'valor_total' END AS motivo,
                   count(*) AS qtd
            FROM events WHERE event_id % 97 = 0 OR event_id % 53 = 0 OR event_id % 59 = 0
            GROUP BY 1""",
        "speed_wide_amounts": f"""
            SELECT time_bucket(INTERVAL '{WINDOW}', ts) AS window_start,
                   time_bucket(INTERVAL '{WINDOW}', ts) + INTERVAL '{WINDOW}' AS window_end,
                   CAST(ts AS DATE) AS data, max(event_id) + 3000000000 AS maior_id,
                   min(event_id) + 3000000000 AS menor_id, count(*) AS qtd_vendas,
                   {_money(f"sum({_cents('value')}) * 10000000")} AS total_faturado,
                   {_mean(f"(sum({_cents('value')}) * 10000000)", "count(*)")} AS ticket_medio
            FROM events GROUP BY 1, 2, 3""",
        "stream_all_windows": _all_windows_sql(),
        "job_item_detail": _job_item_detail_sql(),
        "dq_stored": f"""SELECT id_cliente, failed_rules FROM ({_entity_sql("true")})""",
        "dq_entity_valid": _entity_sql("failed_rules = ''", "EXCLUDE (failed_rules)"),
        "dq_entity_quarantine": _entity_sql("failed_rules <> ''"),
        "ingest_master": _STORED_SALES,
        "ingest_append_missing": f"""
            SELECT l_orderkey AS id_venda, l_partkey AS id_produto, l_suppkey AS id_vendedor,
                   CAST(l_quantity AS INTEGER) AS quantidade,
                   {_money(_UNIT_CENTS)} AS valor_unitario, l_extendedprice AS valor_total,
                   CAST({_PERCENT} AS INTEGER) AS percentual_desconto,
                   {_money(_DISCOUNT_CENTS)} AS desconto, l_shipdate AS criacao
            FROM lineitem l WHERE NOT EXISTS (
                SELECT 1 FROM lineitem s
                WHERE s.l_orderkey = l.l_orderkey AND s.l_partkey = l.l_partkey
                  AND s.l_shipdate <= TIMESTAMP '{SINCE}')""",
        "ingest_upsert": _upsert_sql(),
        "ingest_upsert_small_delta": _upsert_sql(),
        "event_decode": """
            SELECT CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, ts AS timestamp
            FROM events""",
        "event_encode": f"""
            SELECT CAST(id_vendedor AS BIGINT) AS id_vendedor,
                   CAST(o_custkey AS BIGINT) AS id_cliente,
                   CAST(l_partkey AS BIGINT) AS id_produto,
                   CAST(l_orderkey AS BIGINT) AS id_venda,
                   CAST(l_quantity AS INTEGER) AS quantidade,
                   {_money(_UNIT_CENTS)} AS valor_unitario, l_extendedprice AS valor_total,
                   {_money(_DISCOUNT_CENTS)} AS desconto, CAST(o_orderdate AS DATE) AS data,
                   o_orderdate AS timestamp
            FROM lineitem JOIN orders ON o_orderkey = l_orderkey
            JOIN {_SELLER} ON k = o_orderkey""",
        "line_pricing": f"""
            SELECT l_orderkey AS id_venda, l_partkey AS id_produto,
                   CAST(l_quantity AS INTEGER) AS quantidade,
                   CAST({_PERCENT} AS INTEGER) AS percentual_desconto,
                   p_retailprice AS valor_unitario,
                   {_money(f"{price} * {_QTY}")} AS valor_total,
                   {_money(f"({price} * {_QTY} * {_PERCENT} + 50) // 100")} AS desconto
            FROM lineitem JOIN part ON p_partkey = l_partkey""",
        "dq_valid": f"SELECT * FROM ({_CUSTOMERS}) WHERE {_failed_rules()} = ''",
        "dq_quarantine": f"""
            SELECT * FROM (SELECT *, {_failed_rules()} AS failed_rules FROM ({_CUSTOMERS}))
            WHERE failed_rules <> ''""",
        "insert_if_absent": """
            WITH parts AS (
                SELECT p_partkey AS id_produto,
                       concat_ws(' ', p_name, p_type, CAST(p_size AS VARCHAR)) AS produto, p_brand
                FROM part),
            arrivals AS (
                SELECT *, row_number() OVER (PARTITION BY produto ORDER BY id_produto) AS position
                FROM parts WHERE p_brand <> 'Brand#1')
            SELECT id_produto, produto, p_brand FROM arrivals a
            WHERE position = 1 AND NOT EXISTS (
                SELECT 1 FROM parts s WHERE s.p_brand = 'Brand#1' AND s.produto = a.produto)""",
        "dq_orphans": _orphans_sql(),
        "dq_orphan_rows": f"""
            SELECT * FROM ({_SALES}) WHERE NOT EXISTS (
                SELECT 1 FROM lineitem WHERE l_orderkey = id_venda)""",
        "dq_duplicate_keys": """
            SELECT l_partkey AS id_produto, l_orderkey AS id_venda, count(*) AS linhas
            FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""",
    }
