"""Tables, events and views of the shop: one declaration each, used by every layer."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

from vendaval.functions import EVENT_TOTAL, MONEY, TOTAL

BASE_WATERMARK = "1000-01-01 00:00:00"
"""Watermark of a table that was never extracted: before any row, so the first run takes all."""

OVERLAP_SECONDS = 1.0
"""How far behind the last watermark a run reads again: the database's times are whole seconds."""

RETENTION_DAYS = 30

WINDOW = "10 seconds"
WATERMARK_DELAY = "10 seconds"


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


_INT, _LONG, _STR, _TS, _DATE, _DBL = (
    T.IntegerType(),
    T.LongType(),
    T.StringType(),
    T.TimestampType(),
    T.DateType(),
    T.DoubleType(),
)


@dataclass(frozen=True)
class TableSpec:
    """An operational table.

    ``mutable`` tables also carry ``atualizacao`` and are extracted again when a row
    changes; the others only ever grow. ``split_column`` is the numeric column that
    parallel reads are split on. ``parents`` are the tables whose rows its rows refer to.
    """

    name: str
    key: tuple[str, ...]
    split_column: str
    mutable: bool
    schema: T.StructType
    parents: tuple[str, ...] = ()

    @property
    def version_columns(self) -> tuple[str, ...]:
        return ("criacao", "atualizacao") if self.mutable else ("criacao",)


TABLES: dict[str, TableSpec] = {
    spec.name: spec
    for spec in (
        TableSpec(
            "vendedores",
            key=("id_vendedor",),
            split_column="id_vendedor",
            mutable=True,
            schema=_schema(
                ("id_vendedor", _LONG),
                ("cpf", _STR),
                ("telefone", _STR),
                ("email", _STR),
                ("origem_racial", _STR),
                ("nome", _STR),
                ("criacao", _TS),
                ("atualizacao", _TS),
            ),
        ),
        TableSpec(
            "vendas",
            key=("id_venda",),
            split_column="id_venda",
            mutable=False,
            schema=_schema(
                ("id_venda", _LONG),
                ("id_vendedor", _LONG),
                ("id_cliente", _LONG),
                ("data", _DATE),
                ("total", MONEY),
                ("criacao", _TS),
            ),
            parents=("clientes", "vendedores"),
        ),
        TableSpec(
            "produtos",
            key=("id_produto",),
            split_column="id_produto",
            mutable=True,
            schema=_schema(
                ("id_produto", _LONG),
                ("produto", _STR),
                ("preco", MONEY),
                ("criacao", _TS),
                ("atualizacao", _TS),
            ),
        ),
        TableSpec(
            "clientes",
            key=("id_cliente",),
            split_column="id_cliente",
            mutable=True,
            schema=_schema(
                ("id_cliente", _LONG),
                ("cpf", _STR),
                ("telefone", _STR),
                ("email", _STR),
                ("cliente", _STR),
                ("estado", _STR),
                ("origem_racial", _STR),
                ("sexo", _STR),
                ("status", _STR),
                ("criacao", _TS),
                ("atualizacao", _TS),
            ),
        ),
        TableSpec(
            "itens_venda",
            key=("id_produto", "id_venda"),
            split_column="id_venda",
            mutable=False,
            schema=_schema(
                ("id_produto", _LONG),
                ("id_venda", _LONG),
                ("quantidade", _INT),
                ("valor_unitario", MONEY),
                ("valor_total", MONEY),
                ("desconto", MONEY),
                ("criacao", _TS),
            ),
            parents=("vendas", "produtos"),
        ),
    )
}

SALE_EVENT_SCHEMA = _schema(
    ("id_vendedor", _LONG),
    ("id_cliente", _LONG),
    ("id_produto", _LONG),
    ("id_venda", _LONG),
    ("quantidade", _INT),
    ("valor_unitario", _DBL),
    ("valor_total", _DBL),
    ("desconto", _DBL),
    ("data", _DATE),
)

# `date` is the snapshot's own watermark and `since` the exclusive lower bound it was
# extracted with, so overlapping snapshots are found from the manifest alone.
MANIFEST_SCHEMA = _schema(
    ("table", _STR),
    ("date", _TS),
    ("path", _STR),
    ("since", _TS),
)

EVENT_STORE_SCHEMA = T.StructType(
    [*SALE_EVENT_SCHEMA.fields, *_schema(("timestamp", _TS), ("dia", _DATE)).fields]
)

REJECTED_SCHEMA = _schema(("value", _STR), ("timestamp", _TS), ("motivo", _STR), ("dia", _DATE))

# One row per streaming query: its last micro-batch, rows read and rows behind the watermark.
STREAM_COUNTS_SCHEMA = _schema(
    ("consulta", _STR),
    ("nome", _STR),
    ("micro", _LONG),
    ("lidas", _LONG),
    ("atrasadas", _LONG),
)

# One row per complete ingest of a table; ``name`` is that of the newest snapshot in it.
INGEST_SCHEMA = _schema(
    ("name", _STR),
    ("mode", _STR),
    ("rows", _LONG),
)


@dataclass(frozen=True)
class ViewSpec:
    """A sales rollup that exists in the batch, speed and gold layers."""

    name: str
    source_key: str
    key: str
    total: str
    key_type: T.DataType

    @property
    def hashed(self) -> bool:
        return self.key != self.source_key

    @property
    def state_type(self) -> T.DataType:
        return T.LongType() if self.hashed else self.key_type

    @property
    def state_schema(self) -> T.StructType:
        return _schema(
            ("_key", self.state_type),
            ("maior_id", T.LongType()),
            ("qtd_vendas", T.LongType()),
            (self.total, TOTAL),
            ("_amounts", T.LongType()),
        )

    @property
    def batch_schema(self) -> T.StructType:
        return _schema(
            (self.key, self.key_type),
            ("maior_id", T.LongType()),
            ("qtd_vendas", T.LongType()),
            (self.total, TOTAL),
            ("ticket_medio", T.DecimalType(11, 2)),
        )

    @property
    def speed_schema(self) -> T.StructType:
        window = _schema(("start", _TS), ("end", _TS))
        fields = {f.name: f.dataType for f in self.batch_schema}
        return _schema(
            ("window", window),
            (self.key, self.key_type),
            ("maior_id", fields["maior_id"]),
            ("menor_id", fields["maior_id"]),
            ("qtd_vendas", fields["qtd_vendas"]),
            (self.total, EVENT_TOTAL),
            ("ticket_medio", T.DecimalType(21, 2)),
        )

    @property
    def gold_state_schema(self) -> T.StructType:
        return _schema(
            (self.key, self.key_type),
            ("qtd_vendas", T.LongType()),
            (self.total, T.DecimalType(38, 2)),
            ("_tickets", T.DecimalType(38, 2)),
            ("_means", T.LongType()),
        )


# Windows of all views in one store: the view, the text of its key, the day the window began.
WINDOW_SCHEMA = _schema(
    ("visao", _STR),
    ("window", _schema(("start", _TS), ("end", _TS))),
    ("chave", _STR),
    ("maior_id", _LONG),
    ("menor_id", _LONG),
    ("qtd_vendas", _LONG),
    ("total", EVENT_TOTAL),
    ("ticket_medio", T.DecimalType(21, 2)),
    ("dia", _DATE),
)


DAILY_REVENUE = ViewSpec("faturamento_diario", "data", "data", "total_faturado", _DATE)
CUSTOMER_TICKET = ViewSpec(
    "ticket_medio_cliente", "id_cliente", "hash_id_cliente", "total_gasto", _STR
)
SELLER_SALES = ViewSpec(
    "vendas_por_vendedor", "id_vendedor", "hash_id_vendedor", "total_vendido", _STR
)

VIEWS: dict[str, ViewSpec] = {v.name: v for v in (DAILY_REVENUE, CUSTOMER_TICKET, SELLER_SALES)}
