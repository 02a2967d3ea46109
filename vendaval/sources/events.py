"""Sale events as JSON records: encoding, decoding, and the stream they travel on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vendaval.functions import event_money
from vendaval.specs import SALE_EVENT_SCHEMA

TOPIC = "vendas-deshboard-bronze"  # fixed value: the topic producers and readers share

_RECORD_SCHEMA = T.StructType(
    [T.StructField("value", T.StringType()), T.StructField("timestamp", T.TimestampType())]
)


def decode_events(records: DataFrame, schema: T.StructType = SALE_EVENT_SCHEMA) -> DataFrame:
    """Typed columns from records of (value, timestamp).

    A malformed record, or a field of the wrong type, becomes null; rows without a sale id
    are then dropped by the cutoff filter.
    """
    text = records.selectExpr("CAST(value AS STRING) AS value", "timestamp")
    parsed = text.select(F.from_json("value", schema).alias("event"), "timestamp")
    return parsed.select("event.*", "timestamp")


def quarantined_events(
    records: DataFrame, schema: T.StructType = SALE_EVENT_SCHEMA, amount: str = "valor_total"
) -> DataFrame:
    """Records (value, timestamp) a view cannot use whole, with the reason in ``motivo``.

    Those without a readable id are in no view; those whose amount is no amount count as a
    sale but add nothing to the totals.
    """
    text = records.selectExpr("CAST(value AS STRING) AS value", "timestamp")
    event = F.from_json("value", schema)
    reason = F.when(F.col("event.id_venda").isNull(), F.lit("id_venda")).when(
        event_money(f"event.{amount}").isNull(), F.lit(amount)
    )
    judged = text.select("value", "timestamp", event.alias("event"))
    judged = judged.select("value", "timestamp", reason.alias("motivo"))
    return judged.where(F.col("motivo").isNotNull())


def encode_events(
    sales: DataFrame, lines: DataFrame, timestamp: str | None = "criacao"
) -> DataFrame:
    """One JSON record per sale line, with its sale's header fields.

    Both sides are joined on the sale id; a sale with very many lines is split by Spark's
    adaptive skew handling.
    """
    names = SALE_EVENT_SCHEMA.fieldNames()
    header = ["id_venda", "id_vendedor", "id_cliente", "data"]
    stamp = [F.col(timestamp).alias("timestamp")] if timestamp else []
    joined = lines.select(
        "id_venda", "id_produto", "quantidade", "valor_unitario", "valor_total", "desconto"
    ).join(sales.select(*header, *stamp), "id_venda")
    value = F.to_json(F.struct(*names)).alias("value")
    return joined.select(value, *(["timestamp"] if timestamp else []))


def read_kafka(
    spark: SparkSession,
    servers: str,
    topic: str = TOPIC,
    *,
    starting_offsets: str = "latest",
    max_offsets_per_trigger: int | None = None,
) -> DataFrame:
    """Stream of (value, timestamp); needs Spark's Kafka connector on the class path."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
    )
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    return reader.load().select("value", "timestamp")


def read_event_files(
    spark: SparkSession, path: str, *, max_files_per_trigger: int | None = None
) -> DataFrame:
    """The same stream from a directory of JSON files with ``value`` and ``timestamp``."""
    reader = spark.readStream.schema(_RECORD_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.json(path)


def publish_kafka(records: DataFrame, servers: str, topic: str = TOPIC) -> None:
    """Send encoded records, compressed and acknowledged by all replicas."""
    (
        records.select("value")
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .option("kafka.acks", "all")
        .option("kafka.compression.type", "gzip")
        .option("kafka.enable.idempotence", "true")
        .save()
    )
