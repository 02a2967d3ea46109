"""Operator 12, target-distribution importance resampling with length-bucketed CRC matrices.

Hashed n-gram counts of all documents and of a target corpus give each bucket a log ratio; a
document's weight is the mean over its n-grams, and adding Gumbel noise to the weights turns
a top-k into a draw without replacement in proportion to them. The CRCs of a batch's
different n-grams are taken together: those of equal length stand in a two-dimensional array
of bytes, all CRCs advance by a column at a time, and the buckets go back to their places.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vendaval.llm.shared import keep
from vendaval.llm.words import byte_view, pieces, words


@dataclass(frozen=True)
class Draw:
    grams: int = 2  # features are runs of 1 to so many words
    buckets: int = 10_000
    least: int = 20  # words a document must have to be drawn
    percent: int = 25  # of those documents, drawn
    seed: int = 7


#: Texts are taken together up to so many bytes and rows.
_BYTES, _ROWS = 4 << 20, 4096
#: A group of longer features seldom has a second row; these CRCs are taken one by one.
_LONGEST = 64
_CELLS = 1 << 22
_SPACE = pa.scalar(b" ", pa.large_binary())


def _crc_table() -> np.ndarray:
    """One step of CRC-32 (reflected polynomial 0xEDB88320) for each byte."""
    step = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        step = (step >> np.uint32(1)) ^ np.where(step & 1, np.uint32(0xEDB88320), np.uint32(0))
    return step


_STEP = _crc_table()


def crc32_all(features: pa.Array) -> np.ndarray:
    """CRC-32 of each string or binary value, none of them null."""
    offsets, content = byte_view(features)
    lengths = np.diff(offsets)
    found = np.zeros(len(features), dtype=np.uint32)
    order = np.argsort(lengths, kind="stable")
    sizes, starts = np.unique(lengths[order], return_index=True)
    for size, rows in zip(sizes.tolist(), np.split(order, starts[1:])):
        if size > _LONGEST:
            for row in rows.tolist():
                found[row] = zlib.crc32(content[offsets[row] : offsets[row + 1]])
            continue
        part = max(_CELLS // max(size, 1), 1)
        for at in range(0, len(rows), part):
            own = rows[at : at + part]
            # A row of this array is a column of the group: the bytes at one position.
            matrix = content[np.arange(size)[:, None] + offsets[own][None, :]]
            crc = np.full(len(own), 0xFFFFFFFF, dtype=np.uint32)
            for column in matrix:
                crc = _STEP[(crc ^ column) & np.uint32(0xFF)] ^ (crc >> np.uint32(8))
            found[own] = ~crc
    return found


def feature_buckets(texts: pa.Array, draw: Draw) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(buckets, owners, words): a bucket per feature with its text's number; words per text."""
    known, codes, ends = words(texts)
    n_words = np.diff(ends)
    owner = np.repeat(np.arange(len(texts)), n_words)
    # ``runs`` numbers the run of the present length from each word on; -1: it leaves its text.
    runs, different = codes, known
    buckets, owners = [], []
    for length in range(1, draw.grams + 1):
        hashed = (crc32_all(different) % np.uint32(draw.buckets)).astype(np.int64)
        starts = np.flatnonzero(runs >= 0)
        buckets.append(hashed[runs[starts]])
        owners.append(owner[starts])
        if length == draw.grams:
            break
        head, tail = runs[:-1], codes[length:]
        whole = (head >= 0) & (owner[: len(head)] == owner[length:])
        pairs, numbers = np.unique(head[whole] * len(known) + tail[whole], return_inverse=True)
        first, last = np.divmod(pairs, max(len(known), 1))
        different = pc.binary_join_element_wise(different.take(pa.array(first)), known.take(pa.array(last)), _SPACE)
        runs = np.full(len(head), -1, dtype=np.int64)
        runs[whole] = numbers
    return np.concatenate(buckets), np.concatenate(owners), n_words


def bucket_counts(rows: DataFrame, draw: Draw) -> DataFrame:
    """(bucket, n): features of all texts by bucket; a task sends at most a row per bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(draw.buckets, dtype=np.int64)
        for part in pieces(batches, "text", _BYTES, _ROWS):
            found = feature_buckets(part.column("text").combine_chunks(), draw)[0]
            total += np.bincount(found, minlength=draw.buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["bucket", "n"])

    counted = rows.select("text").mapInArrow(count, "bucket long, n long")
    return counted.groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(documents: DataFrame, target: DataFrame, draw: Draw) -> np.ndarray:
    """Thousandfold log ratio of target to documents for each bucket, floored."""
    raw = bucket_counts(documents, draw).withColumnRenamed("n", "s")
    aim = bucket_counts(target, draw).withColumnRenamed("n", "t")
    every = documents.sparkSession.range(draw.buckets).withColumnRenamed("id", "bucket")
    counts = every.join(raw, "bucket", "left").join(aim, "bucket", "left").na.fill(0, ["s", "t"])
    # One row per bucket, so their number bounds what reaches the driver.
    held = counts.select("bucket", "s", "t").toArrow().sort_by("bucket")
    s, t = held.column("s").to_numpy().astype(np.float64), held.column("t").to_numpy().astype(np.float64)
    ratio = (t + 1) * (s.sum() + draw.buckets) / ((s + 1) * (t.sum() + draw.buckets))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def _weigh(texts: pa.Array, gains: np.ndarray, draw: Draw) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    buckets, owners, n_words = feature_buckets(texts, draw)
    n_features = np.bincount(owners, minlength=len(texts))
    # Sums of whole numbers stay exact in doubles up to 2^53.
    total = np.bincount(owners, gains[buckets], len(texts)).astype(np.int64)
    return n_words.astype(np.int64), n_features, total // np.maximum(n_features, 1)


def weights(gains: np.ndarray, draw: Draw) -> Column:
    """(n_words, n_features, weight) of a column ``text``, computed in Arrow batches."""

    def weigh(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            rows = pa.RecordBatch.from_arrays([texts], ["text"])
            parts = pieces(iter([rows]), "text", _BYTES, _ROWS)
            found = [_weigh(part.column("text").combine_chunks(), gains, draw) for part in parts]
            columns = [pa.array(np.concatenate(c)) for c in zip(*found)] or [pa.array([], pa.int64())] * 3
            yield pa.StructArray.from_arrays(columns, ["n_words", "n_features", "weight"])

    return F.arrow_udf(weigh, "n_words long, n_features long, weight long")(F.col("text"))


def noise(doc_id: Column, seed: int) -> Column:
    """Thousandfold Gumbel noise of an id, floored: the same for the same id and seed."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    drawn = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.log(-F.log((drawn + 0.5) / 4294967296.0)))


def importance(documents: DataFrame, target: DataFrame, draw: Draw = Draw()) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank) of each row of ``documents``.

    ``documents`` has (doc_id, text), ``target`` (text); other columns are not read. Ranks
    count from 1 in the order of falling scores, of equal ones the smaller doc_id first and
    no id last; who is not drawn has none. Null and empty texts have no features and weight
    0, and count for nothing. Repeated rows are documents of their own: they share their
    score and follow each other in rank. Texts are read whole. An empty table gives no rows.

    Two passes over the texts; between them only the counts of the buckets come together.
    Scores are put in order by ranges of (score, doc_id), so equal scores spread over
    partitions; a rank is the place in its range after the sizes of the ranges before it.
    """
    gains = bucket_gains(documents, target, draw)
    found = documents.select("doc_id", weights(gains, draw).alias("w")).select("doc_id", "w.*")
    scored = found.withColumn("score", F.col("weight") + noise(F.col("doc_id"), draw.seed))
    scored = keep(scored, "weights")

    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("n_features"), F.asc("n_words")]
    enough = F.col("n_words") >= draw.least
    ranged = scored.where(enough).repartitionByRange(*order).sortWithinPartitions(*order)
    # The number of the partition, and 33 bits for the place in it.
    ranged = keep(ranged.withColumn("place", F.monotonically_increasing_id()), "ranges")
    number = F.shiftright("place", 33)
    sizes = ranged.groupBy(number.alias("range")).agg(F.count("*").alias("n"))
    # One row per range.
    earlier = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    starts = sizes.select(
        "range",
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start"),
        F.floor(draw.percent * F.sum("n").over(whole) / 100).alias("drawn"),
    )
    place = F.col("start") + F.col("place").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    ranked = ranged.withColumn("range", number).join(starts, "range")
    ranked = ranked.withColumn("rank", F.when(place <= F.col("drawn"), place))
    rest = scored.where(~enough).withColumn("rank", F.lit(None).cast("long"))
    columns = ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    return ranked.select(columns).unionByName(rest.select(columns))


def resampled(documents: DataFrame, target: DataFrame, draw: Draw = Draw()) -> DataFrame:
    """The drawn rows of ``documents`` with all their columns, whatever their names.

    Of rows alike in id, weight and lengths so many are kept as were drawn; which of them, the
    text decides.
    """
    names = documents.columns
    key = ["doc_id", "n_words", "n_features", "weight"]
    chosen = importance(documents, target, draw).where("rank is not null")
    counts = keep(chosen.groupBy(*key).agg(F.count("*").alias("copies")), "drawn")
    gains = bucket_gains(documents, target, draw)
    rows = documents.select("doc_id", F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), weights(gains, draw).alias("w"))
    rows = rows.select("doc_id", "row", "w.*").alias("r")
    alike = F.lit(True)
    for c in key:
        alike &= F.col(f"r.{c}").eqNullSafe(F.col(f"c.{c}"))
    joined = rows.join(counts.alias("c"), alike).select("r.*", "c.copies")
    nth = F.row_number().over(Window.partitionBy(*key).orderBy(F.xxhash64("row.text"), "row.text"))
    return joined.withColumn("nth", nth).where("nth <= copies").select("row.*")


def importance_report(documents: DataFrame, target: DataFrame, draw: Draw = Draw()) -> DataFrame:
    return importance(documents, target, draw).select("doc_id", "n_features", "weight", "score", "rank")
