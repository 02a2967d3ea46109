"""Operator 8, quality classifier: how much better a good dictionary compresses than a bad one.

Two zstandard dictionaries are trained, one on good and one on bad labelled text. A text is
compressed with each and with none; the normalised size difference, with the plain sizes
beside it, becomes a probability by logistic calibration on other labelled rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vendaval.llm.calibration import Logistic, bounded, fit_logistic, labelled_ids
from vendaval.llm.shared import held_out


@dataclass(frozen=True)
class Training:
    """Bounds of the sample the classifier is fitted on."""

    texts: int = 1500  # texts of each label for the dictionaries
    piece: int = 4000  # characters of the pieces they are cut into, whole
    pieces: int = 2500  # pieces of each label a dictionary is trained on, of all texts' pieces
    dictionary: int = 1 << 16  # bytes of a dictionary
    calibration: int = 6000  # labelled rows for the calibration


@dataclass(frozen=True)
class QualityModel:
    good: bytes
    bad: bytes
    calibrated: Logistic | None = None


def _dictionary(texts: list[str], size: int) -> bytes:
    """A trained dictionary; of texts too few to train on, the texts themselves."""
    samples = [t.encode("utf-8", "replace") for t in texts if t]
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:size]


def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    plain = {"level": 1, "write_content_size": False, "write_checksum": False, "write_dict_id": False}
    if len(dictionary) < 8:
        return zstandard.ZstdCompressor(**plain)
    return zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(dictionary), **plain)


def compression_features(model: QualityModel, texts: Iterable[str | None]) -> np.ndarray:
    """Five numbers per text; a null text counts as empty."""
    good, bad, none = _compressor(model.good), _compressor(model.bad), _compressor(b"")
    rows = []
    for text in texts:
        raw = (text or "").encode("utf-8", "replace")
        a, b, c = (len(z.compress(raw)) for z in (good, bad, none))
        n = len(raw) + 1
        rows.append(((a - b) / max(a, b), (a - b) / n, c / n, min(a, b) / n, np.log(n)))
    return np.array(rows, dtype=np.float64).reshape(-1, 5)


def quality_score(model: QualityModel, text: Column) -> Column:
    """Probability of label 1 for each text."""

    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(model.calibrated(compression_features(model, texts)), dtype="float64")

    return F.pandas_udf(score, "double")(text)


def train_quality(documents: DataFrame, labels: DataFrame, training: Training = Training()) -> QualityModel:
    """Fits the classifier on bounded samples of labelled rows outside the held-out fifth.

    Dictionaries and calibration use disjoint halves of the labels. To the driver come
    ``pieces`` pieces of text of each label and twice ``calibration`` rows of numbers at most,
    whatever the tables hold. Which they are, hashes decide, so reruns agree.
    Without labels of both kinds the score is the share of label 1, 0.5 without any.
    """
    texts = documents.select("doc_id", "text")

    def pieces(value: int) -> list[str]:
        ids = labelled_ids(labels, "quality", 0, training.texts, value)
        # The limit bounds the ids, so they can be sent to every task.
        found = texts.join(F.broadcast(ids), "doc_id").where(F.length("text") > 0)
        size = training.piece
        cuts = f"transform(sequence(0, (length(text) - 1) div {size}), i -> substring(text, cast(i * {size} + 1 as int), {size}))"
        cut = found.select("doc_id", F.posexplode(F.expr(cuts)).alias("at", "t"))
        chosen = cut.orderBy(F.xxhash64("doc_id", "at", "t"), "t").limit(training.pieces)
        return sorted(r["t"] for r in chosen.collect())

    model = QualityModel(*(_dictionary(pieces(v), training.dictionary) for v in (1, 0)))

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            features = pd.DataFrame(compression_features(model, rows["text"]), columns=list("abcde"))
            yield features.assign(label=rows["label"].to_numpy())

    ids = labelled_ids(labels, "quality", 1, training.calibration)
    measured = texts.join(F.broadcast(ids), "doc_id")
    rows = measured.select("text", F.col("label").cast("int").alias("label"))
    rows = rows.mapInPandas(measure, "a double, b double, c double, d double, e double, label int")
    table = bounded(rows, 2 * training.calibration)
    fitted = fit_logistic(table[list("abcde")].to_numpy(np.float64), table["label"].to_numpy(np.float64))
    return QualityModel(model.good, model.bad, fitted)


def score_quality(documents: DataFrame, labels: DataFrame, least: float = 0.3, training: Training = Training()) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``documents``.

    Null and empty texts are scored as the empty text; repeated rows get the same score; an
    empty table gives no rows. Only text enters the score.
    """
    model = train_quality(documents, labels, training)
    scored = documents.select("doc_id", quality_score(model, F.col("text")).alias("score"))
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id"), 0).alias("held_out"),
        "score",
        (F.col("score") >= least).cast("int").alias("predicted"),
    )


def keep_good(documents: DataFrame, labels: DataFrame, least: float = 0.3, training: Training = Training()) -> DataFrame:
    """The rows of ``documents``, all columns, whose score is at least ``least``."""
    model = train_quality(documents, labels, training)
    return documents.where(quality_score(model, F.col("text")) >= least)
