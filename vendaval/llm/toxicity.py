"""Operator 3, toxicity: every significant passage of toxic words, by maximum-scoring segments.

Words get log-odds between toxic and clean labelled text under an informative Dirichlet
prior. One pass over a text finds all its maximal segments of positive total score. How
often clean text reaches a segment's score follows an extreme-value law, which turns scores
into expected counts and those of a text into one probability.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vendaval.llm.batches import letter_tokens
from vendaval.llm.calibration import Logistic, bounded, fit_logistic, labelled_ids
from vendaval.llm.shared import held_out


@dataclass(frozen=True)
class Training:
    """Bounds of the sample the model is fitted on, and its constants."""

    texts: int = 8000  # labelled texts of each kind for the log-odds
    calibration: int = 6000  # labelled rows for the calibration
    prior: float = 0.05  # weight of the prior, as a share of the sample's tokens
    least_z: float = 3.0  # standard errors a word's log-odds must be above 0
    margin: float = 0.25  # taken off every word's score, so that clean text scores below 0
    stem: int = 4  # letters of the beginning that stands in for a word the table lacks
    expected: float = 0.01  # a passage counts if clean text has it this rarely


@dataclass(frozen=True)
class ToxicityModel:
    scores: dict[str, float]  # positive scores of words; of beginnings, with a trailing *
    other: float  # score of all other words, below 0
    scale: float  # lambda of the extreme-value law
    factor: float = 1.0  # its K
    stem: int = 4
    expected: float = 0.01
    calibrated: Logistic | None = None

    def word_score(self, word: str) -> float:
        found = self.scores.get(word)
        if found is None and len(word) > self.stem:
            found = self.scores.get(word[: self.stem] + "*")
        return self.other if found is None else found


def maximal_segments(at: list[int], score: list[float], other: float) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (begin, end, score), in one pass (Ruzzo and Tompa).

    ``at`` are the places of the tokens that score above 0 and ``score`` their scores; every
    token between scores ``other``, below 0. No two segments touch, each is the best within
    itself, and nothing outside them scores above 0.
    """
    stack: list[tuple[int, int, float, float]] = []  # begin, end, sum before, sum through
    total, last = 0.0, -1
    for place, value in zip(at, score):
        total += other * (place - last - 1)
        begin, before = place, total
        total += value
        last = place
        through = total
        while True:
            # The nearest candidate that starts from a lower sum.
            j = len(stack) - 1
            while j >= 0 and stack[j][2] >= before:
                j -= 1
            if j < 0 or stack[j][3] >= through:
                stack.append((begin, place, before, through))
                break
            begin, before = stack[j][0], stack[j][2]
            del stack[j:]
    return [(b, e, through - before) for b, e, before, through in stack]


def passages(model: ToxicityModel, texts: list[str | None]) -> tuple[list[list], np.ndarray]:
    """Significant passages (first word, last word, log10 of the expected count) and features."""
    words, codes, ends = letter_tokens(texts)
    table = np.array([model.word_score(w) for w in words]) if words else np.zeros(0)
    scores = table[codes]
    above = np.flatnonzero(scores > 0)
    cuts = np.searchsorted(above, ends)
    found, features = [], []
    for i in range(len(texts)):
        own = above[cuts[i] : cuts[i + 1]]
        n = max(int(ends[i + 1] - ends[i]), 1)
        base = np.log(model.factor * n)
        kept, best, total = [], 0.0, 0.0
        for b, e, s in maximal_segments((own - ends[i]).tolist(), scores[own].tolist(), model.other):
            surprise = model.scale * s - base  # minus log of the expected count
            best = max(best, surprise)
            if surprise >= -np.log(model.expected):
                kept.append((b, e, -surprise / np.log(10)))
                total += surprise
        found.append(kept)
        features.append((best, np.log1p(total), np.log1p(len(kept))))
    return found, np.array(features, dtype=np.float64).reshape(-1, 3)


def _word_scores(counts: pd.DataFrame, training: Training) -> tuple[dict[str, float], float, float]:
    """Scores above 0, the score of the rest, and lambda, from (token, toxic, clean) counts."""
    plain = ~counts["token"].str.endswith("*")
    toxic_all, clean_all = (float(counts.loc[plain, c].sum()) for c in ("toxic", "clean"))
    if not toxic_all or not clean_all:
        return {}, -training.margin, 1.0
    toxic, clean = (counts[c].to_numpy(np.float64) for c in ("toxic", "clean"))
    prior_all = training.prior * (toxic_all + clean_all)
    prior = training.prior * (toxic + clean)
    odds = [np.log((y + prior) / (n + prior_all - y - prior)) for y, n in ((toxic, toxic_all), (clean, clean_all))]
    delta = odds[0] - odds[1]
    z = delta / np.sqrt(1 / (toxic + prior) + 1 / (clean + prior))
    score = delta - training.margin
    chosen = (z >= training.least_z) & (score > 0)
    scores = dict(zip(counts["token"][chosen], score[chosen].tolist()))
    # What clean text looks like: the chosen words at their clean rates, the rest as one.
    words = (chosen & plain).to_numpy()
    rates, values = (clean[words] + prior[words]) / (clean_all + prior_all), score[words]
    rest = max(1.0 - rates.sum(), 1e-6)
    low = min(float(np.log(max(1.0 - toxic[words].sum() / toxic_all, 1e-6) / rest)), 0.0) - training.margin
    left, right = 1e-6, 50.0
    for _ in range(80):
        middle = (left + right) / 2
        high = (rates * np.exp(np.minimum(middle * values, 700))).sum() + rest * np.exp(middle * low) > 1
        left, right = (left, middle) if high else (middle, right)
    return scores, low, left


def train_toxicity(documents: DataFrame, labels: DataFrame, training: Training = Training()) -> ToxicityModel:
    """Fits the model on bounded samples of labelled rows outside the held-out fifth.

    Log-odds and calibration use disjoint halves of the labels. Words are counted by Spark;
    to the driver come the words that occur in toxic sample texts more often than by chance
    and one row of sums for the others. Without labels of both kinds every text gets the
    share of label 1, 0.5 without any.
    """
    texts = documents.select("doc_id", "text")
    ids = labelled_ids(labels, "toxic", 0, training.texts, 1).unionByName(
        labelled_ids(labels, "toxic", 0, training.texts, 0)
    )

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            words, codes, ends = letter_tokens(rows["text"].tolist())
            toxic = np.repeat(rows["label"].to_numpy() == 1, np.diff(ends))
            counts = [np.bincount(codes[m], minlength=len(words)) for m in (toxic, ~toxic)]
            yield pd.DataFrame({"token": words, "toxic": counts[0], "clean": counts[1]})

    sample = texts.join(F.broadcast(ids), "doc_id").select("text", F.col("label").cast("int").alias("label"))
    split_words = sample.mapInPandas(split, "token string, toxic long, clean long").where("toxic + clean > 0")
    sums = [F.sum(c).alias(c) for c in ("toxic", "clean")]
    words = split_words.groupBy("token").agg(*sums)
    stems = words.where(F.length("token") > training.stem)
    stems = stems.groupBy(F.concat(F.substring("token", 1, training.stem), F.lit("*")).alias("token")).agg(*sums)
    every = words.unionByName(stems)
    # Only words with more toxic uses than half the clean ones, and several, can score.
    likely = (F.col("toxic") >= 3) & (F.col("toxic") * 2 >= F.col("clean"))
    name = F.when(likely, F.col("token")).when(F.col("token").endswith("*"), "other*").otherwise("other")
    counts = every.groupBy(name.alias("token")).agg(*sums).toPandas().sort_values("token", ignore_index=True)
    counts = counts.astype({"toxic": "int64", "clean": "int64"})
    scores, low, scale = _word_scores(counts, training)
    for rest in ("other", "other*"):
        scores.pop(rest, None)
    model = ToxicityModel(scores, low, scale, 1.0, training.stem, training.expected)

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            words, codes, ends = letter_tokens(rows["text"].tolist())
            table = np.array([model.word_score(w) for w in words]) if words else np.zeros(0)
            best = []
            for a, b in zip(ends[:-1].tolist(), ends[1:].tolist()):
                own = table[codes[a:b]]
                at = np.flatnonzero(own > 0)
                segments = maximal_segments(at.tolist(), own[at].tolist(), model.other)
                best.append((max((s for _, _, s in segments), default=0.0), max(b - a, 1)))
            out = pd.DataFrame(best, columns=["best", "n"], dtype="float64")
            yield out.assign(label=rows["label"].to_numpy(), text=rows["text"].to_numpy())

    ids = labelled_ids(labels, "toxic", 1, training.calibration)
    sample = texts.join(F.broadcast(ids), "doc_id").select("text", F.col("label").cast("int").alias("label"))
    rows = sample.mapInPandas(measure, "best double, n double, label int, text string")
    # K from clean texts: the mean of a Gumbel law lies Euler's constant above its mode. It is
    # rounded, because a sum of doubles depends on the order of the tasks.
    clean = rows.where("label = 0").agg(F.avg(F.col("best") * scale - F.log("n")), F.count("*")).first()
    factor = float(np.exp(np.clip(round(clean[0] or 0.0, 9) - np.euler_gamma, -12.0, 2.0))) if clean[1] else 1.0
    model = ToxicityModel(scores, low, scale, factor, training.stem, training.expected)

    def featured(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            _, features = passages(model, part["text"].tolist())
            yield pd.DataFrame(features, columns=list("abc")).assign(label=part["label"].to_numpy())

    featured_rows = sample.mapInPandas(featured, "a double, b double, c double, label int")
    table = bounded(featured_rows, 2 * training.calibration)
    fitted = fit_logistic(table[list("abc")].to_numpy(np.float64), table["label"].to_numpy(np.float64))
    return ToxicityModel(scores, low, scale, factor, training.stem, training.expected, fitted)


def score_toxicity(documents: DataFrame, labels: DataFrame, training: Training = Training()) -> DataFrame:
    """(doc_id, held_out, score, predicted, passages) for every row of ``documents``.

    ``passages`` lists each significant passage: its first and last word, counted from 0 over
    runs of letters and digits, and log10 of how many such clean text would hold. Null and
    empty texts have no words and get the score of a text without toxic words; repeated rows
    get the same score; an empty table gives no rows. Only text enters the score.
    """
    model = train_toxicity(documents, labels, training)
    kind = "score double, passages array<struct<first: long, last: long, log10_expected: double>>"

    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            found, features = passages(model, texts.tolist())
            rows = [[{"first": a, "last": b, "log10_expected": x} for a, b, x in own] for own in found]
            yield pd.DataFrame({"score": model.calibrated(features), "passages": pd.Series(rows, dtype=object)})

    judged = documents.select("doc_id", F.pandas_udf(judge, kind)(F.col("text")).alias("j"))
    return judged.select(
        "doc_id",
        held_out(F.col("doc_id"), 0).alias("held_out"),
        F.col("j.score").alias("score"),
        (F.col("j.score") >= 0.5).cast("int").alias("predicted"),
        F.col("j.passages").alias("passages"),
    )
