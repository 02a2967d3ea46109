"""Logistic calibration of a few features, fitted on a bounded sample."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vendaval.llm.shared import held_out


@dataclass(frozen=True)
class Logistic:
    """P(label 1) = logistic(squares and products of standardised features)."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    def __call__(self, features: np.ndarray) -> np.ndarray:
        expanded = _expand((features - self.mean) / self.scale)
        # Summed row by row, so that a score does not depend on its batch.
        total = (expanded * self.weights).sum(axis=1)
        return 1.0 / (1.0 + np.exp(-np.clip(total, -35.0, 35.0)))


def _expand(x: np.ndarray) -> np.ndarray:
    x = np.clip(x, -8.0, 8.0)
    left, right = np.triu_indices(x.shape[1])
    return np.column_stack([x, x[:, left] * x[:, right], np.ones(len(x))])


def fit_logistic(features: np.ndarray, labels: np.ndarray, ridge: float = 0.01) -> Logistic:
    """Newton's method with a ridge and shortened steps. With no rows, or one class, the score is constant."""
    n = features.shape[1]
    mean, scale = np.zeros(n), np.ones(n)
    if len(labels):
        mean, scale = features.mean(axis=0), features.std(axis=0) + 1e-9
    width = _expand(np.zeros((1, n))).shape[1]
    weights = np.zeros(width)
    if len(set(labels.tolist())) < 2:
        share = (labels.sum() + 0.5) / (len(labels) + 1.0)
        weights[-1] = np.log(share / (1.0 - share))
        return Logistic(mean, scale, weights)
    x = _expand((features - mean) / scale)
    def gain(w: np.ndarray) -> float:
        total = x @ w
        return float((labels * total - np.logaddexp(0.0, total)).sum() - ridge / 2 * (w @ w))

    best = gain(weights)
    for _ in range(100):
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ weights, -35.0, 35.0)))
        curvature = (x * (p * (1.0 - p))[:, None]).T @ x + ridge * np.eye(width)
        step = np.linalg.solve(curvature, x.T @ (labels - p) - ridge * weights)
        # Where the classes hardly overlap a whole step can overshoot without end.
        while (reached := gain(weights + step)) < best and np.abs(step).max() > 1e-8:
            step = step / 2
        if reached - best < 1e-9:
            break
        weights, best = weights + step, reached
    return Logistic(mean, scale, weights)


def labelled_ids(labels: DataFrame, label: str, part: int, limit: int, value: int | None = None) -> DataFrame:
    """At most ``limit`` (doc_id, label) rows of one half (``part`` 0 or 1) of the training labels.

    Rows are taken in the order of a hash of the id, which stands in for chance and makes
    reruns agree; ``value`` restricts them to one label. Rows held out of training, null
    labels and null ids are passed over; of contradicting labels of one id the larger counts.
    """
    single = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"), 0))
    single = single.groupBy("doc_id").agg(F.max(label).alias("label"))
    order = F.xxhash64("doc_id", F.lit("labelled"))
    chosen = single.where(F.pmod(order, F.lit(2)) == part)
    if value is not None:
        chosen = chosen.where(F.col("label") == value)
    return chosen.orderBy(order, "doc_id").limit(limit)


def bounded(rows: DataFrame, limit: int) -> pd.DataFrame:
    """At most ``limit`` rows of numbers, in an order that does not depend on the tasks.

    Labelled ids are bounded before they meet the documents, so only ids that many documents
    share can exceed the limit; a hash of the numbers then decides which rows stay.
    """
    columns = rows.columns
    chosen = rows.orderBy(F.xxhash64(*columns), *columns).limit(limit).toPandas()
    return chosen.sort_values(columns, ignore_index=True)
