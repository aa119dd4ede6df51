"""Bounded samples of labelled texts, and the calibration of a classifier's output."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowsmith.llm.tables import held_out, quoted


@dataclass(frozen=True)
class Sample:
    """Texts of both classes with their labels, and how many labelled rows each class has."""

    texts: list[str]
    labels: np.ndarray
    class_rows: tuple[int, int]

    @property
    def weights(self) -> np.ndarray:
        """Weight per text that restores the shares of the classes among all labelled rows."""
        drawn = np.bincount(self.labels, minlength=2)
        return np.array([self.class_rows[y] / max(1, drawn[y]) for y in self.labels], float)


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, per_class: int, doc_id: str = "doc_id", text: str = "text"
) -> Sample:
    """At most ``per_class`` training texts of each class, the first by a hash of their id.

    Held-out ids are never drawn. Ids or labels that are null are left out; of rows with one id
    the largest label and the smallest text count. At most ``2 * per_class`` ids are broadcast
    to find the texts, and as many texts come to the driver.
    """
    known = (
        labels.select(quoted(doc_id).alias("id"), quoted(label).cast("int").alias("y"))
        .filter("id is not null and y in (0, 1)")
        .filter(~held_out(F.col("id")))
        .groupBy("id")
        .agg(F.max("y").alias("y"))
    )
    order = [F.xxhash64(F.col("id").cast("string"), F.lit(label)), F.col("id")]
    rows = {y: known.filter(F.col("y") == y) for y in (0, 1)}
    counts = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    drawn = rows[0].orderBy(*order).limit(per_class).union(rows[1].orderBy(*order).limit(per_class))
    texts = docs.select(quoted(doc_id).alias("of"), quoted(text).alias("text"))
    found = (
        texts.join(F.broadcast(drawn), F.col("of") == F.col("id"))
        .groupBy("id", "y")
        .agg(F.min("text").alias("text"))
        .orderBy(*order)
        .collect()
    )
    return Sample(
        [r["text"] or "" for r in found],
        np.array([r["y"] for r in found], np.int64),
        (counts.get(0, 0), counts.get(1, 0)),
    )


def logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def calibrate(raw: np.ndarray, labels: np.ndarray, weights: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """(slope, shift) of the logistic curve from raw outputs to probabilities, lightly held to (1, 0)."""
    x = np.stack([raw, np.ones(len(raw))], axis=1)
    theta, start = np.array([1.0, 0.0]), np.array([1.0, 0.0])
    for _ in range(rounds):
        p = logistic(x @ theta)
        gradient = x.T @ (weights * (labels - p)) - (theta - start)
        curvature = (x * (weights * p * (1 - p))[:, None]).T @ x + np.eye(2)
        step = np.linalg.solve(curvature, gradient)
        theta = theta + np.clip(step, -1, 1)
    return float(max(theta[0], 1e-3)), float(theta[1])
