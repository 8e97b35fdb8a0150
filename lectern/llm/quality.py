"""Quality classifier: ordinal cumulative-link regression on graded ratings.

P(grade <= k) is the logistic function of threshold k less the text's strength; all grades share one
weight vector over hashed character n-grams, and thresholds are kept in order by learning the logarithms
of their steps. A text's expected grade and the probability that it reaches a wanted grade select it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.llm.batches import slices, widened
from lectern.llm.ngrams import char_ngrams, held_out, labelled_sample

ORDERS = (1, 2, 3)
BITS = 12
#: The bound of the training sample: labelled rows, and characters of their texts together.
SAMPLE_ROWS, SAMPLE_CHARS = 3000, 12_000_000
PENALTY, ROUNDS, RATE = 1e-4, 200, 0.1
SELECT = 0.5


def features(text: str | None) -> np.ndarray:
    """Root counts of the text's hashed n-grams, of unit length; zeros for a null or empty text."""
    x = np.sqrt(np.bincount(char_ngrams(text, ORDERS, BITS), minlength=1 << BITS)).astype(np.float32)
    norm = np.linalg.norm(x)
    return x / norm if norm else x


def _logistic(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


@dataclass(frozen=True)
class QualityModel:
    grades: list[float]  # ascending, as they stand in the labels
    weights: np.ndarray
    thresholds: np.ndarray  # one fewer than grades, ascending

    def above(self, x: np.ndarray) -> np.ndarray:
        """[text, k]: probability of a grade above the k-th."""
        return _logistic((x @ self.weights)[:, None] - self.thresholds[None, :])

    def expected(self, above: np.ndarray) -> np.ndarray:
        return self.grades[0] + above @ np.diff(np.array(self.grades, np.float64))


def train(texts: list[str], grades: np.ndarray) -> QualityModel:
    """Fits the likelihood by Adam from a fixed start. Of no rows, the one grade 0 is known."""
    known = sorted(set(np.asarray(grades).tolist())) or [0]
    k = len(known)
    size = 1 << BITS
    if k == 1:
        return QualityModel(known, np.zeros(size, np.float32), np.zeros(0))
    x = np.stack([features(t) for t in texts])
    y = np.searchsorted(known, grades)
    below = np.cumsum(np.bincount(y, minlength=k))[:-1] / len(y)
    first = np.log(below / (1 - below))
    steps = np.log(np.maximum(np.diff(first), 1e-3))
    p = np.concatenate([np.zeros(size), first[:1], steps])  # weights, first threshold, log steps
    m, v = np.zeros_like(p), np.zeros_like(p)
    for r in range(1, ROUNDS + 1):
        theta = p[size] + np.concatenate(([0.0], np.cumsum(np.exp(p[size + 1 :]))))
        s = x @ p[:size].astype(np.float32)
        upto = np.hstack([np.zeros((len(y), 1)), _logistic(theta[None, :] - s[:, None]), np.ones((len(y), 1))])
        high, low = upto[np.arange(len(y)), y + 1], upto[np.arange(len(y)), y]
        mass = np.maximum(high - low, 1e-12)
        dh, dl = high * (1 - high) / mass, low * (1 - low) / mass  # slopes at the grade's two thresholds
        weights = (x.T @ ((dh - dl) / len(y)).astype(np.float32)) + PENALTY * p[:size]
        theta_g = np.array([(dl[y == j + 1].sum() - dh[y == j].sum()) / len(y) for j in range(k - 1)])
        step_g = np.array([theta_g[j + 1 :].sum() for j in range(k - 2)]) * np.exp(p[size + 1 :])
        g = np.concatenate([weights, [theta_g.sum()], step_g])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        p = p - RATE * (m / (1 - 0.9**r)) / (np.sqrt(v / (1 - 0.999**r)) + 1e-8)
    theta = p[size] + np.concatenate(([0.0], np.cumsum(np.exp(p[size + 1 :]))))
    return QualityModel(known, p[:size].astype(np.float32), theta)


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", rows: int = SAMPLE_ROWS, chars: int = SAMPLE_CHARS) -> QualityModel:
    """Learns from labels on a bounded sample outside the held-out fold; grades may be any numbers. See labelled_sample."""
    return train(*labelled_sample(docs, labels, label, rows, chars))


def rate(docs: DataFrame, model: QualityModel, wanted: float | None = None) -> DataFrame:
    """docs with expected_grade, tail_prob (of reaching `wanted`, by default the highest grade) and selected
    (tail_prob >= SELECT) added; columns of those names are replaced. A null text counts as empty."""
    docs = docs.drop("expected_grade", "tail_prob", "selected")
    sent = docs.sparkSession.sparkContext.broadcast(model)
    goal = model.grades[-1] if wanted is None else wanted

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        for batch in slices(batches):
            above = known.above(np.stack([features(t) for t in batch.column("text").to_pylist()]))
            at = int(np.searchsorted(known.grades, goal))  # the first grade that is high enough
            tail = np.ones(len(above)) if at == 0 else np.zeros(len(above)) if at == len(known.grades) else above[:, at - 1]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(known.expected(above)), pa.array(tail), pa.array(tail >= SELECT)], [*batch.schema.names, "expected_grade", "tail_prob", "selected"]
            )

    return docs.mapInArrow(run, widened(docs.schema, expected_grade="double", tail_prob="double", selected="boolean"))


def quality_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, expected_grade, tail_prob and selected of every row of docs, null, empty and repeated ones too.

    A null doc_id counts as held out. Without labels the only grade is 0 and every text reaches it.
    """
    rated = rate(docs.select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out")), fit(docs, labels))
    return rated.select("doc_id", "held_out", "expected_grade", "tail_prob", "selected")
