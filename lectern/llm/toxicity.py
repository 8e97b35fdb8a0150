"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

A text's features are the distinct hashed n-grams that it holds. Each is scaled by the log ratio of its
smoothed frequency among toxic and other training texts; a logistic regression with a quadratic penalty
is fitted on the scaled features. What scores a text is one weight for each cell and a bias.
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

ORDERS = (5,)
BITS = 18
#: The bound of the training sample: labelled rows, and characters of their texts together.
SAMPLE_ROWS, SAMPLE_CHARS = 3000, 12_000_000
LEAST_TEXTS = 5  # a cell in fewer training texts has no weight
PENALTY, ROUNDS, RATE = 10.0, 80, 0.1


@dataclass(frozen=True)
class ToxicityModel:
    weights: np.ndarray
    bias: float

    def score(self, text: str | None) -> float:
        held = np.zeros(len(self.weights), bool)
        held[char_ngrams(text, ORDERS, BITS)] = True
        z = self.bias + float(self.weights[np.flatnonzero(held)].sum())
        return float(1 / (1 + np.exp(-np.clip(z, -500, 500))))


def train(texts: list[str], toxic: np.ndarray) -> ToxicityModel:
    """A model of 0/1 labels. Without texts of both labels it gives every text the share of label 1."""
    size = 1 << BITS
    y = np.asarray(toxic, np.float64)
    if len(texts) == 0 or y.min() == y.max():
        share = (y.sum() + 0.5) / (len(y) + 1)
        return ToxicityModel(np.zeros(size, np.float32), float(np.log(share / (1 - share))))
    cells = [np.unique(char_ngrams(t, ORDERS, BITS)).astype(np.int32) for t in texts]
    many = np.bincount(np.concatenate(cells), minlength=size)
    cells = [c[many[c] >= LEAST_TEXTS] for c in cells]
    row, cell = np.repeat(np.arange(len(cells)), [len(c) for c in cells]), np.concatenate(cells)
    hit = np.bincount(cell, weights=y[row], minlength=size)
    ratio = np.log((hit + 1) / (y.sum() + 2)) - np.log((many * (many >= LEAST_TEXTS) - hit + 1) / (len(y) - y.sum() + 2))
    x = ratio[cell].astype(np.float32)
    share = np.where(y == 1, 0.5 / y.sum(), 0.5 / (len(y) - y.sum()))  # both labels weigh alike, however rare one is
    w, grow, bias, bias_grow = np.zeros(size), np.full(size, 1e-8), 0.0, 1e-8
    for _ in range(ROUNDS):  # full-batch Adagrad
        z = np.bincount(row, weights=x * w[cell], minlength=len(y)) + bias
        off = (1 / (1 + np.exp(-np.clip(z, -500, 500))) - y) * share
        g = np.bincount(cell, weights=x * off[row], minlength=size) + PENALTY * w / len(y)
        grow += g * g
        w -= RATE * g / np.sqrt(grow)
        bias_grow += off.sum() ** 2
        bias -= RATE * off.sum() / np.sqrt(bias_grow)
    return ToxicityModel((w * ratio).astype(np.float32), float(bias))


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, chars: int = SAMPLE_CHARS) -> ToxicityModel:
    """Learns from labels.toxic on a bounded sample outside the held-out fold; see labelled_sample.

    Labels other than 0 and 1 are refused. Of no labelled text, every text scores one half.
    """
    texts, toxic = labelled_sample(docs, labels, "toxic", rows, chars)
    if not np.isin(toxic, (0, 1)).all():
        raise ValueError("toxic holds other values than 0 and 1")
    return train(texts, toxic)


def score_toxicity(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """docs with score (0 to 1) and predicted (1 where score >= 0.5) added; columns of those names are replaced.

    A null text counts as empty and scores by the bias alone.
    """
    docs = docs.drop("score", "predicted")
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            scores = [sent.value.score(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(scores, pa.float64()), pa.array([int(s >= 0.5) for s in scores], pa.int32())], [*batch.schema.names, "score", "predicted"]
            )

    return docs.mapInArrow(run, widened(docs.schema, score="double", predicted="integer"))


def toxicity_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of docs, null, empty and repeated ones too, by a model of labels.

    A null doc_id counts as held out. Equal texts score alike.
    """
    scored = score_toxicity(docs.select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out")), fit(docs, labels))
    return scored.select("doc_id", "held_out", "score", "predicted")
