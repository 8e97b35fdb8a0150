"""Language ID: multinomial naive Bayes over hashed character n-grams.

Counts are taken over all labelled rows outside the held-out fold: a row for each language and task is
summed by language, level by level, so what reaches the driver is one matrix. Its log-probabilities are broadcast, and the
texts of a batch are scored together, sparsely: the matrix rows of their n-grams are gathered and summed.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.llm.batches import slices, summed, widened
from lectern.llm.ngrams import char_ngrams, held_out

ORDERS = (1, 2, 3)
BITS = 15
SMOOTHING = 0.5
UNDECIDED = "und"
#: Languages counted in memory at once by a training task, and n-grams scored at once.
HELD_LANGUAGES, HELD_CELLS = 64, 1 << 18
#: The matrix takes 128 KB a language where it is broadcast; a column of more values isn't one of languages.
MAX_LANGUAGES = 1000


@dataclass(frozen=True)
class LanguageModel:
    languages: list[str]
    prior: np.ndarray  # log share of each language's rows
    matrix: np.ndarray  # [cell, language] log-probability

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """For each text the language of highest posterior, ties to the first by name, and that posterior.

        A null text or one without letters is UNDECIDED with 0; so is every text under a model that
        learned no language.
        """
        usable = [bool(t) and len(self.languages) > 0 and any(map(str.isalpha, t)) for t in texts]
        total = np.zeros((len(texts), len(self.languages)))
        held, owner, size = [], [], 0
        for k, t in enumerate(texts):
            if usable[k]:
                cells = char_ngrams(t.lower(), ORDERS, BITS)
                for at in range(0, len(cells), HELD_CELLS):
                    held.append(cells[at : at + HELD_CELLS])
                    owner.append(k)
                    size += len(held[-1])
                    if size >= HELD_CELLS:
                        self._add(total, held, owner)
                        held, owner, size = [], [], 0
        if held:
            self._add(total, held, owner)
        names, scores = [UNDECIDED] * len(texts), [0.0] * len(texts)
        for k in np.flatnonzero(usable):
            z = total[k] + self.prior
            p = np.exp(z - z.max())
            best = int(z.argmax())
            names[k], scores[k] = self.languages[best], float(p[best] / p.sum())
        return names, scores

    def _add(self, total: np.ndarray, held: list[np.ndarray], owner: list[int]) -> None:
        start = np.concatenate(([0], np.cumsum([len(c) for c in held])[:-1]))
        np.add.at(total, owner, np.add.reduceat(self.matrix[np.concatenate(held)], start, axis=0, dtype=np.float64))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, tuple[np.ndarray, list[int]]] = {}

    def told() -> pa.RecordBatch:
        rows = [(k, n[0], c.tobytes(), TaskContext.get().partitionId()) for k, (c, n) in held.items()]
        return pa.RecordBatch.from_arrays([pa.array(list(x), t) for x, t in zip(zip(*rows, strict=True), (pa.string(), pa.int64(), pa.binary(), pa.int32()), strict=True)], ["lang", "rows", "counts", "lot"])

    for batch in slices(batches):
        for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist(), strict=True):
            counts, rows = held.setdefault(lang, (np.zeros(1 << BITS, np.int64), [0]))
            counts += np.bincount(char_ngrams(text.lower(), ORDERS, BITS), minlength=1 << BITS)
            rows[0] += 1
            if len(held) > HELD_LANGUAGES:
                yield told()
                held.clear()
    if held:
        yield told()


def _sum(table: pa.Table) -> pa.Table:
    counts = sum(np.frombuffer(c, np.int64) for c in table.column("counts").to_pylist())
    return pa.table({"lang": table.column("lang").slice(0, 1), "rows": pa.array([sum(table.column("rows").to_pylist())]), "counts": pa.array([counts.tobytes()], pa.binary()), "lot": table.column("lot").slice(0, 1)})


def fit(docs: DataFrame) -> LanguageModel:
    """Learns from text and lang of all rows outside the held-out fold where both are given.

    Over MAX_LANGUAGES different values of lang are refused.
    """
    known = docs.filter(~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("text", "lang")
    if known.select("lang").distinct().limit(MAX_LANGUAGES + 1).count() > MAX_LANGUAGES:
        raise ValueError(f"over {MAX_LANGUAGES} languages")
    rows = summed(known.mapInArrow(_count, "lang string, rows long, counts binary, lot int"), ["lang"], _sum).orderBy("lang").collect()
    if not rows:
        return LanguageModel([], np.zeros(0), np.zeros((1 << BITS, 0), np.float32))
    counts = np.stack([np.frombuffer(r["counts"], np.int64) for r in rows], axis=1) + SMOOTHING
    share = np.array([r["rows"] for r in rows], np.float64)
    return LanguageModel([r["lang"] for r in rows], np.log(share / share.sum()), np.log(counts / counts.sum(axis=0)).astype(np.float32))


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """docs with lang_pred and score added; columns of those names are replaced. See LanguageModel.predict."""
    docs = docs.drop("lang_pred", "score")
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            names, scores = sent.value.predict(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(names, pa.string()), pa.array(scores, pa.float64())], [*batch.schema.names, "lang_pred", "score"])

    return docs.mapInArrow(run, widened(docs.schema, lang_pred="string", score="double"))


def language_report(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row of docs by a model of its own lang column.

    Null texts and those without letters are UNDECIDED with score 0. A null doc_id counts as held out.
    """
    found = identify(docs.select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out")), fit(docs))
    return found.select("doc_id", "held_out", "lang_pred", "score")
