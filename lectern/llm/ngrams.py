"""Hashed character n-grams of texts, and the labelled samples that classifiers learn from."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_ODD = np.uint64(0x9E3779B97F4A7C15)
#: The label values that a sample may have to share its rows.
MAX_VALUES = 64
_MIX = np.uint64(0xBF58476D1CE4E5B9)


def char_ngrams(text: str | None, orders: tuple[int, ...], bits: int) -> np.ndarray:
    """The cells, below 2**bits, of the n-grams of each order of a whole text, in turn."""
    code = np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    found = []
    with np.errstate(over="ignore"):
        for n in orders:
            m = len(code) - n + 1
            if m <= 0:
                continue
            h = np.full(m, n, np.uint64)
            for k in range(n):
                h = (h + code[k : k + m]) * _ODD
                h ^= h >> np.uint64(29)
            found.append(((h * _MIX) >> np.uint64(64 - bits)).astype(np.int64))
    return np.concatenate(found) if found else np.zeros(0, np.int64)


def held_out(doc_id: Column) -> Column:
    """Whether a document belongs to the fold that nothing is learned from; a null doc_id does."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int, chars: int) -> tuple[list[str], np.ndarray]:
    """Texts and labels of a bounded sample of labelled rows outside the held-out fold.

    The rows of least hash of doc_id, so many of each label value that there are `rows` at most, and of
    them, in that order, those that fit into the value's share of `chars` characters; texts are whole and
    one that doesn't fit is passed over. The same rows come whatever the partitions. Labels keep their own
    values, fractions too; null and NaN ones are no labels. A doc_id that is labelled in several ways counts under
    each, and of several texts of one doc_id the greatest is taken. Refused are more than MAX_VALUES label
    values, which nothing could be told about one by one, and a sample without a value that some text is
    labelled with.
    """
    value = F.col(label).cast("double")
    labels = labels.filter(value.isNotNull() & ~F.isnan(value)).select(F.col("doc_id").cast("long").alias("doc_id"), value.alias("label"))
    if labels.select("label").distinct().limit(MAX_VALUES + 1).count() > MAX_VALUES:
        raise ValueError(f"{label} holds more than {MAX_VALUES} values")
    known = labels.filter(~held_out(F.col("doc_id"))).distinct()
    values = [r["label"] for r in known.select("label").distinct().orderBy("label").collect()]
    ids = None
    for v in values:
        some = known.filter(F.col("label") == v).orderBy(F.xxhash64("doc_id"), "doc_id").limit(-(-rows // max(1, len(values))))
        ids = some if ids is None else ids.unionByName(some)
    if ids is None:
        return [], np.zeros(0)
    keep = [tuple(r) for r in ids.collect()]  # at most `rows` and one for each value
    session = docs.sparkSession
    chosen = F.broadcast(session.createDataFrame(keep, "doc_id long, label double"))
    sized = docs.select("doc_id", F.length("text").alias("n")).join(chosen, "doc_id").filter("n > 0").groupBy("doc_id", "label").agg(F.max("n").alias("n"))
    order = sorted(sized.withColumn("h", F.xxhash64("doc_id")).collect(), key=lambda r: (r["h"], r["doc_id"]))
    left, within = dict.fromkeys(values, chars // len(values)), []
    for r in order:
        if r["n"] <= left[r["label"]]:
            left[r["label"]] -= r["n"]
            within.append((r["doc_id"], r["label"]))
    without = sorted(set(values) - {v for _, v in within})
    if without and not docs.filter("length(text) > 0").join(known.filter(F.col("label").isin(without)), "doc_id").isEmpty():
        raise ValueError(f"no text of {label} {without} fits into the sample of {rows} rows and {chars} characters")
    if not within:
        return [], np.zeros(0)
    chosen = F.broadcast(session.createDataFrame(within, "doc_id long, label double"))
    found = docs.select("doc_id", "text").join(chosen, "doc_id").filter("length(text) > 0").groupBy("doc_id", "label").agg(F.max("text").alias("text"))
    got = sorted(found.collect(), key=lambda r: r["doc_id"])
    return [r["text"] for r in got], np.array([r["label"] for r in got])
