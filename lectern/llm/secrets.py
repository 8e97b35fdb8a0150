"""Secret scans: fixed patterns, and character Markov models compared by log-likelihood ratio.

Two second-order character models are trained from labelled samples, one of random strings and one of
ordinary identifiers. A run of token characters, or what spans of the fixed patterns leave of it, is
reported when the mean log-likelihood ratio per character favours randomness by MIN_RATIO. Spans of the
fixed patterns are always reported.
"""

from __future__ import annotations

import functools
import random
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.llm.batches import slices, widened

#: The kinds in order, and their patterns.
KINDS = ("assign", "access", "hex")
_ASSIGN = re.compile(r"""(?i:(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?)([A-Za-z0-9+/_.=-]+)""", re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]+")
_WORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")

MIN_RUN = 16  # the shortest match of access and hex lies in such a run
MIN_TOKEN = 20  # the shortest run that the models judge
MIN_RATIO = 0.6  # nats a character
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-="
_CODE = np.full(256, -1, np.int64)
_CODE[[ord(c) for c in ALPHABET]] = np.arange(len(ALPHABET))
_SIZE = len(ALPHABET)


def labelled_samples(n: int = 4000, seed: int = 11) -> list[tuple[str, int]]:
    """n random strings (1) and n ordinary identifiers (0): the default training sample."""
    rng = random.Random(seed)
    alphabets = (ALPHABET[:62], ALPHABET[:62] + "+/", ALPHABET[:62] + "_-", ALPHABET[26:62], "0123456789abcdef", ALPHABET[:26] + "0123456789")
    stems = (
        "account address amount archive array batch binary block border buffer button cache call center channel class "
        "client cluster color column command config connect content context control counter create current cursor data "
        "default delete detail device direct document driver element engine entry error event example field file filter "
        "format frame function global group handler header height history image import index input instance internal "
        "item kernel key label language layout length level library light limit list local location manager match "
        "memory message method model module monitor network node notification number object offset option order output "
        "package page parent pattern position prefix process product profile project property query queue random range "
        "record region register request resource response result return role root sample schema screen search section "
        "segment select sequence server service session setting signal simple single size source space stack start "
        "state static status storage stream string style system table target template text thread time title total "
        "trace transfer type unique update user value vector version view visible window word worker write zone"
    ).split()
    joins = (lambda w: "_".join(w), lambda w: "-".join(w), lambda w: "".join(x.title() for x in w), lambda w: "/".join(w), lambda w: "".join(w), lambda w: "_".join(w).upper(), lambda w: "=".join(w))
    out = []
    for _ in range(n):
        out.append(("".join(rng.choices(rng.choice(alphabets), k=rng.randint(20, 48))), 1))
        name = rng.choice(joins)([rng.choice(stems) for _ in range(rng.randint(3, 6))])
        out.append((name + (str(rng.randint(0, 2030)) if rng.random() < 0.3 else ""), 0))
    return out


def _triples(text: str | None) -> np.ndarray:
    """The numbers of the successive triples of a text's token characters; others are passed over."""
    c = _CODE[np.frombuffer((text or "").encode("ascii", "ignore"), np.uint8)]
    c = c[c >= 0]
    return (c[:-2] * _SIZE + c[1:-1]) * _SIZE + c[2:]


def train(samples: Iterable[tuple[str, int]]) -> np.ndarray:
    """Log-likelihood ratios [a, b, c] of character c after ab: random strings over ordinary identifiers."""
    counts = np.zeros((2, _SIZE**3))
    for text, label in samples:
        np.add.at(counts[1 if label else 0], _triples(text), 1.0)
    return _ratios(counts)


def fit(samples: DataFrame) -> np.ndarray:
    """The model of a table of labelled samples (text, label: 1 random, 0 ordinary), whatever its size.

    Rows of a null label teach nothing, a null or short text neither; of no rows, every ratio is 0. Triples are
    counted in tasks and summed; the counts that reach the driver are those of 2 * 67**3 triples at most.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            labels = batch.column("label").to_pylist()
            for y in (False, True):
                own = [_triples(t) for t, z in zip(batch.column("text").to_pylist(), labels, strict=True) if z is not None and bool(z) == y]
                found, n = np.unique(np.concatenate([np.zeros(0, np.int64), *own]), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([y] * len(found)).cast(pa.bool_()), pa.array(found), pa.array(n)], ["label", "triple", "n"])

    found = samples.select("text", "label").mapInArrow(count, "label boolean, triple long, n long").groupBy("label", "triple").agg(F.sum("n").alias("n"))
    counts = np.zeros((2, _SIZE**3))
    for r in found.collect():
        counts[int(r["label"]), r["triple"]] = r["n"]
    return _ratios(counts)


def _ratios(counts: np.ndarray) -> np.ndarray:
    counts = counts.reshape(2, _SIZE, _SIZE, _SIZE)
    pair = counts.sum(axis=1)  # first-order counts, by which thin second-order ones are smoothed
    single = pair.sum(axis=1) + 1.0
    one = single / single.sum(axis=1, keepdims=True)
    two = (pair + 8.0 * one[:, None, :]) / (pair.sum(axis=2, keepdims=True) + 8.0)
    three = (counts + 8.0 * two[:, None, :, :]) / (counts.sum(axis=3, keepdims=True) + 8.0)
    return (np.log(three[1]) - np.log(three[0])).astype(np.float32)


@functools.cache
def default_model() -> np.ndarray:
    return train(labelled_samples())


def ratio(token: bytes, model: np.ndarray) -> float:
    """Mean log-likelihood ratio of a token's characters, from the third on."""
    c = _CODE[np.frombuffer(token, np.uint8)]
    return float(model[c[:-2], c[1:-1], c[2:]].mean()) if len(c) > 2 else 0.0


def _rests(start: int, end: int, held: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """What the held spans leave of [start, end)."""
    rests, at = [], start
    for s, e in sorted(held):
        rests.append((at, s))
        at = max(at, e)
    return [(s, e) for s, e in [*rests, (at, end)] if s < e]


def _code_points(raw: bytes) -> np.ndarray:
    """For each byte of UTF-8, and the end, the code points before it."""
    first = (np.frombuffer(raw, np.uint8) & 0xC0) != 0x80
    return np.concatenate((np.zeros(1, np.int64), np.cumsum(first)))


def find_spans(text: str | None, model: np.ndarray, min_ratio: float = MIN_RATIO) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, str]]]:
    """(start, end, kind) of the fixed patterns, and those that the models add; in code points, by start.

    The work is in proportion to the text: runs and the spans of assign are swept once, side by side.
    """
    if not text:
        return [], []
    raw = text.encode("utf-8", "surrogatepass")
    base, added = [], []
    low = raw.lower()
    if any(w in low for w in _WORDS):
        base += [(m.start(), m.end(), "assign") for m in _ASSIGN.finditer(text) if len(m[2]) >= 8]
    assigned, done = [s[:2] for s in base], 0
    turns = np.flatnonzero(np.diff(np.concatenate(([False], _CODE[np.frombuffer(raw, np.uint8)] >= 0, [False])).astype(np.int8)))
    starts, ends = turns[::2], turns[1::2]
    long = ends - starts >= MIN_RUN
    starts, ends = starts[long], ends[long]
    places = starts if len(raw) == len(text) or not len(starts) else _code_points(raw)[starts]
    for a, b, at in zip(starts.tolist(), ends.tolist(), places.tolist(), strict=True):
        token = raw[a:b].decode("ascii")
        end = at + b - a
        fixed = [(at + m.start(), at + m.end(), "access") for m in _ACCESS.finditer(token) if m.end() - m.start() >= 16]
        fixed += [(at + m.start(), at + m.end(), "hex") for m in _HEX.finditer(token) if m.end() - m.start() >= 32]
        base += fixed
        while done < len(assigned) and assigned[done][1] <= at:
            done += 1
        held, k = [f[:2] for f in fixed], done
        while k < len(assigned) and assigned[k][0] < end:
            held.append(assigned[k])
            k += 1
        for s, e in _rests(at, end, held):
            if e - s >= MIN_TOKEN and ratio(raw[a + s - at : a + e - at], model) >= min_ratio:
                added.append((s, e, "markov"))
    base.sort(key=lambda s: (s[0], KINDS.index(s[2])))
    return base, added


def _told(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, b, kind in spans)


def secret_scan(docs: DataFrame, model: np.ndarray | None = None, min_ratio: float = MIN_RATIO) -> DataFrame:
    """docs with n_assign, n_access, n_hex, n_markov (long), base (string of base spans) and spans (of all) added.

    A null text counts as empty and has no spans. Other columns are kept; those that carry the new
    names are replaced. The scan of a row depends on its text alone.
    """
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(default_model() if model is None else model)
    new = ["n_assign", "n_access", "n_hex", "n_markov", "base", "spans"]
    docs = docs.drop(*new)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = []
            for text in batch.column("text").to_pylist():
                base, added = find_spans(text, sent.value, min_ratio)
                kinds = [s[2] for s in base]
                order = {k: i for i, k in enumerate((*KINDS, "markov"))}
                rows.append((*(kinds.count(k) for k in KINDS), len(added), _told(base), _told(sorted(base + added, key=lambda s: (s[0], order[s[2]])))))
            columns = [pa.array([r[k] for r in rows], pa.int64()) for k in range(4)] + [pa.array([r[k] for r in rows], pa.string()) for k in (4, 5)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], [*batch.schema.names, *new])

    return docs.mapInArrow(scan, widened(docs.schema, **dict.fromkeys(new[:4], "long"), **dict.fromkeys(new[4:], "string")))


def masked(text: str | None, spans: list[tuple[int, int, str]], mask: str) -> str | None:
    """text with its spans replaced; overlapping spans are masked as one."""
    out, at = [], 0
    for a, b, _ in sorted(spans):
        if a >= at:
            out += [text[at:a], mask]
        at = max(at, b)
    return text if not spans else "".join(out) + text[at:]


def redact(docs: DataFrame, model: np.ndarray | None = None, min_ratio: float = MIN_RATIO, mask: str = "[SECRET]") -> DataFrame:
    """docs with every span that secret_scan reports replaced by mask in text; all else is unchanged, null texts too."""
    sent = docs.sparkSession.sparkContext.broadcast(default_model() if model is None else model)
    at = docs.columns.index("text")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = [masked(t, sum(find_spans(t, sent.value, min_ratio), []), mask) for t in batch.column(at).to_pylist()]
            yield batch.set_column(at, "text", pa.array(texts, pa.string()))

    return docs.mapInArrow(cut, docs.schema)


def secret_report(docs: DataFrame) -> DataFrame:
    """doc_id, counts of base spans, base_sha256 and spans of each row: the digest of secret_scan. A null text counts as empty."""
    found = secret_scan(docs.select("doc_id", "text"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2(F.col("base").cast("binary"), 256).alias("base_sha256"), "spans", "n_markov")
