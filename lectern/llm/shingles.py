"""Five-word shingles of whole texts as 64-bit hashes, computed for a batch of texts at once."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np

WORDS = 5
#: Texts are hashed together up to this many bytes; a longer text is hashed alone and whole.
BATCH_BYTES = 1 << 19

#: A longer word is hashed by itself.
WORD_BYTES = 256

_MIX = [0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB]
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: The low k bytes of a lane.
_LOW = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(_MIX[0])
    x = (x ^ (x >> np.uint64(27))) * np.uint64(_MIX[1])
    return x ^ (x >> np.uint64(31))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word data[start:end]: its length and lanes of eight bytes, mixed in turn."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    lanes = np.ndarray((len(data) + 1,), "<u8", padded.data, strides=(1,)).copy()
    size = ends - starts
    h = _mixed(size.astype(np.uint64) + np.uint64(_MIX[2]))
    left = np.flatnonzero(size <= WORD_BYTES)
    at, rest = starts[left], size[left]
    while len(left):
        h[left] = _mixed((h[left] + (lanes[at] & _LOW[np.minimum(rest, 8)])) * np.uint64(_MIX[3]) + np.uint64(_MIX[4]))
        more = rest > 8
        left, at, rest = left[more], at[more] + 8, rest[more] - 8
    for k in np.flatnonzero(size > WORD_BYTES):
        h[k] = int.from_bytes(hashlib.blake2b(data[starts[k] : ends[k]], digest_size=8).digest(), "little")
    return h


def _of_batch(texts: list[bytes]) -> list[np.ndarray]:
    buf = b"\n".join(texts)
    data = np.frombuffer(buf, np.uint8)
    edges = np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts])))
    inside = ~_SPACE[data]
    turn = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False])).astype(np.int8)))
    starts, ends = turn[::2], turn[1::2]
    word = word_hashes(data, starts, ends)
    first = np.searchsorted(starts, edges)
    n = len(word)
    joined = np.zeros(max(0, n - WORDS + 1), np.uint64)
    for k in range(WORDS):
        joined += _mixed(word[k : n - WORDS + 1 + k] + np.uint64(k + 1)) * np.uint64(_MIX[k])
    joined = _mixed(joined)
    out = []
    for a, b in zip(first[:-1], first[1:], strict=True):
        if b - a >= WORDS:
            out.append(np.unique(joined[a : b - WORDS + 1]))
        elif b > a:
            short = np.uint64(b - a)
            for k, h in enumerate(word[a:b]):
                short += _mixed(np.array([h + np.uint64(k + 1)]))[0] * np.uint64(_MIX[k])
            out.append(_mixed(np.array([short])))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def shingle_sets(texts: list[str | None]) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text, in order.

    A-Z are lower-cased and words are runs without space, tab, line feed, vertical tab, form feed or
    carriage return. A text of fewer than five words has its whole sequence as its one shingle; a null
    text or one without words has none.
    """
    held: list[bytes] = []
    size = 0
    with np.errstate(over="ignore"):
        for t in texts:
            raw = (t or "").encode("utf-8", "surrogatepass").lower()
            if held and size + len(raw) > BATCH_BYTES:
                yield from _of_batch(held)
                held, size = [], 0
            held.append(raw)
            size += len(raw) + 1
        if held:
            yield from _of_batch(held)


def required_overlap(a: int, b: int, percent: int = 75) -> int:
    """The least intersection of sets of a and b elements with 100 * intersection >= percent * union."""
    return -(-percent * (a + b) // (100 + percent))


def prefix_length(n: int, percent: int = 75) -> int:
    """How many of n elements, rarest first, must be indexed so that no partner can be missed."""
    return n - -(-percent * n // 100) + 1 if n else 0
