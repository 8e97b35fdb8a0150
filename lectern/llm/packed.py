"""Ids of many pieces of text in flat arrays: distinct pieces are looked up or made once, then laid out in order."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def bytes_of(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets from 0) of an array of large binaries; nulls are empty."""
    array = array.fill_null(b"") if array.null_count else array
    ends = np.frombuffer(array.buffers()[1], np.int64)[array.offset : array.offset + len(array) + 1]
    if not len(array) or ends[-1] == ends[0]:
        return np.zeros(0, np.uint8), np.zeros(len(array) + 1, np.int64)
    return np.frombuffer(array.buffers()[2], np.uint8)[ends[0] : ends[-1]], ends - ends[0]


def pieces_of(data: np.ndarray, starts: np.ndarray) -> pa.Array:
    """The byte ranges that begin at starts and go on to the next one, without a copy."""
    bounds = np.concatenate((starts, [len(data)])).astype(np.int64)
    return pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(data)])


def starts_of(numbers: np.ndarray) -> np.ndarray:
    return np.cumsum(numbers) - numbers


def laid_out(ids: np.ndarray, at: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    """The ids at[k] to at[k] + numbers[k] of every k, one after the other."""
    stop = np.cumsum(numbers)
    total = int(stop[-1]) if len(stop) else 0
    return ids[np.repeat(at - (stop - numbers), numbers) + np.arange(total)]


class Remembered:
    """Ids of distinct pieces. make gives (ids, numbers of ids) of pieces that aren't remembered.

    Up to `most` pieces of up to `wide` bytes are remembered; where that would be too many, those of the last call
    alone stay.
    """

    def __init__(self, make: Callable[[pa.Array], tuple[np.ndarray, np.ndarray]], most: int, wide: int, dtype: np.dtype):
        self._make, self._most, self._wide = make, most, wide
        self._known = pa.array([], pa.large_binary())
        self._ids, self._numbers = np.zeros(0, dtype), np.zeros(0, np.int64)

    def __call__(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, numbers of ids) of an array of distinct pieces."""
        seen = pc.index_in(words, self._known).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64) if len(self._known) else np.full(len(words), -1, np.int64)
        old, new = np.flatnonzero(seen >= 0), np.flatnonzero(seen < 0)
        fresh = words.take(pa.array(new))
        made, numbers = self._make(fresh)
        at, number = np.empty(len(words), np.int64), np.empty(len(words), np.int64)
        at[old], number[old] = starts_of(self._numbers)[seen[old]], self._numbers[seen[old]]
        at[new], number[new] = starts_of(numbers) + len(self._ids), numbers
        ids = laid_out(np.concatenate([self._ids, made]), at, number)
        full = len(self._known) + len(new) > self._most
        keep = np.arange(len(words)) if full else new
        keep = keep[np.diff(bytes_of(words)[1])[keep] <= self._wide][: self._most]
        own = laid_out(ids, starts_of(number)[keep], number[keep])
        more = words.take(pa.array(keep))
        if full:
            self._known, self._ids, self._numbers = more, own, number[keep]
        elif len(keep):
            self._known = pa.concat_arrays([self._known, more])
            self._ids, self._numbers = np.concatenate([self._ids, own]), np.concatenate([self._numbers, number[keep]])
        return ids, number


class Places:
    """The place of each of a fixed set of 64-bit keys, by tables of which the first that had a free slot holds a key."""

    def __init__(self, keys: np.ndarray):
        self._tables, left, odd = [], np.arange(len(keys), dtype=np.int32), 0x9E3779B97F4A7C15
        while len(left):
            bits = max(4, len(left).bit_length() + 2)
            table = np.uint64(odd), np.uint64(64 - bits), np.zeros(1 << bits, np.uint64), np.full(1 << bits, -1, np.int32)
            slot = self._slots(keys[left], *table[:2])
            _, first = np.unique(slot, return_index=True)
            table[2][slot[first]], table[3][slot[first]] = keys[left[first]], left[first]
            self._tables.append(table)
            left = np.delete(left, first)
            odd = (odd * 0xD6E8FEB86659FD93 + 0x51ED270B) % (1 << 64) | 1

    @staticmethod
    def _slots(keys: np.ndarray, odd: np.uint64, shift: np.uint64) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((keys * odd) >> shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """For each key its place, or -1."""
        out = np.full(len(keys), -1, np.int32)
        for odd, shift, held, at in self._tables:
            slot = self._slots(keys, odd, shift)
            hit = (held[slot] == keys) & (at[slot] >= 0)
            out[hit] = at[slot[hit]]
        return out
