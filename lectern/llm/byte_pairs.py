"""Byte-level BPE over many texts at once, in numpy and Arrow, with the ids of the tokenizers library.

The pre-tokens of a buffer of texts are told by the classes of its bytes; distinct ones are found by Arrow's
dictionary encoding, merged together, and their ids laid out in the order of the texts. A pre-token is a
byte range, so no Python object stands for a word.

Classes are known for ASCII and for the Latin letters U+00C0 to U+024F. What lies between two single spaces
and holds any other character goes to the library as one piece: a byte-level pre-tokenizer always parts a text
before a single space that stands between two characters other than white space, and merges don't cross such a
place. Texts with a special token go there whole, as do long pre-tokens.
"""

from __future__ import annotations

import json
import os

import numpy as np
import pyarrow as pa

from lectern.llm.packed import Places, Remembered, bytes_of, laid_out, pieces_of, starts_of

#: Longer pre-tokens aren't merged in columns but given to the library.
WIDE = 32
#: Pre-tokens merged at once, and those remembered from one call to the next.
TOGETHER, REMEMBERED = 20_000, 300_000

_SPACE, _LETTER, _DIGIT, _SIGN, _OTHER, _BLANK = range(6)  # _OTHER: unknown, no white space; _BLANK: unknown
_NONE = np.iinfo(np.int32).max


def _classes() -> np.ndarray:
    """The class of each byte; of first bytes of longer characters that of the character, where that is certain."""
    of = np.full(256, _OTHER, np.uint8)
    of[:128] = _SIGN
    of[[0x20, *range(9, 14)]] = _SPACE
    of[[*range(ord("a"), ord("z") + 1), *range(ord("A"), ord("Z") + 1)]] = _LETTER
    of[ord("0") : ord("9") + 1] = _DIGIT
    of[0x1C:0x20] = _BLANK  # separators, which not every library takes for signs
    of[[0xC2, 0xE1, 0xE2, 0xE3]] = _BLANK  # U+0080 to U+00BF, U+1000 to U+3FFF: some are white space
    of[0xC3:0xC9] = _LETTER  # U+00C0 to U+023F
    return of


_CLASS = _classes()


def byte_classes(data: np.ndarray) -> np.ndarray:
    """The class of each byte of UTF-8; all bytes of a character have one."""
    of = _CLASS[data]
    high = np.flatnonzero(data >= 0x80)
    if len(high):
        value = data[high]
        lead = value >= 0xC0
        at, first = high[lead], value[lead]
        second = data[np.minimum(at + 1, len(data) - 1)]
        kind = of[at]
        kind[(first == 0xC3) & ((second == 0x97) | (second == 0xB7))] = _OTHER  # the signs for times and division
        kind[(first == 0xC9) & (second < 0x90)] = _LETTER
        of[high] = np.repeat(kind, np.diff(np.concatenate((np.flatnonzero(lead), [len(high)]))))
    return of


def pre_tokens(data: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, strange) of the pre-tokens of texts that end before the bytes `stops`; strange ones are for the library."""
    n = len(data)
    of = byte_classes(data)
    begin = np.zeros(n + 1, bool)  # where a text begins
    begin[0] = True
    begin[stops] = True
    space = of == _SPACE
    blank = data == 0x20
    before = np.concatenate(([_SPACE], of[:-1])).astype(np.uint8)
    start = (of != before) | begin[:-1]
    # a run of white space gives its last character away, to be the next token's first if it is a blank
    last = space & ~np.concatenate((space[1:] & ~begin[1:-1], [False])) & ~begin[1:]
    start |= last
    after = np.flatnonzero(last & blank) + 1
    start[after] = False
    # an apostrophe that begins a token and some endings make a token of their own
    mark = np.flatnonzero((data == 0x27) & start)
    if len(mark):
        near = np.zeros((len(mark), 3), np.uint8)
        for k in range(3):
            at = mark + 1 + k
            inside = at < n
            for j in range(k + 1):
                inside &= ~begin[np.minimum(mark + 1 + j, n)]
            near[inside, k] = data[at[inside]]
        one = np.isin(near[:, 0], list(b"stmd"))
        two = np.zeros(len(mark), bool)
        for pair in (b"re", b"ve", b"ll"):
            two |= (near[:, 0] == pair[0]) & (near[:, 1] == pair[1])
        size = np.where(one, 2, np.where(two, 3, 0))
        mark, size = mark[size > 0], size[size > 0]
        start[mark + 1] = False
        on = mark + size
        on = on[on < n]
        # what follows an ending begins a token, but for the first of what a blank began already
        start[on[~space[on]]] = True
        start[on[space[on] & ~last[on]]] = True
    odd = (of == _OTHER) | (of == _BLANK)
    if not odd.any():
        at = np.flatnonzero(start)
        return at, np.zeros(len(at), bool)
    firm = ~space & (of != _BLANK)
    cut = blank & np.concatenate(([False], firm[:-1])) & np.concatenate((firm[1:], [False])) & ~begin[:-1] & ~begin[1:]
    cut |= begin[:-1]
    edge = np.flatnonzero(cut)
    inside = np.repeat(np.add.reduceat(odd, edge) > 0, np.diff(np.concatenate((edge, [n]))))
    at = np.flatnonzero(np.where(inside, cut, start))
    return at, inside[at]


class BytePairs:
    """Ids of whole texts by a tokenizer file of byte-level BPE. `fits` tells whether a file is such."""

    @staticmethod
    def fits(kind: dict) -> bool:
        before, model = kind.get("pre_tokenizer") or {}, kind.get("model") or {}
        odd = [k for k in ("unk_token", "continuing_subword_prefix", "end_of_word_suffix", "dropout", "fuse_unk", "byte_fallback", "ignore_merges") if model.get(k)]
        plain = all(not t.get(k) for t in kind.get("added_tokens") or [] for k in ("single_word", "lstrip", "rstrip"))
        level = before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space")
        return level and model.get("type") == "BPE" and not odd and plain and not any(kind.get(k) for k in ("normalizer", "truncation", "padding"))

    def __init__(self, path: str, tokenizer, dtype: np.dtype):
        from tokenizers import pre_tokenizers

        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        self._tokenizer, self._dtype = tokenizer, dtype
        self._special = [t.content.encode() for t in tokenizer.get_added_tokens_decoder().values()]
        vocab = model["vocab"]
        level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        # characters enough that every byte of UTF-8 occurs
        every = "".join(map(chr, [*range(0x800), *range(0x1000, 0xD000, 0x1000), 0xFFFD, *range(0x10000, 0x110000, 0x8000)]))
        shown = dict(zip(every.encode(), "".join(part for part, _ in level.pre_tokenize_str(every)), strict=True))
        #: ids of single bytes; those that no text of UTF-8 holds have none
        self._byte = np.array([vocab.get(shown.get(b, ""), -1) for b in range(256)], np.int64)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self._size = max(vocab.values()) + 1
        key = np.array([vocab[a] * self._size + vocab[b] for a, b in pairs], np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        order = np.argsort(key, kind="stable")
        first = np.concatenate(([True], key[order][1:] != key[order][:-1]))
        self._rank_of, self._made = np.append(order[first], _NONE).astype(np.int32), made
        self._pairs = Places(key[order][first].view(np.uint64))
        self._distinct = Remembered(self._fresh, REMEMBERED, WIDE, dtype)

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of the merge of each two symbols, _NONE where there is none."""
        return self._rank_of[self._pairs.find((left * self._size + right).view(np.uint64))]

    def _merged(self, data: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, numbers of ids) of pre-tokens of up to WIDE bytes, each merged by its lowest rank, leftmost first."""
        n, wide = len(start), int(size.max())
        place = np.arange(wide)
        inside = place[None, :] < size[:, None]
        symbol = np.full((n, wide + 1), -1, np.int64)
        symbol[:, :wide][inside] = self._byte[data[(start[:, None] + place)[inside]]]
        rank = np.full((n, wide), _NONE, np.int32)
        both = (place[None, :] + 1) < size[:, None]
        rank[both] = self._rank(symbol[:, :-1][both], symbol[:, 1:][both])
        follows = np.broadcast_to(np.arange(1, wide + 2), (n, wide + 1)).copy()
        leads = np.broadcast_to(np.arange(-1, wide), (n, wide + 1)).copy()
        row = np.arange(n)
        while len(row):
            at = rank[row].argmin(axis=1)
            low = rank[row, at]
            go = low < _NONE
            row, at, low = row[go], at[go], low[go]
            gone = follows[row, at]
            symbol[row, at] = self._made[low]
            symbol[row, gone] = -1
            rank[row, np.minimum(gone, wide - 1)] = _NONE  # a symbol that is gone is inside
            then = follows[row, gone]
            follows[row, at] = then
            leads[row, np.minimum(then, wide)] = at
            more = then < size[row]
            rank[row, at] = _NONE
            r, a, t = row[more], at[more], then[more]
            rank[r, a] = self._rank(symbol[r, a], symbol[r, t])
            prior = leads[row, at]
            more = prior >= 0
            r, p, a = row[more], prior[more], at[more]
            rank[r, p] = self._rank(symbol[r, p], symbol[r, a])
        held = symbol[:, :wide] >= 0
        return symbol[:, :wide][held].astype(self._dtype), held.sum(axis=1)

    def _library(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _fresh(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, numbers of ids) of distinct pre-tokens."""
        data, ends = bytes_of(words)
        start, size = ends[:-1], np.diff(ends)
        order = np.argsort(size, kind="stable")
        parts, numbers = [np.zeros(0, self._dtype)], np.zeros(len(words), np.int64)
        short = order[: np.searchsorted(size[order], WIDE, "right")]
        for top in range(0, len(short), TOGETHER):
            some = short[top : top + TOGETHER]
            ids, numbers[some] = self._merged(data, start[some], size[some])
            parts.append(ids)
        for k in order[len(short) :]:
            ids = self._library([data[start[k] : start[k] + size[k]].tobytes().decode()])[0]
            parts.append(np.array(ids, self._dtype))
            numbers[k] = len(ids)
        at = np.empty(len(words), np.int64)
        at[order] = starts_of(numbers[order])
        return laid_out(np.concatenate(parts), at, numbers), numbers

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after the other, numbers of ids of each) of an array of strings; a null is empty."""
        data, ends = bytes_of(texts.cast(pa.large_binary()))
        if not len(data):
            return np.zeros(0, self._dtype), np.zeros(len(texts), np.int64)
        raw = data.tobytes() if self._special else b""
        if any(s in raw for s in self._special):
            return self._around_special(texts, data, ends)
        start, strange = pre_tokens(data, ends[1:])
        words = pieces_of(data, start)
        if strange.any():
            odd = words.filter(pa.array(strange)).dictionary_encode()
            found = self._library([w.decode() for w in odd.dictionary.to_pylist()])
            plain = words.filter(pa.array(~strange)).dictionary_encode()
            ids, number = self._distinct(plain.dictionary)
            which = np.empty(len(words), np.int64)
            which[~strange] = plain.indices.to_numpy()
            which[strange] = odd.indices.to_numpy() + len(plain.dictionary)
            ids = np.concatenate([ids, *(np.array(f, self._dtype) for f in found)])
            number = np.concatenate([number, np.array([len(f) for f in found], np.int64)])
        else:
            coded = words.dictionary_encode()
            ids, number = self._distinct(coded.dictionary)
            which = coded.indices.to_numpy()
        at, each = starts_of(number), number[which]
        total = np.concatenate(([0], np.cumsum(each)))
        where = np.searchsorted(start, ends)  # a text's first token
        return laid_out(ids, at[which], each), np.diff(total[where])

    def _around_special(self, texts: pa.Array, data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Texts that hold a special token go to the library whole, the others together."""
        special = np.array([any(s in t for s in self._special) for t in (data[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:], strict=True))])
        ids, number = self.encode(texts.filter(pa.array(~special)))
        found = self._library(texts.filter(pa.array(special)).to_pylist())
        sizes = np.empty(len(texts), np.int64)
        sizes[~special], sizes[special] = number, [len(f) for f in found]
        at = np.empty(len(texts), np.int64)
        both = np.concatenate([number, np.array([len(f) for f in found], np.int64)])
        starts = starts_of(both)
        at[~special], at[special] = starts[: len(number)], starts[len(number) :]
        return laid_out(np.concatenate([ids, *(np.array(f, self._dtype) for f in found)]), at, sizes), sizes


def load(path: str):
    """(tokenizers' tokenizer, type of an id, BytePairs where the file is of that kind)."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a worker has one core
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    dtype = np.dtype("<u2" if tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else "<u4")
    with open(path, encoding="utf-8") as f:
        kind = json.load(f)
    return tokenizer, dtype, BytePairs(path, tokenizer, dtype) if BytePairs.fits(kind) else None
