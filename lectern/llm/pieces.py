"""SentencePiece encoding and decoding by a max-plus parallel scan.

The segmentation of a text is the one of highest total piece score, as in the unigram reading of a
SentencePiece model: a space is written U+2581, one more stands in front of the text, a character that no
piece covers costs the least piece score less ten and is spelt in byte pieces. Of equal totals, the one
whose last piece is longest wins, then whose last but one is longest, and so on.

A text of more than GIANT characters is split into chunks, which tasks work on at once. The state at a
chunk's edge is how many characters of the next chunk the last piece reaches into, so a chunk is a matrix
of scores from entry to exit state. Matrices combine associatively under (max, +): groups of FAN neighbours are
multiplied by tasks of their own, level by level, and the scores of the states at every edge come back down
the same tree. Given those, each chunk is backtraced by itself, for each exit state. Which one the end of the
document leads back to is a scan of the same kind from the other side, over matrices of 0 and minus infinity.

Where no piece holds U+2581 after another character, segmentations of words are independent: in other texts
the distinct words of a batch are segmented together by the same recurrence, a column of all words at a
time, and frequent words are kept. A model with such a piece has its texts segmented whole; one that changes
texts before it cuts them is refused.

The model file at hand is typed BPE. Merging pairs in rank order isn't a sum over a segmentation and has
no max-plus form, so its pieces and scores are read as a unigram model's. Decoding is the library's.
"""

from __future__ import annotations

import functools
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

from lectern.llm.batches import slices, widened
from lectern.llm.packed import Places, Remembered, bytes_of, laid_out, pieces_of, starts_of
from lectern.llm.shared import Scratch, durable, scratch

GIANT, CHUNK = 65_536, 16_384
FAN = 32  # neighbouring matrices that a task combines
SLICE_BYTES = 2 << 20  # of texts that are encoded at once
REMEMBERED, WORD_BYTES = 300_000, 40  # words remembered from one slice to the next
TOGETHER, TOGETHER_CHARS = 40_000, 48  # characters segmented at once, about, and those of the longest word among them
MARK = "▁"
_LOW = -1e300
_BYTE = re.compile(r"<0x([0-9A-F]{2})>")


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Pieces:
    """A model's pieces: exact segmentation, transfer matrices, and decoding."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        sp = SentencePieceProcessor(model_file=path)
        self.scores: dict[str, tuple[float, int]] = {}
        self.bytes_of: list[bytes] = []
        self.byte_ids = [sp.unk_id()] * 256
        for i in range(sp.get_piece_size()):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                value = int(_BYTE.fullmatch(piece)[1], 16)
                self.byte_ids[value] = i
                self.bytes_of.append(bytes([value]))
            elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
                self.bytes_of.append(b"")
            else:
                self.scores[piece] = (sp.get_score(i), i)
                self.bytes_of.append(piece.replace(MARK, " ").encode())
        probe = " a  ﬁ\tＡ\n "
        if sp.normalize(probe) != written(probe):
            raise ValueError(f"{path} normalises texts")
        self.by_words = not any(MARK in p.lstrip(MARK) for p in self.scores)
        self.longest = max(map(len, self.scores))
        self.starts = {p[:k] for p in self.scores for k in range(1, len(p) + 1)}
        self.unknown = min(s for s, _ in self.scores.values()) - 10.0
        keys = np.array([_hash(p) for p in self.starts], np.uint64)
        if len(np.unique(keys)) < len(keys):
            raise ValueError("two beginnings of pieces share a hash")
        found = [self.scores.get(p, (-np.inf, -2)) for p in self.starts]
        self._prefixes = Places(keys)
        self._scores = np.array([f[0] for f in found])
        self._ids = np.array([f[1] for f in found], np.int32)
        self._flat = np.frombuffer(b"".join(self.bytes_of), np.uint8)
        self._sizes = np.array([len(b) for b in self.bytes_of], np.int64)
        self._places = starts_of(self._sizes)
        self._words = Remembered(self._fresh, REMEMBERED, WORD_BYTES, np.dtype("<i4"))

    def matches(self, text: str, at: int) -> Iterator[tuple[int, float, int]]:
        """(length, score, id or -1) of the pieces at a place, shorter ones first."""
        if text[at] not in self.scores:
            yield 1, self.unknown, -1
        for n in range(1, self.longest + 1):
            part = text[at : at + n]
            if len(part) < n or part not in self.starts:
                return
            if part in self.scores:
                yield (n, *self.scores[part])

    def transfer(self, text: str, size: int) -> np.ndarray:
        """[entry, exit] best scores over a chunk of size characters, with the characters that follow it in text."""
        width = self.longest
        best = np.full((len(text) + width, width), _LOW)
        best[np.arange(min(width, len(text) + 1)), np.arange(min(width, len(text) + 1))] = 0.0
        for at in range(size):
            own = best[at]
            if own.max() > _LOW / 2:
                for n, score, _ in self.matches(text, at):
                    np.maximum(best[at + n], own + score, out=best[at + n])
        return best[size : size + width].T.copy()

    def backtraces(self, text: str, size: int, entry: np.ndarray) -> dict[int, tuple[int, list[int]]]:
        """For each exit state that can be reached: its entry state and the ids of the pieces between."""
        n = len(text)
        best, back = [_LOW] * (n + self.longest + 1), [None] * (n + self.longest + 1)
        for state, score in enumerate(entry.tolist()):
            if score > _LOW / 2 and state <= n:
                best[state] = score
        for at in range(size):
            own = best[at]
            if own > _LOW / 2:
                for k, score, i in self.matches(text, at):
                    if own + score > best[at + k]:  # the first to reach a place is the longest piece
                        best[at + k], back[at + k] = own + score, (at, i)
        out = {}
        for state in range(self.longest):
            at, ids = size + state, []
            if best[at] <= _LOW / 2 or (at <= n and back[at] is None and at >= self.longest) or at > n:
                continue
            while back[at] is not None:
                start, i = back[at]
                ids += [i] if i >= 0 else [self.byte_ids[b] for b in reversed(text[start].encode("utf-8", "surrogatepass"))]
                at = start
            out[state] = (at, ids[::-1])
        return out

    def segment(self, text: str) -> list[int]:
        """The ids of a text written with U+2581, in exact arithmetic."""
        if not text:
            return []
        entry = np.full(self.longest, _LOW)
        entry[0] = 0.0
        return self.backtraces(text, len(text), entry)[0][1]

    def _fresh(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, numbers of ids) of words, each of which is written with the space before it."""
        data, ends = bytes_of(words)
        text = data.tobytes().decode("utf-8", "surrogatepass")
        code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).copy()
        code[code == 0x20] = ord(MARK)
        bounds = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))[ends]
        start, size = bounds[:-1], np.diff(bounds)
        order = np.argsort(size, kind="stable")
        parts, numbers, done, at = [np.zeros(0, "<i4")], np.zeros(len(words), np.int64), [np.zeros(0, np.int64)], 0
        short = int(np.searchsorted(size[order], TOGETHER_CHARS, "right"))
        while at < short:
            some = order[at : min(short, at + TOGETHER // int(size[order[at]]))]
            some = some[: max(1, TOGETHER // int(size[some[-1]]))]
            at += len(some)
            wide = int(size[some[-1]])
            place = start[some][:, None] + np.arange(wide)
            ids, number, whole = self.together(np.where(np.arange(wide) < size[some][:, None], code[np.minimum(place, len(code) - 1)], 0), size[some])
            parts.append(ids)
            numbers[some[whole]] = number
            done.append(some[whole])
        odd = np.ones(len(words), bool)
        odd[np.concatenate(done)] = False
        for k in np.flatnonzero(odd):
            ids = self.segment(code[start[k] : start[k] + size[k]].tobytes().decode("utf-32-le", "surrogatepass"))
            parts.append(np.array(ids, "<i4"))
            numbers[k] = len(ids)
        done = np.concatenate([*done, np.flatnonzero(odd)])
        places = np.empty(len(words), np.int64)
        places[done] = starts_of(numbers[done])
        return laid_out(np.concatenate(parts), places, numbers), numbers

    def together(self, code: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """segment() of short words at once, rows of characters: (ids, numbers of ids, which words) of those in which no
        character has to be spelt in several bytes."""
        n, wide = code.shape
        reach = min(self.longest, wide)
        score = np.full((reach + 1, n, wide), -np.inf)
        ids = np.full((reach + 1, n, wide), -2, np.int32)
        word, place = np.nonzero(np.arange(wide)[None, :] < size[:, None])
        one = code[word, place]
        score[1][word, place] = self.unknown
        ids[1][word, place] = np.where(one < 128, np.array(self.byte_ids, np.int32)[np.minimum(one, 255)], -2)
        h = np.zeros(len(word), np.uint64)
        with np.errstate(over="ignore"):
            for k in range(1, reach + 1):
                h = _step(h, code[word, place + k - 1])
                at = self._prefixes.find(h)
                alive = at >= 0
                word, place, h, at = word[alive], place[alive], h[alive], at[alive]
                piece = self._ids[at] >= 0
                score[k][word[piece], place[piece]] = self._scores[at[piece]]
                ids[k][word[piece], place[piece]] = self._ids[at[piece]]
                on = place + k < size[word]
                word, place, h = word[on], place[on], h[on]
        best, back = np.full((wide + 1, n), -np.inf), np.zeros((wide + 1, n), np.int32)
        best[0] = 0.0
        for end in range(1, wide + 1):
            for k in range(min(reach, end), 0, -1):  # longer last pieces first
                total = best[end - k] + score[k][:, end - k]
                better = total > best[end]
                best[end][better] = total[better]
                back[end][better] = k
        out, rows, end = np.full((n, wide), -1, np.int32), np.arange(n), size.copy()
        for column in range(wide - 1, -1, -1):
            left = np.flatnonzero(end > 0)
            if not len(left):
                break
            k = back[end[left], rows[left]]
            end[left] -= k
            out[left, column] = ids[k, left, end[left]]
        whole = ~(out == -2).any(axis=1)
        used = (out != -1) & whole[:, None]
        return out[used].astype("<i4"), used.sum(axis=1)[whole], np.flatnonzero(whole)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after the other, numbers of ids of each) of an array of strings; none for a null or empty one."""
        full = spaced(texts)
        data, ends = bytes_of(full)
        if not len(data):
            return np.zeros(0, "<i4"), np.zeros(len(texts), np.int64)
        begin = np.zeros(len(data) + 1, bool)
        begin[ends[1:]] = True
        begin[ends[:-1]] = True
        if self.by_words:  # a word begins with a space that no other goes before
            blank = data == 0x20
            begin[1:-1] |= blank[1:] & ~blank[:-1]
        start = np.flatnonzero(begin[:-1])
        words = pieces_of(data, start).dictionary_encode()
        ids, numbers = self._words(words.dictionary)
        which = words.indices.to_numpy()
        each = numbers[which]
        total = np.concatenate(([0], np.cumsum(each)))
        return laid_out(ids, starts_of(numbers)[which], each), np.diff(total[np.searchsorted(start, ends)])

    def spelt(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of pieces, one after the other."""
        return laid_out(self._flat, self._places[ids], self._sizes[ids])

    def decode(self, ids: list[int] | np.ndarray) -> str:
        """The text of ids; the space in front, which encoding adds, is taken off."""
        return self.spelt(np.asarray(ids, np.int64)).tobytes().removeprefix(b" ").decode("utf-8", "replace")


def spaced(texts: pa.Array) -> pa.Array:
    """Texts as they are cut: with a space in front of those that aren't empty, U+2581 taken for one; nulls are empty."""
    texts = pc.replace_substring(texts.cast(pa.large_string()).fill_null(""), MARK, " ")
    front = pa.array(np.where(pc.equal(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), "", " "), pa.large_string())
    return pc.binary_join_element_wise(front, texts, pa.scalar("", pa.large_string())).cast(pa.large_binary())


def _step(h, code):
    """The hash of a string and one more character; over arrays of hashes and characters alike."""
    h = (h + code + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(31))


def _hash(text: str) -> np.uint64:
    h = np.zeros(1, np.uint64)
    for c in text:
        h = _step(h, np.uint64(ord(c)))
    return h[0]


def written(text: str) -> str:
    return MARK + text.replace(" ", MARK)


@functools.lru_cache(maxsize=2)
def _pieces(path: str) -> Pieces:
    return Pieces(path)


def _chunks(batches: Iterator[pa.RecordBatch], reach: int) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        for row, text in zip(batch.column("row").to_pylist(), batch.column("text").to_pylist(), strict=True):
            text = written(text)
            for k, at in enumerate(range(0, len(text), CHUNK)):
                part = text[at : at + CHUNK + reach]
                columns = [pa.array([row], pa.int64()), pa.array([k], pa.int32()), pa.array([min(CHUNK, len(text) - at)], pa.int32()), pa.array([at + CHUNK >= len(text)]), pa.array([part])]
                yield pa.RecordBatch.from_arrays(columns, ["row", "k", "size", "last", "part"])


def _giant_ids(giant: DataFrame, model: str | None, place: Scratch) -> DataFrame:
    """(row, ids) of giant texts, packed, by the scan over their chunks."""
    spark = giant.sparkSession

    def cut(batches):
        yield from _chunks(batches, _pieces(model or default_model()).longest - 1)

    def matrices(batches):
        pieces = _pieces(model or default_model())
        for batch in slices(batches):
            made = [pieces.transfer(p, n).tobytes() for p, n in zip(batch.column("part").to_pylist(), batch.column("size").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("k"), pa.array(made, pa.binary())], ["row", "k", "matrix"])

    def traced(batches):
        pieces = _pieces(model or default_model())
        for batch in slices(batches):
            steps, parts = [], []
            for size, last, part, entry in zip(*(batch.column(c).to_pylist() for c in ("size", "last", "part", "state")), strict=True):
                found = pieces.backtraces(part, size, np.frombuffer(entry))
                found = [found.get(s) if s == 0 or not last else None for s in range(pieces.longest)]
                steps.append([f[0] if f else -1 for f in found])
                parts.append([np.array(f[1], "<i4").tobytes() if f else None for f in found])
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("k"), pa.array(steps, pa.list_(pa.int32())), pa.array(parts, pa.list_(pa.binary()))], ["row", "k", "steps", "parts"])

    def backward(batches):
        for batch in batches:
            steps = np.array(batch.column("steps").to_pylist(), np.int64).reshape(batch.num_rows, -1)
            made = np.full((*steps.shape, steps.shape[1]), _LOW)
            at, exit_ = np.nonzero(steps >= 0)
            made[at, exit_, steps[at, exit_]] = 0.0
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("k"), pa.array([m.tobytes() for m in made], pa.binary())], ["row", "k", "matrix"])

    def chosen(batches):
        for batch in batches:
            exits = [int(np.frombuffer(s).argmax()) for s in batch.column("state").to_pylist()]
            ids = [p[e] for p, e in zip(batch.column("parts").to_pylist(), exits, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("k"), pa.array(ids, pa.binary())], ["row", "k", "ids"])

    def joined(table: pa.Table) -> pa.Table:
        table = table.sort_by("k")
        return pa.table({"row": table.column("row").slice(0, 1), "ids": pa.array([b"".join(table.column("ids").to_pylist())], pa.binary())})

    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    chunks = place.table(giant.mapInArrow(cut, "row long, k int, size int, last boolean, part string").repartition(n, "row", "k"), "chunks")
    last = chunks.agg(F.max("k")).first()[0] or 0
    moved = chunks.repartition(n, "row", "k")
    forward = place.table(moved.mapInArrow(matrices, _MATRIX), "forward")
    traces = moved.join(_scan(forward, last, place, "forward"), ["row", "k"]).mapInArrow(traced, "row long, k int, steps array<int>, parts array<binary>")
    traces = place.table(traces, "traces")
    turned = traces.select("row", (F.lit(last) - F.col("k")).alias("k"), "steps").mapInArrow(backward, _MATRIX)
    exits = _scan(place.table(turned, "backward"), last, place, "backward").withColumn("k", F.lit(last) - F.col("k"))
    ids = traces.join(exits, ["row", "k"]).select("row", "k", "parts", "state").mapInArrow(chosen, "row long, k int, ids binary")
    return ids.groupBy("row").applyInArrow(joined, "row long, ids binary")


_MATRIX = "row long, k int, matrix binary"


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The max-plus product of a matrix, or a vector of states, and a matrix."""
    out = (a[..., :, None] + b).max(axis=-2)
    out[out < _LOW / 2] = _LOW
    return out


def _square(raw: bytes) -> np.ndarray:
    m = np.frombuffer(raw)
    return m.reshape(int(np.sqrt(len(m))), -1)


def _product(table: pa.Table) -> pa.Table:
    """The product of a group of neighbouring matrices, under the group's number."""
    first, *rest = [_square(m) for m in table.sort_by("k").column("matrix").to_pylist()]
    return pa.table({"row": table.column("row").slice(0, 1), "k": table.column("part").slice(0, 1), "matrix": pa.array([functools.reduce(times, rest, first).tobytes()], pa.binary())})


def _entries(table: pa.Table) -> pa.Table:
    """The states before each of a group of neighbours, from those before the group: null stands for the text's beginning."""
    table = table.sort_by("k")
    states = []
    for raw in table.column("matrix").to_pylist():
        matrix = _square(raw)
        if not states:
            begin = table.column("state")[0].as_py()
            state = np.where(np.arange(len(matrix)) == 0, 0.0, _LOW) if begin is None else np.frombuffer(begin)
        states.append(state.tobytes())
        state = times(state, matrix)
    return pa.table({"row": table.column("row"), "k": table.column("k"), "state": pa.array(states, pa.binary())})


def _scan(matrices: DataFrame, last: int, place: Scratch, name: str) -> DataFrame:
    """(row, k, state): the best scores of the states before each matrix (row, k, matrix; k up to last) of a row."""
    levels = [matrices]
    while last >= FAN:
        up = levels[-1].withColumn("part", F.expr(f"k div {FAN}").cast("int")).groupBy("row", "part").applyInArrow(_product, _MATRIX)
        levels.append(place.table(up, f"{name}{len(levels)}"))
        last //= FAN
    top = levels.pop().withColumn("state", F.lit(None).cast("binary"))
    found = top.groupBy("row").applyInArrow(_entries, "row long, k int, state binary")
    while levels:
        known = found.withColumnRenamed("k", "part")
        below = levels.pop().withColumn("part", F.expr(f"k div {FAN}").cast("int")).join(known, ["row", "part"])
        found = below.groupBy("row", "part").applyInArrow(_entries, "row long, k int, state binary")
    return found


def encode(docs: DataFrame, model: str | None = None, then: Callable[[pa.RecordBatch], pa.RecordBatch] | None = None, schema: StructType | None = None) -> DataFrame:
    """docs with token_ids (packed little-endian 32-bit) added; a column of that name is replaced.

    Every row gets the ids of its whole text: none for a null or empty one. Rows may repeat. `then` turns
    the batches of that into those of `schema`, in the same worker.
    """
    docs = docs.drop("token_ids")
    columns = docs.columns
    finish = then or (lambda batch: batch)
    result = schema or widened(docs.schema, token_ids="binary")

    def direct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _pieces(model or default_model())
        for batch in slices(batches, SLICE_BYTES):
            flat, numbers = pieces.encode(batch.column("text"))
            ends = np.concatenate(([0], np.cumsum(numbers) * 4)).astype(np.int32)
            ids = pa.Array.from_buffers(pa.binary(), len(numbers), [None, pa.py_buffer(ends), pa.py_buffer(flat)])
            yield finish(pa.RecordBatch.from_arrays([*batch.columns, ids], [*batch.schema.names, "token_ids"]))

    large = F.coalesce(F.length("text") > GIANT, F.lit(False))
    normal = docs.filter(~large).mapInArrow(direct, result)
    giant = durable(docs.filter(large).select(F.monotonically_increasing_id().alias("row"), F.struct(*columns).alias("doc")))
    with scratch(docs.sparkSession) as place:
        ids = durable(_giant_ids(giant.select("row", F.col("doc")["text"].alias("text")), model, place))
    long = giant.join(ids, "row").select(*(F.col("doc")[c].alias(c) for c in columns), F.col("ids").alias("token_ids"))
    return normal.unionByName(long.mapInArrow(lambda batches: map(finish, slices(batches)), result) if then else long)


def decode(encoded: DataFrame, model: str | None = None, into: str = "decoded") -> DataFrame:
    """encoded with the text of token_ids added; a column of that name is replaced. Null ids give a null text."""
    encoded = encoded.drop(into)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _pieces(model or default_model())
        for batch in slices(batches):
            texts = [None if raw is None else pieces.decode(np.frombuffer(raw, "<i4")) for raw in batch.column("token_ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, into])

    return encoded.mapInArrow(run, widened(encoded.schema, **{into: "string"}))


def encode_lists(docs: DataFrame, model: str | None = None) -> DataFrame:
    """docs with token_ids as an array of integers; a column of that name is replaced."""
    docs = docs.drop("token_ids")

    def lists(batch: pa.RecordBatch) -> pa.RecordBatch:
        raw, ends = bytes_of(batch.column("token_ids").cast(pa.large_binary()))
        ids = pa.ListArray.from_arrays(pa.array((ends // 4).astype(np.int32)), pa.array(np.frombuffer(raw, "<i4")))
        return batch.set_column(batch.num_columns - 1, "token_ids", ids)

    return encode(docs, model, lists, StructType([*docs.schema.fields, StructField("token_ids", ArrayType(IntegerType()))]))


def piece_report(docs: DataFrame, model: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_crc32 (of the ids as little-endian 32-bit integers) and whether decoding gives the text back.

    U+2581 in a text is decoded as the space that it stands for, and compared so.
    """
    docs = docs.select("doc_id", "text")

    def report(batch: pa.RecordBatch) -> pa.RecordBatch:
        pieces = _pieces(model or default_model())
        raw, ends = bytes_of(batch.column("token_ids").cast(pa.large_binary()))
        ids, at = np.frombuffer(raw, "<i4"), ends // 4
        # what the ids spell against what was cut, all texts of the batch at once
        told, (want, bounds) = pieces.spelt(ids), bytes_of(spaced(batch.column("text")))
        size = np.concatenate(([0], np.cumsum(pieces._sizes[ids])))[at]
        same = np.diff(size) == np.diff(bounds)
        if same.all():
            wrong = np.concatenate(([0], np.cumsum(told != want)))
            same = wrong[bounds[1:]] == wrong[bounds[:-1]]
        else:
            same = np.array([told[size[k] : size[k + 1]].tobytes() == want[bounds[k] : bounds[k + 1]].tobytes() for k in range(batch.num_rows)], bool)
        crc = [zlib.crc32(raw[a:b]) for a, b in zip(ends[:-1], ends[1:], strict=True)]
        columns = [batch.column("doc_id"), pa.array(np.diff(at)), pa.array(crc, pa.int64()), pa.array(same, pa.bool_())]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids_crc32", "round_trip"])

    schema = widened(StructType([docs.schema["doc_id"]]), n_tokens="long", ids_crc32="long", round_trip="boolean")
    return encode(docs, model, report, schema)
