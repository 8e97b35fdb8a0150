"""Token-ID output: flat unsigned integer files with 64-bit document offsets.

Documents are dealt by ranges of doc_id, so that the parts in order hold them in ascending doc_id. A
part is two files: `<name>.bin`, the ids of all its documents one after the other as little-endian
unsigned integers (16 bits where the vocabulary allows, else 32), and `<name>.idx`:

    8 bytes  b"tokidx01"
    u64      number of documents n
    u64      bytes of an id (2 or 4)
    u64 * n      doc_id (two's complement; a null one is the smallest 64-bit integer)
    u64 * (n+1)  offset, in ids, of each document within the part, and of the end

The base of a part is the prefix sum of the counts of the parts before it: one row for each part
goes to the driver. A part's files are written under a name of the task attempt's own, so an attempt
that died leaves nothing that is read.
"""

from __future__ import annotations

import functools
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm.batches import slices
from lectern.llm.byte_pairs import load
from lectern.llm.shared import durable, new_path, remove_path

MAGIC = b"tokidx01"
END_ID = 0
_HEAD = "<8sQQ"
_HEAD_BYTES = struct.calcsize(_HEAD)
_NULL_ID = -(1 << 63)
#: Bytes of text that are encoded at once, and that make a part. A row of each part goes to the driver.
SLICE_BYTES, PART_BYTES = 2 << 20, 256 << 20


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class Encoder:
    """Ids of whole texts by the tokenizers library: those of byte-level BPE are made for many texts at once."""

    def __init__(self, path: str):
        self._tokenizer, self.dtype, self._pairs = load(path)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after the other, numbers of ids of each) of an array of strings; a null is empty."""
        if self._pairs:
            return self._pairs.encode(texts)
        found = [e.ids for e in self._tokenizer.encode_batch_fast([t or "" for t in texts.to_pylist()], add_special_tokens=False)]
        return np.concatenate([np.zeros(0, self.dtype), *(np.array(f, self.dtype) for f in found)]), np.array([len(f) for f in found], np.int64)


@functools.lru_cache(maxsize=2)
def _encoder(path: str) -> Encoder:
    return Encoder(path)


def _filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    found, path = pafs.FileSystem.from_uri(uri)
    return (pafs.LocalFileSystem(use_mmap=True), path) if isinstance(found, pafs.LocalFileSystem) else (found, path)


def _writer(uri: str, tokenizer: str | None, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer or default_tokenizer())
        fs, path = _filesystem(uri)
        name, doc_ids, lengths, low, part = uuid.uuid4().hex, [], [], None, None
        for batch in slices(batches, SLICE_BYTES):
            if part is None:
                fs.create_dir(path, recursive=True)
                part, low = fs.open_output_stream(f"{path}/{name}.bin"), batch.column("place")[0].as_py()
            ids, number = encoder.encode(batch.column("text"))
            part.write(np.insert(ids, np.cumsum(number), encoder.dtype.type(end_id)).tobytes())
            lengths.append(number + 1)
            doc_ids.append(batch.column("doc_id").fill_null(_NULL_ID).to_numpy())
        if part is None:
            return
        part.close()
        offsets = np.cumsum(np.concatenate([np.zeros(1, np.int64), *lengths])).astype("<u8")
        with fs.open_output_stream(f"{path}/{name}.idx") as index:
            index.write(struct.pack(_HEAD, MAGIC, len(offsets) - 1, encoder.dtype.itemsize))
            index.write(np.concatenate(doc_ids).astype("<i8").tobytes())
            index.write(offsets.tobytes())
        yield pa.RecordBatch.from_arrays(
            [pa.array([low], pa.int64()), pa.array([name]), pa.array([len(offsets) - 1], pa.int64()), pa.array([int(offsets[-1])], pa.int64())],
            ["place", "name", "docs", "ids"],
        )

    return run


def write_token_files(docs: DataFrame, uri: str, tokenizer: str | None = None, end_id: int = END_ID, parts: int | None = None) -> DataFrame:
    """Writes docs (doc_id, text) under uri and returns the manifest: part, name, docs, ids, base.

    Every text is encoded whole and closed by end_id; a null or empty one is end_id alone. Null doc_ids
    come first, rows of one doc_id stay together in the order of their texts. There are as many parts as
    shuffle partitions, more where the texts are of more than PART_BYTES for each, or `parts`.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    n = parts or max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-(rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // PART_BYTES))
    rows = rows.repartitionByRange(n, "doc_id")
    rows = rows.withColumn("place", F.spark_partition_id().cast("long")).sortWithinPartitions("doc_id", "text")
    made = rows.mapInArrow(_writer(uri, tokenizer, end_id), "place long, name string, docs long, ids long").collect()  # a row for each part
    made.sort(key=lambda r: r["place"])
    bases = np.concatenate(([0], np.cumsum([r["ids"] for r in made]))).astype(int).tolist()
    table = [(k, r["name"], r["docs"], r["ids"], b) for k, (r, b) in enumerate(zip(made, bases, strict=False))]
    return spark.createDataFrame(table, "part int, name string, docs long, ids long, base long")


class TokenFile:
    """One part, both files memory-mapped where their store is local."""

    def __init__(self, uri: str, name: str):
        fs, path = _filesystem(uri)
        self._index = fs.open_input_file(f"{path}/{name}.idx")
        magic, self.docs, width = struct.unpack(_HEAD, self._index.read_at(_HEAD_BYTES, 0))
        if magic != MAGIC:
            raise ValueError(f"not a token index: {name}")
        self.dtype = np.dtype(f"<u{width}")
        self._data = fs.open_input_file(f"{path}/{name}.bin")

    def doc_ids(self, a: int, b: int) -> np.ndarray:
        """The doc_ids of the documents a to b."""
        return np.frombuffer(self._index.read_at(8 * (b - a), _HEAD_BYTES + 8 * a), "<i8")

    def offsets(self, a: int, b: int) -> np.ndarray:
        """Where the documents a to b begin; that of number `docs` is the end."""
        return np.frombuffer(self._index.read_at(8 * (b - a), _HEAD_BYTES + 8 * (self.docs + a)), "<u8").astype(np.int64)

    def ids(self, a: int, b: int) -> np.ndarray:
        """The ids at positions a to b within the part."""
        w = self.dtype.itemsize
        return np.frombuffer(self._data.read_at((b - a) * w, a * w), self.dtype)


def read_token_files(spark: SparkSession, uri: str, manifest: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, from the files alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, base in zip(batch.column("name").to_pylist(), batch.column("base").to_pylist(), strict=True):
                part = TokenFile(uri, name)
                for top in range(0, part.docs, 4096):
                    end = min(part.docs, top + 4096)
                    at = part.offsets(top, end + 1)
                    crc = [zlib.crc32(part.ids(a, b).astype("<u4").tobytes()) for a, b in zip(at[:-1], at[1:], strict=True)]
                    ids = part.doc_ids(top, end)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ids, mask=ids == _NULL_ID), pa.array(at[:-1] + base), pa.array(np.diff(at)), pa.array(crc, pa.int64())],
                        ["doc_id", "start", "n_tokens", "ids_crc32"],
                    )

    n = max(1, min(manifest.count(), int(spark.conf.get("spark.sql.shuffle.partitions"))))
    return manifest.select("name", "base").repartition(n).mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_report(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """The digest of the files that docs make; the files are removed once it is kept."""
    spark = docs.sparkSession
    uri = new_path(spark, "tokens")
    try:
        return durable(read_token_files(spark, uri, write_token_files(docs, uri, tokenizer)))
    finally:
        remove_path(spark, uri)
