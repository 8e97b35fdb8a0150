"""Canonical records, digests and derived identities as column expressions."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Identity prefixes by kind, and how many hexadecimal digits follow them.
PREFIXES = {"page": "pg", "act": "act", "region": "rgn", "attempt": "att", "artifact": "art"}
DIGEST_CHARS = 16


def record(**fields: Column) -> Column:
    """A struct with its fields in key order; nest records for nested objects."""
    return F.struct(*(fields[k].alias(k) for k in sorted(fields)))


def canonical(value: Column) -> Column:
    """The one serialization of a record: compact JSON with its keys in order, nulls kept, text raw."""
    return F.to_json(value, {"ignoreNullFields": "false"})


def digest(value: Column) -> Column:
    return F.sha2(canonical(value), 256)


def text_digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def identity(kind: str, **bindings: Column) -> Column:
    """`prefix_` and 16 digits of the digest of a kind and its bindings."""
    bound = record(bindings=record(**bindings), kind=F.lit(kind))
    return F.concat(F.lit(PREFIXES[kind] + "_"), F.left(digest(bound), F.lit(DIGEST_CHARS)))


def self_hash(df: DataFrame, field: str = "self_hash") -> Column:
    """The digest of a whole row but for one field."""
    return digest(record(**{c: F.col(c) for c in df.columns if c != field}))


def digest_in_order(df: DataFrame, keys: list[str], order: list[str], line: str, opening: str = "", between: str = "\n", closing: str = "") -> DataFrame:
    """(keys, n, digest): sha256 of a group's lines in order, with what stands before, between and after them.

    A group's rows come sorted to a task, which hashes them as they pass: its memory doesn't grow with the group. A null
    line is passed over.
    """
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    rows = df.filter(F.col(line).isNotNull()).select(*keys, *order, F.col(line).alias("__line"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, h, n, out = None, None, 0, []

        def done() -> None:
            h.update(closing.encode())
            out.append((*key, n, h.hexdigest()))

        for batch in batches:
            for *now, text in zip(*(batch.column(c).to_pylist() for c in (*keys, "__line")), strict=True):
                if h is None or now != key:
                    if h is not None:
                        done()
                    key, n, h = now, 0, hashlib.sha256(opening.encode())
                h.update(((between if n else "") + text).encode("utf-8", "surrogatepass"))
                n += 1
        if h is not None:
            done()
        types = [batch.schema.field(c).type for c in keys] if out else [pa.null()] * len(keys)
        columns = [pa.array([r[k] for r in out], t) for k, t in enumerate([*types, pa.int64(), pa.string()])]
        if out:
            yield pa.RecordBatch.from_arrays(columns, [*keys, "n", "digest"])

    schema = ", ".join(f"`{k}` {kinds[k]}" for k in keys) + ", n long, digest string"
    return rows.repartition(*keys).sortWithinPartitions(*keys, *order).mapInArrow(run, schema)


def refuse_floats(schema: T.StructType, path: str = "$") -> list[str]:
    """The paths at which a schema holds a floating-point number, which canonical records may not."""

    def at(kind: T.DataType, where: str) -> list[str]:
        if isinstance(kind, (T.FloatType, T.DoubleType)):
            return [where]
        if isinstance(kind, T.ArrayType):
            return at(kind.elementType, where + "[]")
        if isinstance(kind, T.MapType):
            return at(kind.valueType, where + "{}")
        return [p for f in kind.fields for p in at(f.dataType, f"{where}.{f.name}")] if isinstance(kind, T.StructType) else []

    return at(schema, path)


def is_sha256(c: Column) -> Column:
    return c.rlike("^[0-9a-f]{64}\\z")


def is_identity(c: Column) -> Column:
    return c.rlike(f"^({'|'.join(PREFIXES.values())})_[0-9a-f]{{{DIGEST_CHARS}}}\\z")


def is_run_id(c: Column) -> Column:
    return c.rlike("^[a-z0-9][a-z0-9._-]{0,63}\\z")


def is_revision(c: Column) -> Column:
    return c.rlike("^[0-9a-f]{40}\\z")
