"""Contracts as data: a record that breaks one or more named rules gives a row for each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectern.functions.canonical import digest, digest_in_order, record


def violations(df: DataFrame, subject: list[str], rules: dict[str, Column]) -> DataFrame:
    """(subject, rule) for every rule whose condition doesn't hold; an unknown condition doesn't hold."""
    broken = F.array_compact(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), name) for name, ok in rules.items()]))
    return df.select(*subject, F.explode(broken).alias("rule"))


def required(df: DataFrame, subject: list[str], rules: dict[str, Column]) -> DataFrame:
    """df, whose evaluation fails at the first row that breaks a rule: the strict form of violations."""
    for name, ok in rules.items():
        told = F.concat(F.lit(name + ": "), F.concat_ws("/", *(F.col(c).cast("string") for c in subject)))
        df = df.filter(F.when(F.coalesce(ok, F.lit(False)), F.lit(True)).otherwise(F.raise_error(told).cast("boolean")))
    return df


def first_failure(rules: list[tuple[str, Column]], otherwise: str | None = None) -> Column:
    """The name of the first condition that holds, in the order given."""
    out = F.when(rules[0][1], rules[0][0])
    for name, held in rules[1:]:
        out = out.when(held, name)
    return out.otherwise(otherwise) if otherwise else out


def forbidden_paths(schema: T.StructType, names: set[str], path: str = "$") -> list[str]:
    """Where a schema has a field of a forbidden name, at any depth."""

    def inside(kind: T.DataType, where: str) -> list[str]:
        if isinstance(kind, T.ArrayType):
            return inside(kind.elementType, where + "[]")
        if isinstance(kind, T.MapType):
            return inside(kind.valueType, where + "{}")
        return forbidden_paths(kind, names, where) if isinstance(kind, T.StructType) else []

    return [p for f in schema.fields for p in ([f"{path}.{f.name}"] if f.name in names else []) + inside(f.dataType, f"{path}.{f.name}")]


def chain(links: DataFrame, key: str, position: str, digest_column: str, previous: str) -> DataFrame:
    """(key, position, rule) where a record's `previous` isn't the digest of the record before it."""
    before = links.select(key, (F.col(position) + 1).alias(position), F.col(digest_column).alias("held"))
    joined = links.join(before, [key, position], "left")
    rule = F.when((F.col(position) > 0) & F.col("held").isNull(), "missing link").when((F.col(position) > 0) & ~F.col(previous).eqNullSafe(F.col("held")), "broken link")
    return joined.withColumn("rule", rule).filter("rule is not null").select(key, position, "rule")


def sealed(df: DataFrame, keys: list[str], order: str, fields: list[str]) -> DataFrame:
    """(keys, n, seal): the digest of a group's rows in order, by which a later reading can be compared."""
    line = digest(record(**{c: F.col(c) for c in [order, *fields]}))
    rows = df.select(*keys, order, line.alias("line"))
    return digest_in_order(rows, keys, [order], "line").withColumnRenamed("digest", "seal")


def paired(frames: dict[str, DataFrame], keys: list[str]) -> DataFrame:
    """(keys, <name> for each frame, verdict): which of several records exist for a key; 'paired' if all do."""
    out = None
    for name, df in frames.items():
        here = df.select(*keys).distinct().withColumn(name, F.lit(True))
        out = here if out is None else out.join(here, keys, "full")
    flags = [F.coalesce(F.col(n), F.lit(False)) for n in frames]
    every = flags[0]
    for f in flags[1:]:
        every = every & f
    return out.select(*keys, *(f.alias(n) for n, f in zip(frames, flags, strict=True)), F.when(every, "paired").otherwise("unpaired").alias("verdict"))


def within(start: Column, end: Column, length: Column) -> Column:
    """Whether a half-open span lies within a text."""
    return (start >= 0) & (start <= end) & (end <= length)


def spans_apart(spans: Column) -> Column:
    """Whether an array of (start, end) spans, taken by start, has no two that overlap."""
    ordered = F.array_sort(spans)
    n = F.size(ordered)
    return F.when(n < 2, F.lit(True)).otherwise(F.forall(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))), lambda k: F.get(ordered, k)["start"] >= F.get(ordered, k - 1)["end"]))
