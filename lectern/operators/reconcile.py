"""Joins that reconcile two sides: every one-sided or disagreeing row is a named violation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def reconcile(left: DataFrame, right: DataFrame, keys: list[str], compared: list[str] = []) -> DataFrame:  # noqa: B006
    """(keys, status): 'agrees', 'differs' (in a compared column), 'left-only' or 'right-only'.

    A full join on the keys; nulls compare as equal.
    """
    a = left.select(*keys, F.struct(F.lit(1).alias("here"), *compared).alias("a"))
    b = right.select(*keys, F.struct(F.lit(1).alias("here"), *compared).alias("b"))
    status = F.when(F.col("b").isNull(), "left-only").when(F.col("a").isNull(), "right-only").when(F.col("a").eqNullSafe(F.col("b")), "agrees").otherwise("differs")
    return a.join(b, keys, "full").select(*keys, status.alias("status"))


def difference(expected: DataFrame, found: DataFrame) -> DataFrame:
    """Rows of either side that the other lacks, with side 'missing' or 'unexplained'; repeats count."""
    return expected.exceptAll(found).withColumn("side", F.lit("missing")).unionByName(found.exceptAll(expected).withColumn("side", F.lit("unexplained")))


def lineage_violations(refs: DataFrame, blobs: DataFrame) -> DataFrame:
    """(artifact_id, relative_path, rule) of references whose bytes are 'missing' or whose digest 'differs'."""
    held = blobs.select("relative_path", F.col("sha256").alias("actual"))
    joined = refs.join(held, "relative_path", "left")
    rule = F.when(F.col("actual").isNull(), "missing").when(F.col("actual") != F.col("sha256"), "differs")
    return joined.withColumn("rule", rule).filter("rule is not null").select("artifact_id", "relative_path", "rule")


def publish(proposed: DataFrame, stored: DataFrame, key: str, digest: str) -> DataFrame:
    """proposed with action: 'insert' (new key), 'reuse' (same bytes) or 'conflict' (other bytes under the key)."""
    held = stored.select(key, F.col(digest).alias("held"))
    action = F.when(F.col("held").isNull(), "insert").when(F.col("held") == F.col(digest), "reuse").otherwise("conflict")
    return proposed.join(held, key, "left").withColumn("action", action).drop("held")


def transfer(manifest: DataFrame, source: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """manifest (key, sha256) with action: 'verified' (the target holds these bytes), 'copy', 'copy again' (it holds others),
    or 'source changed' and 'source missing', which are refused. source and target hold key and content."""
    own, held = source.select(key, F.sha2("content", 256).alias("__own")), target.select(key, F.sha2("content", 256).alias("__held"))
    action = (
        F.when(F.col("__held") == F.col("sha256"), "verified").when(F.col("__own").isNull(), "source missing").when(F.col("__own") != F.col("sha256"), "source changed")
        .when(F.col("__held").isNull(), "copy").otherwise("copy again")
    )
    return manifest.join(own, key, "left").join(held, key, "left").withColumn("action", action).drop("__own", "__held")


def run_binding(asked: DataFrame, stored: DataFrame, key: str, facts: list[str]) -> DataFrame:
    """(key, action, differs): 'create' where no run is stored, 'resume' where every fact is as it was, else 'refuse' and the first that isn't."""
    held = stored.select(key, F.struct(*facts).alias("__held"))
    both = asked.join(held, key, "left")
    differs = F.coalesce(*[F.when(~F.col(f).eqNullSafe(F.col("__held")[f]), f) for f in facts])
    new = F.col("__held").isNull()
    return both.select(key, F.when(new, "create").when(differs.isNull(), "resume").otherwise("refuse").alias("action"), F.when(~new, differs).alias("differs"))


def pairwise(frames: dict[str, DataFrame], pairs: list[tuple[str, str]]) -> DataFrame:
    """Rows that one of two frames lacks, for each pair of names; see difference."""
    return union_all([difference(frames[a], frames[b]).withColumn("pair", F.lit(f"{a}/{b}")) for a, b in pairs])


def firewalled(salvage: DataFrame, acts: DataFrame, key: str) -> DataFrame:
    """salvage with rule 'leaks into the acts' where a row's key is an act's too; the two may share none."""
    known = acts.select(key).distinct().withColumn("__act", F.lit(True))
    return salvage.join(known, key, "left").withColumn("rule", F.when(F.col("__act"), "leaks into the acts")).drop("__act")


def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, n) of keys that occur more than once."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def claimed_twice(df: DataFrame, claim: str, owner: str) -> DataFrame:
    """(claim, owners) of claims that more than one owner makes."""
    return df.groupBy(claim).agg(F.count_distinct(owner).alias("owners")).filter("owners > 1")


def duplicate_groups(sources: DataFrame, digest: Column) -> DataFrame:
    """(digest, first_path, first_ordinal, copies, excess) of contents at two or more paths.

    sources has path and ordinal. Paths repeated under one digest are merged first.
    """
    paths = sources.select(digest.alias("digest"), "path", "ordinal").groupBy("digest", "path").agg(F.min("ordinal").alias("ordinal"))
    groups = paths.groupBy("digest").agg(F.min_by("path", "ordinal").alias("first_path"), F.min("ordinal").alias("first_ordinal"), F.count("*").alias("copies"))
    return groups.filter("copies >= 2").withColumn("excess", F.col("copies") - 1)


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def numbered(df: DataFrame, name: str, order: list[Column | str], within: list[str]) -> DataFrame:
    """df with a position from 1 within each group."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*within).orderBy(*order)))
