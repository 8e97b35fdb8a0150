"""Versioned attempts: latest of each subject, the checks of their history, and running budgets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest(df: DataFrame, keys: list[str], ordinal: str) -> DataFrame:
    """The row of greatest ordinal for each key, by one aggregation with map-side combining."""
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), ordinal).alias("row"))
    return best.select(*keys, *(F.col("row")[c].alias(c) for c in rest)).select(*df.columns)


def history_violations(df: DataFrame, keys: list[str], ordinal: str) -> DataFrame:
    """(keys, rule) where a subject's ordinals aren't exactly 1 to n: 'gap', 'duplicate' or 'start'."""
    seen = df.groupBy(*keys).agg(F.min(ordinal).alias("low"), F.max(ordinal).alias("high"), F.count("*").alias("n"), F.count_distinct(ordinal).alias("d"))
    rules = F.array_compact(F.array(F.when(F.col("low") != 1, "start"), F.when(F.col("n") != F.col("d"), "duplicate"), F.when(F.col("high") - F.col("low") + 1 != F.col("d"), "gap")))
    return seen.select(*keys, F.explode(rules).alias("rule"))


def next_ordinal(subjects: DataFrame, df: DataFrame, keys: list[str], ordinal: str) -> DataFrame:
    """(keys, next_ordinal): the one ordinal that may be appended to each subject, 1 where nothing was tried."""
    return subjects.select(*keys).distinct().join(df.groupBy(*keys).agg(F.max(ordinal).alias("high")), keys, "left").select(*keys, (F.coalesce("high", F.lit(0)) + 1).alias("next_ordinal"))


def appendable(proposed: DataFrame, df: DataFrame, keys: list[str], ordinal: str) -> DataFrame:
    """proposed with status: 'append' (next in line), 'rerun' (already there) or 'refuse' (leaves a gap)."""
    high = df.groupBy(*keys).agg(F.max(ordinal).alias("high"))
    given = F.coalesce("high", F.lit(0))
    status = F.when(F.col(ordinal) == given + 1, "append").when(F.col(ordinal).between(1, given), "rerun").otherwise("refuse")
    return proposed.join(high, keys, "left").withColumn("status", status).drop("high")


def currency(basis: DataFrame, df: DataFrame, keys: list[str], ordinal: str) -> DataFrame:
    """basis rows (keys, ordinal) with current: whether they still name the latest attempt."""
    now = df.groupBy(*keys).agg(F.max(ordinal).alias("now"))
    return basis.join(now, keys, "left").withColumn("current", F.coalesce(F.col(ordinal) == F.col("now"), F.lit(False))).drop("now")


def tally(df: DataFrame, keys: list[str], ordinal: str, outcome: str) -> DataFrame:
    """(keys, attempts, latest_outcome, failed): how often each was tried and what came of it."""
    return df.groupBy(*keys).agg(F.count("*").alias("attempts"), F.max_by(outcome, ordinal).alias("latest_outcome"), F.count_if(F.col(outcome) == "failed").alias("failed"))


def is_rereading(outcome: Column) -> Column:
    """The outcomes that are a reading of the source: text, or the finding that there is none."""
    return outcome.isin("read", "genuinely-empty")
