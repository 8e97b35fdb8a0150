"""Append-only attempt logs as streams: replay, gaps, late witnesses, and the recovery loop."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def idempotent(stream: DataFrame, keys: list[str], event_time: str, delay: str) -> DataFrame:
    """A stream without repeated writes: equal keys within the watermark's delay count once."""
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(keys)


def _follow(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """The state holds a subject's highest ordinal: one number, however long its history."""
    high = state.get[0] if state.exists else 0
    rows = []
    for ordinal in sorted(o for batch in batches for o in batch["ordinal"]):
        if ordinal == high + 1:
            high, verdict = ordinal, "append"
        elif ordinal <= high:
            verdict = "rerun"
        else:
            verdict = "gap"
        rows.append((key[0], int(ordinal), verdict))
    state.update((int(high),))
    yield pd.DataFrame(rows, columns=["subject_id", "ordinal", "verdict"])


def follow_ordinals(stream: DataFrame) -> DataFrame:
    """(subject_id, ordinal, verdict) of each arriving attempt: 'append', 'rerun' or 'gap'."""
    return stream.select("subject_id", F.col("ordinal").cast("long").alias("ordinal")).groupBy("subject_id").applyInPandasWithState(
        _follow, "subject_id long, ordinal long, verdict string", "high long", "append", GroupStateTimeout.NoTimeout
    )


def windowed_outcomes(stream: DataFrame, event_time: str, width: str, delay: str) -> DataFrame:
    """(start, outcome, n) of attempts by event-time window; rows later than the delay are left out."""
    counted = stream.withWatermark(event_time, delay).groupBy(F.window(event_time, width).alias("w"), "outcome").agg(F.count("*").alias("n"))
    return counted.select(F.col("w.start").alias("start"), "outcome", "n")


def recover(pending: DataFrame, attempt: Callable[[DataFrame, int], DataFrame], keep: Callable[[DataFrame, int], DataFrame], cap: int = 3) -> tuple[DataFrame, int]:
    """Repeats attempts on what is pending, up to `cap` rounds; what is left, and the rounds that ran.

    attempt gives (subject_id, resolved) for the pending subjects. keep writes a round's remainder and
    reads it again, so that a round's plan doesn't hold those before it.
    """
    rounds = 0
    while rounds < cap and not pending.isEmpty():
        tried = attempt(pending, rounds + 1)
        pending = keep(pending.join(tried.filter("resolved").select("subject_id"), "subject_id", "left_anti"), rounds)
        rounds += 1
    return pending, rounds
