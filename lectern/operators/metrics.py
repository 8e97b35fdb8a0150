"""Micro-averaged metrics over experiment cells, their deltas, and exact integer statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The states of a candidate's output, and those that score as an empty text.
STATES = ("complete", "truncated", "no-readable-text", "refused", "missing", "unavailable", "malformed")


def rate(errors: Column, units: Column) -> Column:
    """errors over units; null where there are no units."""
    return F.try_divide(errors, units)


def aggregate(cells: DataFrame, keys: list[str]) -> DataFrame:
    """Sums of numerators and denominators over cells, counts of every state, and the two rates.

    cells: status, cer_errors, cer_units, wer_errors, wer_units, compared, departed, elapsed_ms, cost.
    Times and costs are summed as decimals, over the cells that have one.
    """
    total = lambda c: F.sum(c).alias(c)
    states = [F.count_if(F.col("status") == s).alias(s.replace("-", "_") + "_count") for s in STATES]
    out = cells.groupBy(*keys).agg(
        F.count("*").alias("cells"), *states, *(total(c) for c in ("cer_errors", "cer_units", "wer_errors", "wer_units", "compared", "departed")),
        F.count("elapsed_ms").alias("elapsed_observed"), F.coalesce(F.sum(F.col("elapsed_ms").cast("decimal(38,9)")), F.lit(0).cast("decimal(38,9)")).alias("elapsed_total"),
    )
    return out.withColumns({"cer": rate(F.col("cer_errors"), F.col("cer_units")), "wer": rate(F.col("wer_errors"), F.col("wer_units"))})


def condition_deltas(metrics: DataFrame, slot: str, value: str, conditions: list[str]) -> DataFrame:
    """(slot, <condition> - <first condition> for each other one, complete): deltas of a value by condition."""
    wide = metrics.groupBy(slot).pivot("condition", conditions).agg(F.first(value))
    base = conditions[0]
    whole = F.lit(True)
    for c in conditions:
        whole = whole & F.col(f"`{c}`").isNotNull()
    return wide.select(slot, *((F.col(f"`{c}`") - F.col(f"`{base}`")).alias(f"delta_{c}".replace("-", "_")) for c in conditions[1:]), whole.alias("complete"))


def advantages(deltas: DataFrame, slot: str, base: str, columns: list[str]) -> DataFrame:
    """Each slot's deltas less those of one base slot, whose row is broadcast."""
    own = deltas.filter(F.col(slot) == base).select(*(F.col(c).alias("base_" + c) for c in columns))
    return deltas.filter(F.col(slot) != base).join(F.broadcast(own.limit(1))).select(slot, *((F.col(c) - F.col("base_" + c)).alias("advantage_" + c) for c in columns))


def nearest_rank(df: DataFrame, keys: list[str], value: str, percent: int) -> DataFrame:
    """(keys, value): the nearest-rank percentile, by whole numbers, from counts of distinct values."""
    counts = df.groupBy(*keys, value).agg(F.count("*").alias("n"))
    upto = F.sum("n").over(Window.partitionBy(*keys).orderBy(value))
    every = F.sum("n").over(Window.partitionBy(*keys))
    ranked = counts.withColumns({"upto": upto, "rank": F.greatest(F.lit(1).cast("long"), F.call_function("div", every * percent + 99, F.lit(100)))})
    return ranked.filter("upto >= rank").groupBy(*keys).agg(F.min(value).alias(value))


def histogram_mode(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """(keys, mode, n, total, sum): the commonest whole number, the least of equally common ones."""
    counts = df.groupBy(*keys, value).agg(F.count("*").alias("n"))
    return counts.groupBy(*keys).agg(
        F.max_by(value, F.struct("n", F.negative(F.col(value)))).alias("mode"), F.max("n").alias("n"), F.sum("n").alias("total"), F.sum(F.col(value) * F.col("n")).alias("sum")
    )


def projected_cost(hourly: Column, seconds: Column) -> Column:
    """An hourly price over seconds, half cents up; exact decimals."""
    return F.round(hourly.cast("decimal(18,4)") * seconds.cast("decimal(18,0)") / F.lit(3600).cast("decimal(18,0)"), 2).cast("decimal(18,2)")


def edge_shortfall(wanted: Column, detected: Column, size: Column) -> Column:
    """What padding an edge needs, in basis points of the size, rounded up; none where it is covered."""
    gap = F.greatest(F.lit(0), detected - wanted)
    return F.call_function("div", gap * 10_000 + size - 1, size)
