"""Half-open intervals: islands, merging, subtraction, sessions and overlap joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: How many rows are drawn for each bound between ranges.
BOUND_ROWS = 20


def _ranged(df: DataFrame, keys: list[str], order: list[str]) -> tuple[DataFrame, DataFrame]:
    """The rows of df whose key spans several ranges of (keys, order), and all of them, with __part: the number of a row's range.

    The bounds are values of the rows, drawn once and fixed in the plan: a row's range follows from its own values, in whichever
    branch it is told. What repartitionByRange draws differs from branch to branch, once there are more rows than it samples.
    Only a key that a bound names lies on both sides of it.
    """
    columns = [*keys, *order]
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    own = F.struct(*(F.col(c).alias(f"c{k}") for k, c in enumerate(columns)))
    drawn = df.select(own.alias("own")).orderBy(F.rand()).limit(BOUND_ROWS * n)
    tiles = drawn.withColumn("tile", F.ntile(n).over(Window.orderBy("own"))).groupBy("tile").agg(F.min("own").alias("low")).filter("tile > 1")
    bounds = tiles.select(*(F.col(f"low.c{k}").cast("string") for k in range(len(columns)))).collect()
    if not bounds:
        return df.withColumn("__part", F.lit(0)).filter(F.lit(False)), df.withColumn("__part", F.lit(0))
    kinds = [f.dataType.simpleString() for f in df.select(*columns).schema.fields]
    value = lambda v, kind: "CAST(" + ("NULL" if v is None else f"CAST(X'{v.encode().hex()}' AS STRING)") + f" AS {kind})"
    row = lambda b, m: "named_struct(" + ", ".join(f"'c{k}', {value(b[k], kinds[k])}" for k in range(m)) + ")"
    held = F.expr("sort_array(array(" + ", ".join(row(b, len(columns)) for b in bounds) + "))")
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(len(bounds).bit_length()))])
    part = F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.get(held, at + step - 1) <= own, at + step).otherwise(at))
    part = F.when(F.spark_partition_id() >= 0, part)  # holds always, and keeps the optimizer from pushing all bounds below a union
    ranged = df.withColumn("__part", part)
    if not keys:
        return ranged, ranged
    named = F.struct(*(F.col(c).alias(f"c{k}") for k, c in enumerate(keys))).isin(*[F.expr(r) for r in sorted({row(b, len(keys)) for b in bounds})])
    return df.filter(named).withColumn("__part", part), ranged


def _carried(ranged: DataFrame, carried: DataFrame, keys: list[str]) -> DataFrame:
    """ranged with what the ranges before hold of a row's key, null for a key of one range; there are fewer than two rows for each bound."""
    small = carried.withColumnsRenamed({k: f"__key_{k}" for k in [*keys, "__part"]})
    same = [F.col(k).eqNullSafe(F.col(f"__key_{k}")) for k in [*keys, "__part"]]
    return ranged.join(F.broadcast(small), same, "left")


def lagged(df: DataFrame, keys: list[str], order: list[str], value: str, name: str) -> DataFrame:
    """df with the value of the row before, by order within keys; no task holds all rows of a key.

    A range's first row of a key gets the last value of the range before, of which there is a row for each range and key.
    """
    split, ranged = _ranged(df, keys, order)
    own = Window.partitionBy(*keys, "__part")
    ranged = ranged.withColumns({name: F.lag(value).over(own.orderBy(*order)), "__place": F.row_number().over(own.orderBy(*order))})
    lasts = split.groupBy(*keys, "__part").agg(F.max_by(value, F.struct(*order)).alias("__last"))
    carried = lasts.withColumn("__last", F.lag("__last").over(Window.partitionBy(*keys).orderBy("__part")))
    return _carried(ranged, carried, keys).withColumn(name, F.when(F.col("__place") == 1, F.col("__last")).otherwise(F.col(name))).select(*df.columns, name)


def ranked(df: DataFrame, keys: list[str], order: list[str], name: str) -> DataFrame:
    """df with a position from 1, by order within keys; no task holds all rows of a key."""
    split, ranged = _ranged(df, keys, order)
    ranged = ranged.withColumn(name, F.row_number().over(Window.partitionBy(*keys, "__part").orderBy(*order)))
    sizes = split.groupBy(*keys, "__part").agg(F.count("*").alias("__n"))
    before = sizes.withColumn("__base", F.sum("__n").over(Window.partitionBy(*keys).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)))
    return _carried(ranged, before, keys).withColumn(name, F.col(name) + F.coalesce("__base", F.lit(0).cast("long"))).select(*df.columns, name)


def running_sum(df: DataFrame, order: list[str], value: str, name: str) -> DataFrame:
    """df with the sum of a value up to each row, by a total order of all rows; the sums of whole ranges go to one task."""
    split, ranged = _ranged(df, [], order)
    upto = Window.partitionBy("__part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    ranged = ranged.withColumn(name, F.sum(value).over(upto))
    sums = split.groupBy("__part").agg(F.sum(value).alias("__n"))
    before = sums.withColumn("__base", F.sum("__n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)))
    return _carried(ranged, before, []).withColumn(name, F.col(name) + F.coalesce("__base", F.lit(0))).select(*df.columns, name)


def _islands(df: DataFrame, keys: list[str], starts_new: Column, order: list[str]) -> DataFrame:
    """df with island: a number that grows by one at each row that starts a new run."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__new", starts_new.cast("int")).withColumn("island", F.sum("__new").over(window.rowsBetween(Window.unboundedPreceding, 0))).drop("__new")


def with_sessions(df: DataFrame, keys: list[str], order: list[str], gap: int) -> DataFrame:
    """df (start, end) with island: a run breaks where a start lies more than gap after all ends so far."""
    window = Window.partitionBy(*keys).orderBy(*order)
    reach = F.max("end").over(window.rowsBetween(Window.unboundedPreceding, -1))
    return _islands(df, keys, F.coalesce(F.col("start") - reach > gap, F.lit(True)), order)


def merge(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """(keys, start, end): overlapping or touching intervals as one."""
    return with_sessions(df, keys, order, 0).groupBy(*keys, "island").agg(F.min("start").alias("start"), F.max("end").alias("end")).drop("island")


def gaps(merged: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, start, end) between consecutive merged intervals."""
    window = Window.partitionBy(*keys).orderBy("start")
    return merged.withColumn("until", F.lead("start").over(window)).filter("until > end").select(*keys, F.col("end").alias("start"), F.col("until").alias("end"))


def uncovered(length: Column, spans: Column) -> Column:
    """The half-open ranges of [0, length) that an array of (start, end) spans leaves open, in order."""
    clipped = F.array_sort(F.filter(F.transform(spans, lambda s: F.struct(F.greatest(s["start"], F.lit(0)).alias("start"), F.least(s["end"], length).alias("end"))), lambda s: s["start"] < s["end"]))
    first = F.struct(F.lit(0).cast("int").alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("open"))

    def step(state: Column, s: Column) -> Column:
        hole = F.when(s["start"] > state["at"], F.array(F.struct(state["at"].alias("start"), s["start"].alias("end")))).otherwise(F.array().cast("array<struct<start:int,end:int>>"))
        return F.struct(F.greatest(state["at"], s["end"]).alias("at"), F.concat(state["open"], hole).alias("open"))

    last = lambda s: F.when(s["at"] < length, F.concat(s["open"], F.array(F.struct(s["at"].alias("start"), length.alias("end"))))).otherwise(s["open"])
    return F.aggregate(clipped, first, step, last)


def positions_to_ranges(df: DataFrame, keys: list[str], position: str) -> DataFrame:
    """(keys, start, end) of runs of consecutive positions."""
    run = F.col(position) - F.row_number().over(Window.partitionBy(*keys).orderBy(position))
    return df.withColumn("run", run).groupBy(*keys, "run").agg(F.min(position).alias("start"), (F.max(position) + 1).alias("end")).drop("run")


def overlap_join(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, left_id, right_id, start, end): the common part of intervals that overlap.

    An equi-join on the keys with inequalities as residual, never a product of the two sides.
    """
    a = left.select(*keys, F.col("id").alias("left_id"), F.col("start").alias("a0"), F.col("end").alias("a1"))
    b = right.select(*keys, F.col("id").alias("right_id"), F.col("start").alias("b0"), F.col("end").alias("b1"))
    met = a.join(b, keys).filter((F.col("a0") < F.col("b1")) & (F.col("b0") < F.col("a1")))
    return met.select(*keys, "left_id", "right_id", F.greatest("a0", "b0").alias("start"), F.least("a1", "b1").alias("end"))


def narrowest_containing(spans: Column, start: Column, end: Column) -> Column:
    """The narrowest of the spans (start, end, class) that contain [start, end); ties by start, then class."""
    around = F.filter(spans, lambda s: (s["start"] <= start) & (s["end"] >= end))
    ranked = F.transform(around, lambda s: F.struct((s["end"] - s["start"]).alias("width"), s["start"].alias("start"), s["class"].alias("class"), s["end"].alias("end")))
    return F.array_min(ranked)
