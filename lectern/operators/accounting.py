"""Closed vocabularies and total accounting: every unit ends in exactly one category, every shortfall has a reason."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed values: (stage, outcome, class, terminal category or None where a later stage decides).
ALGEBRA = [
    ("door", "admitted", "completed", None),
    ("door", "refused", "failed", "refused-with-reason"),
    ("exemplar", "sealed", "completed", None),
    ("exemplar", "refused", "failed", "refused-with-reason"),
    ("designator", "proposed", "completed", None),
    ("designator", "excluded", "completed", "excluded-with-approval"),
    ("designator", "held", "unresolved", "held-for-review"),
    ("designator", "failed", "failed", "refused-with-reason"),
    ("attestatores", "read", "completed", None),
    ("attestatores", "genuinely-empty", "completed", None),
    ("attestatores", "failed", "failed", None),
    ("attestatores", "dead", "failed", None),
    ("attestatores", "not-run", "unresolved", None),
    ("attestatores", "excluded", "completed", None),
    ("perlector", "read", "completed", None),
    ("perlector", "no-readable-text", "unresolved", None),
    ("perlector", "truncated", "failed", None),
    ("perlector", "failed", "failed", None),
    ("perlector", "not-run", "unresolved", None),
    ("recensor", "accepted", "completed", None),
    ("recensor", "recovery-requested", "unresolved", None),
    ("recensor", "confirmed-blank", "completed", "confirmed-blank"),
    ("recensor", "held-for-review", "unresolved", "held-for-review"),
    ("recensor", "failed", "failed", "refused-with-reason"),
    ("archetypus", "established", "completed", "delivered"),
    ("archetypus", "refused", "failed", "refused-with-reason"),
    ("armarium", "delivered", "completed", "delivered"),
    ("armarium", "held-for-review", "unresolved", "held-for-review"),
    ("armarium", "excluded-with-approval", "completed", "excluded-with-approval"),
    ("armarium", "confirmed-blank", "completed", "confirmed-blank"),
    ("armarium", "refused-with-reason", "failed", "refused-with-reason"),
]
CLASSES = ("completed", "unresolved", "failed")
CATEGORIES = ("delivered", "held-for-review", "excluded-with-approval", "confirmed-blank", "refused-with-reason")


def vocabulary(spark: SparkSession) -> DataFrame:
    """(stage, outcome, class, category): 31 rows, always broadcast."""
    return F.broadcast(spark.createDataFrame(ALGEBRA, "stage string, outcome string, class string, category string"))


def classify(units: DataFrame) -> DataFrame:
    """units (stage, outcome, ...) with class and category; an outcome that its stage doesn't know has neither."""
    return units.join(vocabulary(units.sparkSession), ["stage", "outcome"], "left")


#: Names that a matrix may be multiplied by: roles, chairs, candidates.
MOST_NAMES = 256


def few_names(df: DataFrame, column: str, name: str) -> DataFrame:
    """(name): the distinct values of a column of configured names, to be broadcast; more than MOST_NAMES are refused."""
    found = [r[0] for r in df.select(column).filter(F.col(column).isNotNull()).distinct().limit(MOST_NAMES + 1).collect()]
    if len(found) > MOST_NAMES:
        raise ValueError(f"{column} holds more than {MOST_NAMES} names")
    return F.broadcast(df.sparkSession.createDataFrame([(x,) for x in found], f"{name} string"))


def unknown_outcomes(units: DataFrame) -> DataFrame:
    """(stage, outcome, units) of outcomes outside the vocabulary: each is fatal to accounting."""
    return units.join(vocabulary(units.sparkSession), ["stage", "outcome"], "left_anti").groupBy("stage", "outcome").agg(F.count("*").alias("units"))


def algebra_gaps(spark: SparkSession, vocabulary_rows: DataFrame, transitions: DataFrame) -> DataFrame:
    """(stage, outcome, missing_from) of pairs that only one of the two tables decides."""
    left = vocabulary_rows.select("stage", "outcome").join(transitions.select("stage", "outcome"), ["stage", "outcome"], "left_anti")
    right = transitions.select("stage", "outcome").join(vocabulary_rows.select("stage", "outcome"), ["stage", "outcome"], "left_anti")
    return left.withColumn("missing_from", F.lit("transitions")).unionByName(right.withColumn("missing_from", F.lit("vocabulary")))


def zero_filled(counts: DataFrame, column: str, words: tuple[str, ...], keys: list[str] | None = None) -> DataFrame:
    """counts (keys, column, n) with a row of 0 for every word of a closed vocabulary that is missing."""
    keys = keys or []
    every = counts.sparkSession.createDataFrame([(w,) for w in words], f"{column} string")
    frame = counts.select(*keys).distinct().join(F.broadcast(every)) if keys else F.broadcast(every)
    return frame.join(counts, [*keys, column], "left").withColumn("n", F.coalesce("n", F.lit(0)))


def page_category(categories: Column) -> Column:
    """The one category of a page from those of its acts: delivered if any is; excluded or blank if all are; else held."""
    distinct = F.array_distinct(F.coalesce(categories, F.array().cast("array<string>")))
    only = lambda w: (F.size(distinct) == 1) & (F.element_at(F.concat(distinct, F.array(F.lit(""))), 1) == w)
    return (
        F.when(F.array_contains(distinct, "delivered"), "delivered")
        .when(only("excluded-with-approval"), "excluded-with-approval")
        .when(only("confirmed-blank"), "confirmed-blank")
        .otherwise("held-for-review")
    )


def hard_failures(events: DataFrame, policy: DataFrame, threshold: int) -> DataFrame:
    """(arm, failures, stop) from events (stage, subject, outcome, pass_kind) that the policy (stage, outcome) names.

    A (stage, subject) counts once. Instrument passes are tallied apart and never stop a run.
    """
    named = events.join(F.broadcast(policy), ["stage", "outcome"], "left_semi")
    arm = F.when(F.col("pass_kind") == "production", "production").otherwise("instrument")
    out = named.groupBy(arm.alias("arm")).agg(F.count_distinct("stage", "subject").alias("failures"))
    return out.withColumn("stop", (F.col("arm") == "production") & (F.col("failures") > threshold))


def reason_code(detail: Column) -> Column:
    """The code of 'code: detail'."""
    return F.trim(F.split_part(detail, F.lit(":"), F.lit(1)))
