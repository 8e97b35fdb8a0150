"""Readers of the Parquet tables, and views of them in the shapes that evidence operators take."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(subject_id, ordinal, chair, text): a conversation's turns as the attempts on one subject."""
    return table(spark, sf_dir, "conversations").select(
        F.col("conv_id").alias("subject_id"), (F.col("turn") + 1).alias("ordinal"), F.col("role").alias("chair"), "text"
    )


ATTEMPTS = "attempts AS (SELECT conv_id AS subject_id, turn + 1 AS ordinal, role AS chair, text FROM conversations)"

#: Our own mapping of event types to reading outcomes.
OUTCOME_OF = {"view": "read", "click": "genuinely-empty", "error": "failed", "signup": "not-run", "purchase": "excluded"}


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(act, chair, attempt, outcome): events as outcomes of five chairs' attempts on a user's act."""
    mapped = F.create_map(*[F.lit(x) for kv in OUTCOME_OF.items() for x in kv])
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("act"),
        F.concat(F.lit("chair-"), (F.col("event_id") % 5).cast("string")).alias("chair"),
        F.col("event_id").alias("attempt"),
        mapped[F.col("event_type")].alias("outcome"),
        "value",
    )


READINGS = """readings AS (
  SELECT user_id AS act, 'chair-' || CAST(event_id % 5 AS VARCHAR) AS chair, event_id AS attempt,
         CASE event_type WHEN 'view' THEN 'read' WHEN 'click' THEN 'genuinely-empty' WHEN 'error' THEN 'failed'
                         WHEN 'signup' THEN 'not-run' WHEN 'purchase' THEN 'excluded' END AS outcome, value
  FROM events)"""


def current_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(act, chair, attempt, outcome, value): each chair's latest reading of an act."""
    from lectern.operators.attempts import latest

    return latest(readings(spark, sf_dir), ["act", "chair"], "attempt")


CURRENT = READINGS + """, current AS (
  SELECT act, chair, attempt, outcome, value FROM (
    SELECT *, row_number() OVER (PARTITION BY act, chair ORDER BY attempt DESC) AS place FROM readings) WHERE place = 1)"""


def rectangles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(page, id, x, y, w, h): order lines as boxes on a page of 260 by 320."""
    lines = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("page"), F.col("l_linenumber").cast("long").alias("id"))
    q = F.col("q").cast("int")
    return lines.agg(F.min("l_partkey").alias("p"), F.min("l_suppkey").alias("s"), F.min("l_quantity").alias("q")).select(
        "page",
        "id",
        (F.col("p") % 200).alias("x"),
        (F.col("s") % 260).alias("y"),
        (q + 8).cast("long").alias("w"),
        (q % 17 + 3).cast("long").alias("h"),
    )


RECTANGLES = """rectangles AS (
  SELECT page, id, p % 200 AS x, s % 260 AS y, CAST(CAST(q AS INT) + 8 AS BIGINT) AS w, CAST(CAST(q AS INT) % 17 + 3 AS BIGINT) AS h FROM (
    SELECT l_orderkey AS page, CAST(l_linenumber AS BIGINT) AS id, min(l_partkey) AS p, min(l_suppkey) AS s, min(l_quantity) AS q FROM lineitem GROUP BY ALL))"""


def intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(owner, id, start, end): half-open spans of seconds, one for each event of a user."""
    start = F.unix_seconds(F.col("ts").cast("timestamp"))
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("owner"), F.col("event_id").alias("id"), start.alias("start"), (start + F.floor(F.abs("value")) % 90 * 60 + 1).alias("end")
    )


INTERVALS = """intervals AS (
  SELECT user_id AS owner, event_id AS id, epoch_us(ts) // 1000000 AS start,
         epoch_us(ts) // 1000000 + CAST(floor(abs(value)) AS BIGINT) % 90 * 60 + 1 AS "end" FROM events)"""
