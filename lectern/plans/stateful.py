"""Queries of stateful logic in batch form; the streams themselves are covered by tests."""

from __future__ import annotations

from pyspark.sql import functions as F

from lectern.operators import accounting as A
from lectern.operators import intervals as I
from lectern.plans.registry import Registry
from lectern.sources.tables import READINGS, readings, table

query = Registry()


@query(f"""WITH {READINGS}, tally AS (SELECT attempt // 200 AS checkpoint, count(DISTINCT act) AS failures FROM readings WHERE outcome = 'failed' GROUP BY ALL),
run AS (SELECT checkpoint, failures, sum(failures) OVER (ORDER BY checkpoint) AS total FROM tally) SELECT checkpoint, failures, total > 40 AS tripped FROM run""")
def t04_circuit_breaker(spark, d):
    """Failures so far at each checkpoint."""
    tally = readings(spark, d).filter("outcome = 'failed'").groupBy(F.expr("attempt div 200").alias("checkpoint")).agg(F.count_distinct("act").alias("failures"))
    return I.running_sum(tally, ["checkpoint"], "failures", "total").withColumn("tripped", F.col("total") > 40).drop("total")


@query("""SELECT date_trunc('hour', ts) AS start, event_type, count(*) AS n FROM events GROUP BY ALL""")
def t09_windowed_outcomes(spark, d):
    events = table(spark, d, "events")
    return events.groupBy(F.date_trunc("hour", F.col("ts").cast("timestamp")).alias("start"), "event_type").agg(F.count("*").alias("n")).withColumn("start", F.col("start").cast("timestamp_ntz"))


@query(f"""WITH {READINGS} SELECT outcome, count(*) AS n FROM readings GROUP BY outcome""")
def t10_outcome_totals(spark, d):
    return A.zero_filled(readings(spark, d).groupBy("outcome").agg(F.count("*").alias("n")), "outcome", ("read", "genuinely-empty", "failed", "not-run", "excluded"))
