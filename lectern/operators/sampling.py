"""Deterministic samples by hash: the same row always votes the same way, on any number of machines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lectern.functions.canonical import digest, record
from lectern.operators.reconcile import difference

SETS = ("calibration", "locked-acceptance")


def per_mille(subject: Column, run_id: str, purpose: str, rate: int) -> Column:
    """Whether a subject is in a sample of rate per 1000: the first 8 digits of its digest, mod 1000."""
    h = digest(record(purpose=F.lit(purpose), run_id=F.lit(run_id), act_id=subject))
    return F.conv(F.substring(h, 1, 8), 16, 10).cast("long") % 1000 < rate


def set_of(page_sha256: Column) -> Column:
    """A content-driven half: the first digit of the page's digest decides, whatever the seed."""
    h = digest(record(page_sha256=page_sha256, purpose=F.lit("gold-set-v1")))
    return F.when(F.conv(F.substring(h, 1, 1), 16, 10).cast("int") < 8, SETS[0]).otherwise(SETS[1])


def rank(seed: str, ordinal: Column, page_sha256: Column, stratum: Column) -> Column:
    return digest(record(seed=F.lit(seed), ordinal=ordinal, page_sha256=page_sha256, stratum=stratum, purpose=F.lit("gold-sample")))


def draw_key(seed: str, member: Column) -> Column:
    """sha256 of the seed, a zero byte and the member: the order of a frame's draw."""
    return F.sha2(F.concat(F.lit(seed).cast("binary"), F.lit(bytearray(b"\0")), member.cast("binary")), 256)


def stratified(catalog: DataFrame, plan: DataFrame, seed: str) -> DataFrame:
    """(gold_set, stratum, ordinal, sha256, place) of the first `quota` pages of each set and stratum by rank.

    plan (gold_set, stratum, quota) is a small table of the caller's; its largest quota lets every task keep so many
    rows of a stratum alone before the strata are shuffled.
    """
    most = plan.agg(F.max("quota")).first()[0] or 0
    ranked = catalog.withColumn("gold_set", set_of(F.col("sha256"))).withColumn("rank", rank(seed, F.col("ordinal"), F.col("sha256"), F.col("stratum")))
    ranked = ranked.join(F.broadcast(plan), ["gold_set", "stratum"])
    place = F.row_number().over(Window.partitionBy("gold_set", "stratum").orderBy("rank", "ordinal"))
    return ranked.withColumn("place", place).filter(F.col("place") <= most).filter("place <= quota").select("gold_set", "stratum", "ordinal", "sha256", "place")


def plan_violations(catalog: DataFrame, plan: DataFrame) -> DataFrame:
    """(gold_set, stratum, rule): strata that a set's plan 'omits', names that are 'unknown', and a 'shortfall' of pages."""
    eligible = catalog.withColumn("gold_set", set_of(F.col("sha256"))).groupBy("gold_set", "stratum").agg(F.count("*").alias("eligible"))
    both = catalog.sparkSession.createDataFrame([(s,) for s in SETS], "gold_set string")
    want = catalog.select("stratum").distinct().join(F.broadcast(both))
    omitted = want.join(plan, ["gold_set", "stratum"], "left_anti").withColumn("rule", F.lit("omits"))
    unknown = plan.join(catalog.select("stratum").distinct(), "stratum", "left_anti").select("gold_set", "stratum", F.lit("unknown").alias("rule"))
    short = plan.join(eligible, ["gold_set", "stratum"], "left").filter("coalesce(eligible, 0) < quota").select("gold_set", "stratum", F.lit("shortfall").alias("rule"))
    return omitted.select("gold_set", "stratum", "rule").unionByName(unknown).unionByName(short)


def replay(catalog: DataFrame, plan: DataFrame, seed: str, recorded: DataFrame) -> DataFrame:
    """(gold_set, stratum, ordinal, side): recorded members that the draw, made again, doesn't have, and the other way round."""
    return difference(stratified(catalog, plan, seed).select("gold_set", "stratum", "ordinal"), recorded.select("gold_set", "stratum", "ordinal"))
