"""Shared storage, scratch tables and connected components used by the corpus operators."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir.

    Only where the session names none and runs on one machine is a folder of our own set; executors elsewhere
    would each write to their own disks, so that is refused.
    """
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not named:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise ValueError("spark.checkpoint.dir has to name a folder that driver and executors share")
        sc.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="lectern-"))
        named = sc.getCheckpointDir()
    return named.rstrip("/")


def remove_path(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def write_bytes(spark: SparkSession, path: str, data: bytes) -> None:
    """A file of the driver's making in the shared folder, whatever store that is in."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(target, True)
    for k in range(0, len(data), 1 << 20):
        out.write(bytearray(data[k : k + (1 << 20)]))
    out.close()


def new_path(spark: SparkSession, kind: str) -> str:
    return f"{shared_dir(spark)}/lectern-{kind}-{uuid.uuid4().hex}"


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Scratch]:
    """Tables that live in the shared folder while an operator runs; lineage is cut by rereading them."""
    place = Scratch(spark, new_path(spark, "scratch"))
    try:
        yield place
    finally:
        remove_path(spark, place.root)


class Scratch:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def table(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, name: str) -> None:
        remove_path(self.spark, f"{self.root}/{name}")


def durable(df: DataFrame) -> DataFrame:
    """The rows, kept in the shared folder for as long as the frame is referenced."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


#: Ids that may be broadcast: 8 bytes each, some tens of MB as a hash relation.
BROADCAST_IDS = 500_000


def without(docs: DataFrame, ids: DataFrame, column: str = "doc_id") -> DataFrame:
    """The rows of docs whose id isn't among ids (one column; a null is equal to a null).

    The ids are kept and counted first: so many as BROADCAST_IDS are broadcast, which spares the documents
    a shuffle; more are joined by shuffling both sides.
    """
    held = durable(ids.toDF("__id").distinct())
    few = held.count() <= BROADCAST_IDS
    return docs.join(F.broadcast(held) if few else held.hint("merge"), docs[column].eqNullSafe(held["__id"]), "left_anti")


def connected_components(edges: DataFrame, place: Scratch, max_rounds: int = 60) -> DataFrame:
    """(id, component) for every id in edges (u, v): component is the smallest id reachable.

    Large-star and small-star rounds: each id links its larger neighbours to its smallest one, then
    its smaller neighbours likewise, until a round changes nothing. Every round is two aggregations
    with map-side minima and two joins, and its edges go to a scratch table, so a lost executor costs
    one round. Minima do too: a join of two tables is one whose skewed keys adaptive execution splits, and a
    large component has one. The number of rounds grows with the logarithm of the longest path.
    """
    def told(frame: DataFrame) -> tuple[int, int]:
        row = frame.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        return row["n"], row["h"]

    def star(frame: DataFrame, name: str) -> DataFrame:
        low = place.table(frame.groupBy("u").agg(F.min("v").alias("m")), name)
        return frame.join(low, "u").select("u", "v", F.least("u", "m").alias("m"))

    now = place.table(
        edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "cc0"
    )
    before = told(now)
    for k in range(1, max_rounds + 1):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = place.table(star(both, "low").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "large")
        low = star(large, "lower")
        small = low.select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v")))
        now = place.table(small.filter("u <> v").distinct(), f"cc{k}")
        place.drop(f"cc{k - 1}")
        after = told(now)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    # at rest every edge runs from an id to the root of its component
    return now.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(
        now.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    )
