from __future__ import annotations

from pyspark.sql import functions as F

from lectern.streaming import attempts as S


def _ran(spark, df, name, mode="append"):
    query = df.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    query.awaitTermination(120)
    return spark.table(name)


def test_ordinals_are_followed(spark, tmp_path):
    rows = spark.createDataFrame([(1, 1), (1, 2), (1, 2), (2, 1), (2, 3)], "subject_id long, ordinal long")
    rows.coalesce(1).write.parquet(str(tmp_path / "log"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "log"))
    got = sorted(map(tuple, _ran(spark, S.follow_ordinals(stream), "ordinals").collect()))
    assert got == [(1, 1, "append"), (1, 2, "append"), (1, 2, "rerun"), (2, 1, "append"), (2, 3, "gap")]


def test_replayed_writes_count_once(spark, tmp_path):
    rows = spark.createDataFrame([("a", "2024-01-01 00:00:00"), ("a", "2024-01-01 00:00:05"), ("b", "2024-01-01 00:00:01")], "id string, at string").select("id", F.col("at").cast("timestamp").alias("at"))
    rows.coalesce(1).write.parquet(str(tmp_path / "log"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "log"))
    assert sorted(r["id"] for r in _ran(spark, S.idempotent(stream, ["id"], "at", "1 minute"), "replays").collect()) == ["a", "b"]


def test_recovery_is_bounded(spark, tmp_path):
    pending = spark.range(10).select(F.col("id").alias("subject_id"))

    def keep(df, n):
        df.write.parquet(str(tmp_path / f"round{n}"))
        return spark.read.parquet(str(tmp_path / f"round{n}"))

    left, rounds = S.recover(pending, lambda p, k: p.withColumn("resolved", F.col("subject_id") % 4 == k), keep)
    assert rounds == 3 and sorted(r[0] for r in left.collect()) == [0, 4, 8]
    done, rounds = S.recover(pending, lambda p, k: p.withColumn("resolved", F.lit(True)), keep=lambda df, n: keep(df, n + 10))
    assert rounds == 1 and done.isEmpty()
