"""Positions, lags and sums over ranges of more rows than Spark samples to draw a range's bounds, against plain Python."""

from __future__ import annotations

import itertools

import duckdb
import pytest
from pyspark.sql import functions as F

from lectern import plans
from lectern.operators import admission
from lectern.operators import intervals as I
from lectern.sources import sinks
from lectern.sources.samples import sample_file
from tests.conftest import same

N = 20_000


@pytest.fixture(scope="module", autouse=True)
def many_parts(spark):
    """As many tasks as a large table has."""
    conf = {"spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.fixture(scope="module")
def rows(spark, many_parts):
    k = F.xxhash64("id")
    shown = spark.range(N).select("id", F.when(F.col("id") % 7 > 0, F.pmod(k, F.lit(3))).alias("key"), F.concat(F.lit("it's \\ é"), k.cast("string")).alias("o"), F.repeat(F.lit("x"), F.pmod(k, F.lit(40)).cast("int")).alias("more"))
    return shown, sorted(((r["o"], r["id"], r["key"]) for r in shown.collect()), key=lambda r: r[0].encode())


def _groups(ordered):
    return [list(g) for _, g in itertools.groupby(sorted(ordered, key=lambda r: -1 if r[2] is None else r[2]), key=lambda r: r[2])]


def test_numbered_in_order(spark, rows):
    df, ordered = rows
    got = {r["id"]: (r["n"], r["more"]) for r in sinks.numbered_in_order(df, "o", "n").collect()}
    more = {r["id"]: r["more"] for r in df.collect()}
    assert got == {i: (n, more[i]) for n, (_, i, _) in enumerate(ordered, 1)}


def test_ranks_and_lags_of_few_keys_and_null(rows):
    df, ordered = rows
    got = I.ranked(df, ["key"], ["o"], "n").collect()
    assert {r["id"]: r["n"] for r in got} == {i: n for g in _groups(ordered) for n, (_, i, _) in enumerate(g, 1)} and len(got) == N
    lag = I.lagged(df, ["key"], ["o"], "id", "before").collect()
    assert {r["id"]: r["before"] for r in lag} == {i: b for g in _groups(ordered) for (_, i, _), b in zip(g, [None, *(x[1] for x in g)])} and len(lag) == N


def test_running_sum(rows):
    df, ordered = rows
    got = {r["id"]: r["s"] for r in I.running_sum(df, ["o"], "id", "s").collect()}
    assert got == dict(zip((i for _, i, _ in ordered), itertools.accumulate(i for _, i, _ in ordered), strict=True))


@pytest.mark.parametrize("name", ["k02_admissions_by_source", "k23_page_flags", "k24_reproof_requests", "s02_source_inventory", "s08_container_pages"])
def test_query_of_many_rows_equals_its_sql(spark, tmp_path, name):
    """20,000 documents in several files, so that each branch of a plan would draw ranges of its own."""
    path = str(tmp_path / "documents.parquet")
    spark.range(N).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"), F.lit("en").alias("lang"), F.concat(F.lit("s"), F.col("id") % 3).alias("source")).repartition(7).write.parquet(path)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{path}/*.parquet'")
    same(plans.queries()[name](spark, str(tmp_path)), con, plans.oracle_sql()[name])


@pytest.fixture(scope="module")
def repeated_files(spark, many_parts):
    """Files of one and three pages: each id twice, with other content, and three of no id."""
    ids = [*range(50), *range(50), None, None, None]
    rows = [(i, k, sample_file(3 if k % 3 == 0 else 4, "")) for k, i in enumerate(ids)]
    return spark.createDataFrame(rows, "doc_id long, file long, content binary").repartition(5), rows


def test_pages_of_repeated_and_null_ids_are_numbered_once(repeated_files):
    df, rows = repeated_files
    got = admission.expanded(df, ["doc_id"]).orderBy("ordinal").collect()
    assert [r["ordinal"] for r in got] == list(range(1, sum(3 if k % 3 == 0 else 1 for k in range(len(rows))) + 1))
    files = [(f, [r["page_index"] for r in own]) for f, own in itertools.groupby(got, key=lambda r: r["file"])]
    assert sorted(files) == [(k, [0, 1, 2] if k % 3 == 0 else [None]) for _, k, _ in rows]
    assert [r["doc_id"] for r in got] == sorted((r["doc_id"] for r in got), key=lambda i: -1 if i is None else i)
    assert {r["file"]: bytes(r["content"]) for r in got} == {k: c for _, k, c in rows}


def test_admissions_of_repeated_ids_equal_their_sql(spark, tmp_path):
    path = str(tmp_path / "documents.parquet")
    spark.range(600).select((F.col("id") % 300).alias("doc_id"), F.lit("text").alias("text"), F.lit("en").alias("lang"), F.lit("s").alias("source")).repartition(3).write.parquet(path)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{path}/*.parquet'")
    name = "k02_admissions_by_source"
    same(plans.queries()[name](spark, str(tmp_path)), con, plans.oracle_sql()[name])


def test_bounds_stay_above_a_union(rows):
    """Below it the optimizer told constraints of all bounds for each side, and raised an error on three million acts in 200 ranges."""
    df, _ = rows
    plan = I.ranked(df.unionByName(df.withColumn("id", F.col("id") + N)), ["key"], ["o"], "n")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Union") == plan.count(" AS __part#") == 2
