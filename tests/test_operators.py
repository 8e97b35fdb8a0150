"""Hand-made rows for what the tables don't hold: gaps, ties, touching spans, one-sided keys, empty inputs."""

from __future__ import annotations

import itertools
import random
import time

import pytest
from pyspark.sql import functions as F

from lectern.functions import canonical as C
from lectern.functions import geometry as G
from lectern.operators import accounting as A
from lectern.operators import attempts as V
from lectern.operators import intervals as I
from lectern.operators import metrics as M
from lectern.operators import rectangles as B
from lectern.operators import reconcile
from lectern.operators import records as R


def _got(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_attempt_histories(spark):
    log = spark.createDataFrame([(1, 1), (1, 3), (2, 1), (2, 1), (3, 2), (4, 1), (4, 2)], "s int, o int")
    assert _got(V.history_violations(log, ["s"], "o")) == [(1, "gap"), (2, "duplicate"), (3, "start")]
    assert V.history_violations(log.limit(0), ["s"], "o").count() == 0
    assert _got(V.latest(log, ["s"], "o")) == [(1, 3), (2, 1), (3, 2), (4, 2)]


def test_unknown_outcome_and_empty_run(spark):
    units = spark.createDataFrame([("door", "admitted"), ("door", "lost")], "stage string, outcome string")
    assert _got(A.unknown_outcomes(units)) == [("door", "lost", 1)]
    none = [spark.createDataFrame([], k) for k in ("act long, category string, text_status string", "act long, under_witnessed boolean, unresolved_chairs long", "page long, outcome string, reason string", "act long, page long", "chair string")]
    assert R.run_aggregate(*none).first()["status"] == "partial"
    whole = [spark.createDataFrame(r, f.schema) for r, f in zip(([(1, "delivered", "established")], [(1, False, 0)], [(1, "sealed", None)], [(1, 1)], []), none, strict=True)]
    assert R.run_aggregate(*whole).first()["status"] == "complete"
    with pytest.raises(Exception, match="no witness outcome"):
        R.witness_coverage(spark.createDataFrame([(1, "a", "dreamt", True, False, False)], "act long, chair string, outcome string, attached boolean, truncated boolean, health_unrecorded boolean"), 1).collect()
    with pytest.raises(ValueError, match="policy"):
        R.recovery_violations(whole[0], {"fallback-recrop": 2, "page-level-reread": 2})
    assert len({(s, o) for s, o, _, _ in A.ALGEBRA}) == len(A.ALGEBRA)


def test_names_that_are_broadcast_are_few(spark):
    names = spark.range(300).select(F.col("id").cast("string").alias("n"))
    assert A.few_names(names.filter("id < 256"), "n", "name").count() == 256 and A.few_names(names.limit(0), "n", "name").count() == 0
    with pytest.raises(ValueError, match="more than 256"):
        A.few_names(names, "n", "name")


def test_page_category(spark):
    cases = [(None, "held-for-review"), ([], "held-for-review"), (["delivered", "confirmed-blank"], "delivered"), (["confirmed-blank"] * 2, "confirmed-blank"), (["excluded-with-approval"], "excluded-with-approval"), (["confirmed-blank", "excluded-with-approval"], "held-for-review")]
    rows = spark.createDataFrame([(c,) for c, _ in cases], "c array<string>")
    assert [r[0] for r in rows.select(A.page_category(F.col("c"))).collect()] == [w for _, w in cases]


def test_reconcile(spark):
    a = spark.createDataFrame([(1, "x"), (2, None), (3, "z")], "k int, v string")
    b = spark.createDataFrame([(1, "x"), (2, None), (4, "w"), (3, "q")], "k int, v string")
    assert _got(reconcile.reconcile(a, b, ["k"], ["v"])) == [(1, "agrees"), (2, "agrees"), (3, "differs"), (4, "right-only")]
    assert _got(reconcile.difference(a.unionByName(a.limit(1)), a)) == [(1, "x", "missing")]


def test_touching_intervals(spark):
    spans = spark.createDataFrame([("a", 1, 0, 5), ("a", 2, 5, 9), ("a", 3, 11, 12), ("a", 4, 1, 2)], "owner string, id int, start int, end int")
    merged = I.merge(spans, ["owner"], ["start", "end", "id"])
    assert _got(merged) == [("a", 0, 9), ("a", 11, 12)] and _got(I.gaps(merged, ["owner"])) == [("a", 9, 11)]
    row = spark.createDataFrame([(10, [(2, 4), (4, 6), (8, 30)]), (5, []), (3, [(0, 3)])], "n int, s array<struct<start:int,end:int>>")
    got = [[tuple(x) for x in r[0]] for r in row.select(I.uncovered(F.col("n"), F.col("s"))).collect()]
    assert got == [[(0, 2), (6, 8)], [(0, 5)], []]


def test_rectangles(spark):
    boxes = spark.createDataFrame([(1, 1, 0, 0, 10, 10), (1, 2, 0, 0, 10, 10), (1, 3, 2, 2, 3, 3), (1, 4, 9, 9, 5, 5), (1, 5, 50, 50, 1, 1)], "page long, id long, x long, y long, w long, h long")
    found = {(r["left"], r["right"]): r["state"] for r in B.relations(boxes).collect()}
    assert found == {(1, 2): "coincident-aabb", (1, 3): "contains", (2, 3): "contains", (1, 4): "ambiguous-overlap", (2, 4): "ambiguous-overlap"}
    best = {r["id"]: (r["group"], r["verdict"]) for r in B.best_match(boxes.filter("id in (3, 5)"), boxes.filter("id in (1, 2)")).collect()}
    assert best == {3: (None, "tie"), 5: (None, "missed")}
    alone = B.best_match(boxes.filter("id = 5").withColumn("page", F.lit(2).cast("long")), boxes).first()
    assert (alone["group"], alone["overlap"], alone["verdict"]) == (None, 0, "missed")


def test_subtraction_leaves_the_right_area(spark):
    rng = random.Random(5)
    cases = []
    for _ in range(40):
        box = lambda m: (rng.randint(0, 12), rng.randint(0, 12), rng.randint(1, m), rng.randint(1, m))
        cases.append((box(10), [box(8) for _ in range(rng.randint(0, 4))]))
    kind = "struct<x:long,y:long,w:long,h:long>"
    got = [r[0] for r in spark.createDataFrame(cases, f"r {kind}, c array<{kind}>").select(G.area(G.remaining(F.col("r"), F.col("c")))).collect()]
    cells = lambda b: set(itertools.product(range(b[0], b[0] + b[2]), range(b[1], b[1] + b[3])))
    assert got == [len(cells(r) - set().union(*map(cells, c))) for r, c in cases]


def test_components_against_brute_force(spark):
    rng = random.Random(3)
    rows = [(p, i, rng.randint(0, 60), rng.randint(0, 60), rng.randint(1, 6), rng.randint(1, 6)) for p in range(4) for i in range(30)]
    found = {(r["page"], r["id"]): r["component"] for r in B.components(spark.createDataFrame(rows, "page long, id long, x long, y long, w long, h long"), 2).collect()}
    root = {(p, i): i for p, i, *_ in rows}
    for _ in range(30):
        for a in rows:
            for b in rows:
                if a[0] == b[0] and max(a[2] - b[2] - b[4], b[2] - a[2] - a[4], a[3] - b[3] - b[5], b[3] - a[3] - a[5]) <= 2:
                    root[a[:2]] = root[b[:2]] = min(root[a[:2]], root[b[:2]])
    assert found == root


def test_components_of_many_pages_and_of_large_ones(spark):
    """40,000 pages, which took a call each; a page over several batches whose boxes meet in one chain; null pages and coordinates."""
    schema = "page long, id long, x long, y long, w long, h long"
    many = spark.range(120_000).select(F.expr("id div 3").alias("page"), "id", (F.col("id") % 3 * 12).alias("x"), F.lit(0).cast("long").alias("y"), F.when(F.col("id") % 3 == 0, 10).otherwise(5).cast("long").alias("w"), F.lit(5).cast("long").alias("h"))
    began = time.monotonic()
    got = B.components(many, 2).groupBy((F.col("component") - F.col("id")).alias("k"), (F.col("id") % 3).alias("m")).count().collect()
    assert {(r["k"], r["m"], r["count"]) for r in got} == {(0, 0, 40_000), (-1, 1, 40_000), (0, 2, 40_000)} and time.monotonic() - began < 30
    chain = spark.range(30_000).select(F.lit(7).cast("long").alias("page"), "id", F.lit(0).cast("long").alias("x"), (F.col("id") * 7919 % 30_000 * 3).alias("y"), F.lit(1).cast("long").alias("w"), F.lit(1).cast("long").alias("h"))
    assert [tuple(r) for r in B.components(chain, 2).groupBy("page", "component").count().collect()] == [(7, 0, 30_000)]
    odd = spark.createDataFrame([(None, 1, 0, 0, 5, 5), (None, 2, 6, 0, 5, 5), (0, 1, 0, 0, 5, 5), (0, 2, 0, None, 5, 5), (0, 3, 1, 1, 5, 5)], schema)
    assert {tuple(r) for r in B.components(odd, 2).collect()} == {(None, 1, 1), (None, 2, 1), (0, 1, 1), (0, 2, 2), (0, 3, 1)}


def test_grouping_doesnt_depend_on_order(spark):
    base = [(1, 10, 2, 10, 8, 6), (1, 20, 60, 12, 80, 5), (1, 30, 60, 19, 80, 5), (1, 40, 2, 40, 8, 40), (1, 50, 60, 45, 70, 6), (1, 60, 60, 90, 70, 6)]
    schema = "page long, id long, x long, y long, w long, h long"
    first = None
    for order in list(itertools.permutations(base))[::120]:
        got = _got(B.grouped_acts(spark.createDataFrame(list(order), schema), 200, 6, 2, 30))
        first = first or got
        assert got == first


def test_integer_statistics(spark):
    rows = spark.createDataFrame([("a", v) for v in (1, 1, 2, 2, 9)] + [("b", 4)], "k string, v int")
    assert {r["k"]: (r["mode"], r["n"]) for r in M.histogram_mode(rows, ["k"], "v").collect()} == {"a": (1, 2), "b": (4, 1)}
    assert _got(M.nearest_rank(rows, ["k"], "v", 75)) == [("a", 2), ("b", 4)]
    zero = spark.createDataFrame([("complete", 0, 0, 0, 0, 0, 0, None)], "status string, cer_errors long, cer_units long, wer_errors long, wer_units long, compared long, departed long, elapsed_ms double")
    assert M.aggregate(zero, []).first()["cer"] is None


def test_geometry_round_trip(spark):
    rows = spark.createDataFrame([((x, y, w, h),) for x in (0, 7, 99) for y in (0, 50) for w in (1, 30) for h in (1, 60)], "b struct<x:long,y:long,w:long,h:long>")
    back = rows.select("b", G.from_model(G.to_model(F.col("b"), 130, 120, 37, 41), 130, 120, 37, 41).alias("r"))
    assert back.filter(~G.contains(F.col("r"), F.col("b"))).count() == 0
    half = rows.limit(1).select(G.pad_amount(F.lit(5).cast("long"), 1000), G.div(F.lit(-7).cast("long"), 2), G.ceil_div(F.lit(-7).cast("long"), 2)).first()
    assert tuple(half) == (1, -4, -3)


def test_identities(spark):
    row = spark.createDataFrame([("ab", 3)], "s string, n long")
    import hashlib

    want = hashlib.sha256(b'{"bindings":{"ordinal":3,"source_sha256":"ab"},"kind":"page"}').hexdigest()[:16]
    assert row.select(C.identity("page", source_sha256=F.col("s"), ordinal=F.col("n"))).first()[0] == f"pg_{want}"
    shapes = spark.createDataFrame([("a" * 64, "run-1", f"pg_{want}"), ("A" * 64, "-x", "pg_1"), ("a" * 64 + "\n", "r\n", f"pg_{want}\n")], "d string, r string, i string")
    assert [tuple(r) for r in shapes.select(C.is_sha256(F.col("d")), C.is_run_id(F.col("r")), C.is_identity(F.col("i"))).collect()] == [(True,) * 3, (False,) * 3, (False,) * 3]
    from pyspark.sql import types as T

    assert C.refuse_floats(T.StructType().add("a", "double").add("b", T.ArrayType(T.StructType().add("c", "float")))) == ["$.a", "$.b[].c"]
