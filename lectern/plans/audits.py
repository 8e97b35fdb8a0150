"""Queries of page audits, anchors, conditions, configurations and residue; see plans/records for how faults are planted."""

from __future__ import annotations

from pyspark.sql import functions as F

from lectern.functions import geometry as G
from lectern.operators import audit as A
from lectern.plans.records import _expected, _planted
from lectern.plans.registry import Registry
from lectern.sources.tables import RECTANGLES, rectangles, table

query = Registry()


def _docs(spark, d):
    return table(spark, d, "documents")


def _readings(spark, d):
    """Ten acts on a page: a year in most of them, a word twice in some, some out of their declared order, some sealed long ago."""
    c = F.col
    i = c("doc_id")
    year = 1000 + i * 7919 % 900
    words = F.concat(F.lit("Anno "), F.when(i % 4 == 3, "domini").otherwise(year.cast("string")), F.lit(" die"), F.when(i % 6 == 0, " Die").otherwise(""), F.lit(" x"))
    rows = _docs(spark, d).select(F.expr("doc_id div 10").alias("page"), i.alias("act"), i.alias("declared"), F.when(i % 10 == 8, i + 5).otherwise(i * 1).alias("y"), words.alias("text"))
    current = rows.filter("act % 3 <> 0")
    return current, rows.withColumn("text", F.when(c("act") % 3 != 0, "superseded 1000").otherwise(c("text")))


_FLAGS = """d AS (SELECT doc_id AS act, doc_id // 10 AS page, CASE WHEN doc_id % 4 = 3 THEN NULL ELSE 1000 + doc_id * 7919 % 900 END AS year, CASE WHEN doc_id % 10 = 8 THEN doc_id + 5 ELSE doc_id END AS y FROM documents),
r AS (SELECT *, row_number() OVER (PARTITION BY page ORDER BY act) AS a, row_number() OVER (PARTITION BY page ORDER BY y, act) AS b FROM d), p AS (SELECT act, lag(year) OVER (PARTITION BY page ORDER BY act) AS before FROM d WHERE year IS NOT NULL),
f AS (SELECT page, act, 'date-sequence' AS class, 5 AS start, 9 AS "end" FROM r JOIN p USING (act) WHERE year < before UNION ALL SELECT page, act, 'order', 0, CASE WHEN act % 4 = 3 THEN 17 ELSE 15 END + CASE WHEN act % 6 = 0 THEN 4 ELSE 0 END FROM r WHERE a <> b
 UNION ALL SELECT page, act, 'repetition', CASE WHEN act % 4 = 3 THEN 12 ELSE 10 END, CASE WHEN act % 4 = 3 THEN 15 ELSE 13 END FROM r WHERE act % 6 = 0)"""


@query(f"""WITH {_FLAGS} SELECT page, act, string_agg(class, ',' ORDER BY class) AS flags FROM f GROUP BY page, act""")
def k23_page_flags(spark, d):
    """All flags of a page at once, from its current readings and the sealed ones beside them."""
    return A.audit_flags(*_readings(spark, d)).select("page", "act", F.array_join(F.transform("flags", lambda f: f["class"]), ",").alias("flags"))


@query(f"""WITH {_FLAGS}, u AS (SELECT DISTINCT page, act, start, CASE WHEN class = 'repetition' THEN start + 3 ELSE "end" END AS "end" FROM f) SELECT page, act, count(*) AS requests, min(start) AS first FROM u GROUP BY page, act""")
def k24_reproof_requests(spark, d):
    """One neutral request for each flagged place."""
    plan = A.reproof_plan(A.audit_flags(*_readings(spark, d)))
    neutral = ~F.col("request").rlike("(?i)sequence|order|repetition|witness")
    return plan.filter(neutral).groupBy("page", "act").agg(F.count("*").alias("requests"), F.min("start").alias("first"))


_BAD_NOTES = ["outside the text", "outside the text", "kind", "annotations overlap", "over an uncertain span"]


@query(_expected("documents", "doc_id", _BAD_NOTES))
def k40_annotation_anchors(spark, d):
    """Annotations that lie within their text, apart, and clear of what is uncertain."""
    note = lambda a, b, k="struck": F.struct(F.lit(a).alias("start"), (F.lit(b) if isinstance(b, int) else b).alias("end"), F.lit(k).alias("kind"))
    rows = _docs(spark, d).select("doc_id", F.concat(F.lit("x" * 30), "text").alias("text")).withColumns({"annotations": F.array(note(1, 5), note(5, 9, "illegible")), "uncertain": F.array(F.struct(F.lit(9).alias("start"), F.lit(12).alias("end")))})
    changes = [{"annotations": F.array(note(20, F.length("text") + 1))}, {"annotations": F.array(note(4, 4))}, {"annotations": F.array(note(1, 2, "pretty"))}, {"annotations": F.array(note(1, 6), note(5, 9))}, {"annotations": F.array(note(8, 10))}]
    return A.annotation_violations(_planted(rows, "doc_id", list(zip(_BAD_NOTES, changes, strict=True))), ["doc_id"])


def _clip(a: str, b: str) -> str:
    return f"greatest(0, least({a}.x + {a}.w, {b}.x + {b}.w) - greatest({a}.x, {b}.x)) * greatest(0, least({a}.y + {a}.h, {b}.y + {b}.h) - greatest({a}.y, {b}.y))"


@query(f"""WITH {RECTANGLES}, bands AS (SELECT page, i + 1 AS place, 0 AS x, greatest(0, 320 * i // 4 - 8) AS y, 260 AS w, least(320, 320 * (i + 1) // 4 + 8) - greatest(0, 320 * i // 4 - 8) AS h FROM (SELECT DISTINCT page FROM rectangles), (SELECT unnest(range(0, 4)) AS i)),
meet AS (SELECT r.page, CAST(greatest(r.x, a.x) AS BIGINT) AS x, greatest(r.y, a.y) AS y, least(r.x + r.w, a.x + a.w) - greatest(r.x, a.x) AS w, least(r.y + r.h, a.y + a.h) - greatest(r.y, a.y) AS h FROM rectangles r JOIN rectangles a ON a.page = r.page AND r.id = 1 AND a.id = 2),
t AS (SELECT b.page, b.place, b.w * b.h - CASE WHEN one.w IS NULL THEN 0 ELSE {_clip("b", "one")} END - CASE WHEN two.w IS NULL THEN 0 ELSE {_clip("b", "two")} END + CASE WHEN o.w > 0 AND o.h > 0 THEN {_clip("b", "o")} ELSE 0 END AS area
  FROM bands b LEFT JOIN rectangles one ON one.page = b.page AND one.id = 1 LEFT JOIN rectangles two ON two.page = b.page AND two.id = 2 LEFT JOIN meet o ON o.page = b.page)
SELECT page, place, CAST(area AS BIGINT) AS area FROM t""")
def k11_unclaimed_coverage(spark, d):
    """What all claims of a page leave of each fallback band."""
    boxes = rectangles(spark, d)
    n = lambda v: F.lit(v).cast("long")
    bands = boxes.select("page").distinct().select("page", F.explode(G.bands(n(260), n(320))).alias("t")).select("page", F.col("t.band").alias("place"), G.box(n(0), F.col("t.y"), F.col("t.w"), F.col("t.h")).alias("box"))
    return A.unclaimed(bands, boxes.filter("id <= 2").select("page", G.box(*(F.col(c) for c in "xywh")).alias("box"))).select("page", "place", "area")


@query("""SELECT doc_id AS act, c.condition, c.rule FROM documents JOIN (VALUES (0, 'image-only', 'shows other than its condition'), (1, 'text-only', 'shows other than its condition'), (2, 'dream', 'unknown condition'), (2, '*', 'not every condition once'), (3, '*', 'not every condition once')) c(k, condition, rule) ON doc_id % 6 = c.k""")
def k50_dossier_by_condition(spark, d):
    """Dossiers show what their condition allows, and every act has one for each condition."""
    c = F.col
    conditions = {"image-only": (True, False), "text-only": (False, True), "both": (True, True)}
    k = c("act") % 6
    rows = _docs(spark, d).select(c("doc_id").alias("act"), F.explode(F.array(*map(F.lit, conditions))).alias("condition"))
    rows = rows.withColumns({"image": F.when(c("condition") != "text-only", "crop"), "testimonia": F.when(c("condition") != "image-only", F.array(F.lit("a")))})
    rows = rows.withColumns({"image": F.when((k == 1) & (c("condition") == "text-only"), "crop").otherwise(c("image")), "testimonia": F.when((k == 0) & (c("condition") == "image-only"), F.array(F.lit("a"))).otherwise(c("testimonia"))})
    rows = rows.withColumn("condition", F.when((k == 2) & (c("condition") == "both"), "dream").otherwise(c("condition"))).filter(~((k == 3) & (c("condition") == "both")))
    return A.condition_violations(rows, conditions)


@query("""SELECT 'run-' || CAST(doc_id AS VARCHAR) AS run, 'a.toml' AS file, CASE doc_id % 6 WHEN 0 THEN 'never sealed' WHEN 1 THEN 'sealed but never read' WHEN 2 THEN 'read in two forms' WHEN 3 THEN 'differs from its seal' END AS rule FROM documents WHERE doc_id % 6 < 4""")
def k52_config_at_use(spark, d):
    """Configuration as it is read at use against what the run sealed."""
    c = F.col
    k = c("doc_id") % 6
    rows = _docs(spark, d).select("doc_id", F.concat(F.lit("run-"), c("doc_id").cast("string")).alias("run"), F.lit("a.toml").alias("file"), c("text").alias("content"))
    uses = rows.filter(k != 1).withColumn("content", F.when(k == 3, F.concat("content", F.lit("#"))).otherwise(c("content")))
    more = uses.filter(k == 2).withColumn("content", F.lit("other"))
    return A.configuration_violations(rows.filter(k != 0).select("run", "file", F.sha2("content", 256).alias("sha256")), uses.unionByName(more).drop("doc_id"))


@query("""SELECT source || '/' || CAST(doc_id AS VARCHAR) AS path, CASE doc_id % 5 WHEN 0 THEN 'left behind' WHEN 1 THEN 'nowhere in the report' WHEN 2 THEN 'kept but gone' END AS rule FROM documents WHERE doc_id % 5 < 3""")
def k54_cleanup_residue(spark, d):
    """What a cleanup left on disk against what it reports."""
    c = F.col
    k = c("doc_id") % 5
    rows = _docs(spark, d).select("doc_id", F.concat("source", F.lit("/"), c("doc_id").cast("string")).alias("path"))
    declared = rows.filter(k != 1).select("path", F.when(k.isin(2, 3), "kept").otherwise("removed").alias("state"))
    return A.residue(rows.filter(k.isin(0, 1, 3)), declared)


@query("""SELECT doc_id AS page, doc_id AS act, 'a' AS chair, CASE WHEN doc_id % 4 > 1 THEN 5 END AS characters, CASE doc_id % 4 WHEN 0 THEN 'names no testimony of the page and chair' WHEN 1 THEN 'span outside the testimony' END AS rule FROM documents""")
def j06_spans_and_attachments(spark, d):
    """Attachments with the page testimony that they name, by page, chair and reference."""
    c = F.col
    k = c("doc_id") % 4
    spans = _docs(spark, d).select(c("doc_id").alias("page"), F.lit("a").alias("chair"), F.explode(F.array(F.lit("t1"), F.lit("t2"))).alias("ref"), F.concat(F.lit("x" * 9), "text").alias("text"))
    views = _docs(spark, d).select(c("doc_id").alias("page"), c("doc_id").alias("act"), F.lit("a").alias("chair"), F.when(k == 0, "t3").otherwise("t2").alias("ref"), F.when(k == 1, -1).otherwise(2).alias("start"), F.lit(7).alias("end"))
    return A.testimony_joins(spans, views)
