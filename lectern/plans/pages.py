"""Queries of pages, acts and testimonies; see plans/records for how faults are planted."""

from __future__ import annotations

from pyspark.sql import functions as F

from lectern.functions import geometry as G
from lectern.operators import pages as P
from lectern.operators import rectangles as B
from lectern.plans.records import _expected, _planted
from lectern.plans.registry import Registry
from lectern.sources.tables import RECTANGLES, rectangles, table

query = Registry()

_sha = lambda text: F.sha2(text, 256)
_null = lambda kind="string": F.lit(None).cast(kind)


def _docs(spark, d):
    return table(spark, d, "documents")


def _box(*xywh):
    return G.box(*(F.lit(v).cast("long") if isinstance(v, int) else v for v in xywh))


_BAD_PAGES = ["state, refused without a reason, refused with pixels", "sealed without pixels", "pixels missing", "pixels altered", "sealed with a reason", "refused with pixels", "refused without a reason", "no source"]


@query(_expected("(SELECT doc_id AS page FROM documents)", "page", _BAD_PAGES))
def k05_page_evidence(spark, d):
    """Sealed pages carry their pixels and no reason, refused ones a reason and no pixels."""
    c = F.col
    n = len(_BAD_PAGES) + 2
    fault = lambda k: c("page") % n == k
    own = _docs(spark, d).select(c("doc_id").alias("page"), F.concat(c("doc_id").cast("string"), F.lit(" "), "text").alias("content"))
    refused = fault(5) | fault(6) | fault(n - 1)
    pages = own.select("page", F.when(refused, "refused").otherwise("sealed").alias("state"), F.when(~refused, _sha(c("content"))).alias("pixels"), F.when(refused, "corrupt: no end").alias("reason"), F.lit("a.png").alias("source"))
    changes = [{"state": F.lit("lost")}, {"pixels": _null()}, {"pixels": c("pixels")}, {"pixels": c("pixels")}, {"reason": F.lit("torn")}, {"pixels": _sha(F.lit("?"))}, {"reason": F.lit(" ")}, {"source": _null()}]
    blobs = own.filter(~fault(2)).select(_sha(c("content")).alias("sha256"), F.when(fault(3), "?").otherwise(c("content")).alias("content"))
    return P.page_evidence_violations(_planted(pages, "page", list(zip(_BAD_PAGES, changes, strict=True))), blobs)


@query(f"""WITH {RECTANGLES}, levels AS (SELECT l_orderkey AS page, CAST(l_quantity AS BIGINT) // 10 AS value, count(*) AS n FROM lineitem WHERE l_orderkey % 5 <> 0 GROUP BY ALL), mode AS (SELECT page, arg_max(value, n * 1000 - value) AS background FROM levels GROUP BY page),
f AS (SELECT page, count(*) AS components FROM rectangles WHERE id > 2 GROUP BY page)
SELECT p.page, CASE WHEN background IS NOT NULL AND components > 0 THEN 'detected' ELSE 'fallback' END AS basis, background, CASE WHEN background IS NOT NULL THEN components END AS components, CASE WHEN background IS NOT NULL AND components > 0 THEN components ELSE 4 END AS regions
FROM (SELECT DISTINCT page FROM rectangles) p LEFT JOIN mode USING (page) LEFT JOIN f USING (page)""")
def k06_page_analysis(spark, d):
    """The background of a page, what stands out from it, or bands in its stead."""
    boxes = rectangles(spark, d)
    levels = table(spark, d, "lineitem").filter("l_orderkey % 5 <> 0").select(F.col("l_orderkey").alias("page"), F.expr("cast(l_quantity as bigint) div 10").alias("value"))
    return P.page_analysis(boxes.select("page").distinct(), levels, boxes.filter("id > 2"), 260, 320)


@query(f"""WITH {RECTANGLES}, a AS (SELECT * FROM rectangles WHERE id <= 2), b AS (SELECT * FROM rectangles WHERE id > 2),
s AS (SELECT a.page, a.id, a.w * a.h AS size, b.id AS g, CASE WHEN b.id IS NULL THEN 0 ELSE greatest(0, least(a.x + a.w, b.x + b.w) - greatest(a.x, b.x)) * greatest(0, least(a.y + a.h, b.y + b.h) - greatest(a.y, b.y)) END AS o FROM a LEFT JOIN b USING (page)),
m AS (SELECT page, id, size, max(o) AS top FROM s GROUP BY ALL), n AS (SELECT s.page, s.id, count(*) AS n, min(g) AS g, max(top) * 2 >= max(s.size) AND count(*) = 1 AS matched FROM s JOIN m ON s.page = m.page AND s.id = m.id AND s.o = m.top GROUP BY ALL),
w AS (SELECT page, g, count(*) AS owners FROM n WHERE matched AND page % 3 <> 0 GROUP BY ALL),
v AS (SELECT n.page, n.id, g, CASE WHEN n.page % 3 = 0 THEN NULL WHEN m.top * 2 < m.size THEN 'missed' WHEN n > 1 THEN 'tie' WHEN owners > 1 THEN 'claimed twice' END AS refused FROM n JOIN m USING (page, id) LEFT JOIN w USING (page, g))
SELECT page, id, CASE WHEN page % 3 = 0 THEN 'fallback' ELSE 'detected' END AS basis, CASE WHEN page % 3 <> 0 AND refused IS NULL THEN g ELSE 0 END AS body, CASE WHEN page % 3 <> 0 AND refused IS NULL THEN 1 ELSE 0 END AS anchors,
  CASE WHEN page % 3 = 0 THEN 'fallback band' WHEN refused IS NULL THEN 'single anchor' END AS rationale, refused FROM v""")
def k08_structural_evidence(spark, d):
    """What was found behind each declared box: the group that covers it, or that nothing was looked for."""
    boxes = rectangles(spark, d)
    groups = boxes.filter("id > 2").withColumns({"body": F.col("id"), "anchors": F.lit(1).cast("long"), "rationale": F.lit("single anchor")})
    analysis = boxes.select("page").distinct().withColumn("basis", F.when(F.col("page") % 3 == 0, "fallback").otherwise("detected"))
    return B.structural_evidence(boxes.filter("id <= 2"), groups, analysis).drop("bounds")


@query("""SELECT doc_id AS act, CASE doc_id % 7 WHEN 0 THEN 'held: page not sealed' WHEN 1 THEN 'held: page not sealed' WHEN 2 THEN 'held: page failed' WHEN 3 THEN 'held: continuation missing' ELSE 'proposed' END AS disposition FROM documents""")
def k07_declared_act(spark, d):
    """Every declared act is proposed, or held with the first reason that holds."""
    c = F.col
    k = c("doc_id") % 7
    acts = _docs(spark, d).select(c("doc_id").alias("act"), F.when(k == 1, -1).otherwise(c("doc_id")).alias("page"), F.when(k == 3, F.lit(-2)).when(k == 4, c("doc_id")).cast("long").alias("continues_on"))
    pages = _docs(spark, d).select(c("doc_id").alias("page"), F.when(k == 0, "refused").otherwise("sealed").alias("state"))
    return P.declared_acts(acts, pages, _docs(spark, d).filter(k.isin(0, 2)).select(c("doc_id").alias("page")))


@query(f"""WITH {RECTANGLES}, free AS (SELECT * FROM rectangles a WHERE id > 2 AND NOT EXISTS (SELECT 1 FROM rectangles b WHERE b.page = a.page AND b.id <= 2 AND least(a.x + a.w, b.x + b.w) > greatest(a.x, b.x) AND least(a.y + a.h, b.y + b.h) > greatest(a.y, b.y)))
SELECT page, 'residual:' || CAST(page AS VARCHAR) || ':' || CAST(row_number() OVER (PARTITION BY page ORDER BY y, x, id) - 1 AS VARCHAR) AS key, x, y, 'held' AS outcome FROM free""")
def k10_residual_acts(spark, d):
    """Components that no claim touches, held as acts under keys of their own."""
    boxes = rectangles(spark, d).select("page", "id", _box(*(F.col(c) for c in "xywh")).alias("box"))
    return P.residual_acts(boxes.filter("id > 2"), boxes.filter("id <= 2").select("page", "box")).select("page", "key", "box.x", "box.y", "outcome")


_BAD_RESIDUALS = ["not in the denominator", "counted twice", "of another page", "of another kind", "no such residual"]


@query(_expected("(SELECT doc_id, 'residual:' || CAST(doc_id AS VARCHAR) || ':0' AS key FROM documents)", "doc_id", _BAD_RESIDUALS, "key"))
def c14_residuals_reach_denominator(spark, d):
    """Every residual act is in the denominator once, as what it is, and no other one is."""
    c = F.col
    k = c("doc_id") % (len(_BAD_RESIDUALS) + 2)
    rows = _docs(spark, d).select("doc_id", F.concat(F.lit("residual:"), c("doc_id").cast("string"), F.lit(":0")).alias("key"), c("doc_id").alias("page"))
    kept = rows.filter(k != 0).select("doc_id", "key", F.when(k == 2, -1).otherwise(c("page")).alias("page"), F.when(k == 3, "declared").otherwise("residual").alias("kind"))
    others = rows.select(F.concat(F.lit("act:"), c("doc_id").cast("string")).alias("key"), "page", F.lit("declared").alias("kind"))
    return P.denominator_violations(rows.filter(k != 4).select("key", "page"), kept.unionByName(kept.filter(k == 1)).drop("doc_id").unionByName(others))


_ANCHOR = "alpha beta gamma delta epsilon zeta "


@query(f"""WITH b AS (SELECT doc_id AS page, doc_id % 4 AS k FROM documents), x AS (SELECT page, k, chair FROM b, (VALUES ('a'), ('b')) v(chair))
SELECT page, chair, act, NOT (k = 3 AND chair = 'b') AS attached, CASE WHEN k = 3 AND chair = 'b' THEN NULL ELSE s + CASE WHEN chair = 'b' THEN CASE k WHEN 1 THEN 3 WHEN 2 THEN CASE WHEN act = 'two' THEN -5 ELSE 0 END ELSE 0 END ELSE 0 END END AS start,
  CASE WHEN k = 3 AND chair = 'b' THEN NULL ELSE e + CASE WHEN chair = 'b' THEN CASE k WHEN 1 THEN 3 WHEN 2 THEN -5 ELSE 0 END ELSE 0 END END AS "end", CASE WHEN k = 3 AND chair = 'b' THEN 'no-common-anchor-text' END AS reason
FROM x, (VALUES ('one', 0, 17), ('two', 17, {len(_ANCHOR)})) t(act, s, e)""")
def k16_attachments(spark, d):
    """Each act's span in each chair's page text, from one alignment of the page with the anchor."""
    c = F.col
    base = _docs(spark, d).select(c("doc_id").alias("page"), (c("doc_id") % 4).alias("k"))
    other = F.when(c("k") == 1, "## " + _ANCHOR).when(c("k") == 2, _ANCHOR.replace("beta ", "")).when(c("k") == 3, "0123456789").otherwise(_ANCHOR)
    told = base.select("page", F.lit("a").alias("chair"), F.lit(_ANCHOR).alias("text")).unionByName(base.select("page", F.lit("b").alias("chair"), other.alias("text")))
    act = lambda name, a, b: F.struct(F.lit(name).alias("act"), F.lit(a).alias("start"), F.lit(b).alias("end"))
    anchors = base.select("page", F.lit(_ANCHOR).alias("text"), F.array(act("one", 0, 17), act("two", 17, len(_ANCHOR))).alias("acts"))
    return P.act_attachments(told, anchors)


_BAD_REPLAYS = ["characters", "blank", "truncated", "outcome", "regions"]


@query(_expected("(SELECT doc_id AS act FROM documents)", "act", _BAD_REPLAYS, "act, 'a' AS chair"))
def k17_replayed_health(spark, d):
    """Recorded health, outcome and regions against the same computed again."""
    c = F.col
    rows = _docs(spark, d).select(c("doc_id").alias("act"), F.lit("a").alias("chair"), F.concat(F.lit("x"), "text", F.lit(".")).alias("text")).withColumns({
        "completed": F.lit(True), "outcome": F.lit("read"), "blank": F.lit(False), "truncated": F.lit(False), "seen": F.array(F.lit("r1")), "characters": F.length("text"),
    })
    changes = [{"characters": c("characters") + 1}, {"blank": F.lit(True)}, {"truncated": F.lit(True)}, {"outcome": F.lit("genuinely-empty")}, {"seen": F.array(F.lit("r1"), F.lit("r9"))}]
    regions = _docs(spark, d).select(c("doc_id").alias("act"), F.explode(F.array(F.lit("r1"), F.lit("r2"))).alias("region"))
    return P.replay_violations(_planted(rows, "act", list(zip(_BAD_REPLAYS, changes, strict=True))), regions)


@query("""SELECT doc_id AS act, CASE doc_id % 4 WHEN 0 THEN 2 ELSE 3 END AS chairs, CASE doc_id % 4 WHEN 0 THEN 'c' WHEN 1 THEN 'b' ELSE '' END AS missing, CASE WHEN doc_id % 4 = 1 THEN 'z' ELSE '' END AS strangers, doc_id % 4 = 3 AS whole FROM documents""")
def k18_testimony_denominator(spark, d):
    """An act's chairs against the configured ones: missing, strangers, and chairs that testify twice."""
    c = F.col
    k = c("doc_id") % 4
    own = F.when(k == 0, F.array(F.lit("a"), F.lit("b"))).when(k == 1, F.array(F.lit("a"), F.lit("c"), F.lit("z"))).when(k == 2, F.array(F.lit("a"), F.lit("a"), F.lit("b"), F.lit("c"))).otherwise(F.array(F.lit("c"), F.lit("b"), F.lit("a")))
    now = _docs(spark, d).select(c("doc_id").alias("act"), F.explode(own).alias("chair"))
    return P.denominators(now, spark.createDataFrame([("a",), ("b",), ("c",)], "chair string"))


def _facts(spark, d):
    c = F.col
    k = c("act") % 5
    acts = _docs(spark, d).select(c("doc_id").alias("act"), F.explode(F.array(F.lit("a"), F.lit("b"), F.lit("c"))).alias("chair"))
    first = acts.select("act", "chair", F.lit(1).alias("ordinal"), F.when((k == 0) & (c("chair") != "a"), "failed").otherwise("read").alias("outcome"))
    again = first.filter((k == 1) & (c("chair") == "b")).withColumn("ordinal", F.lit(2))
    made = first.select("act", "chair", "ordinal", (~((k == 2) & (c("chair") != "a"))).alias("attached"), ((k == 3) & (c("chair") != "c")).alias("truncated"))
    return P.chair_facts(first.unionByName(again), made)


_FACTS = """f AS (SELECT doc_id AS act, doc_id % 5 AS k, chair FROM documents, (VALUES ('a'), ('b'), ('c')) c(chair))"""


@query(f"""WITH {_FACTS} SELECT act, chair, CASE WHEN k = 1 AND chair = 'b' THEN 2 ELSE 1 END AS ordinal, CASE WHEN k = 0 AND chair <> 'a' THEN 'failed' ELSE 'read' END AS outcome, NOT (k IN (0, 2) AND chair <> 'a') AS attached, k = 3 AND chair <> 'c' AS truncated, k = 1 AND chair = 'b' AS stale FROM f""")
def k26_attempt_facts(spark, d):
    """Each chair's current attempt beside the attachment that was made from it, or from an earlier one."""
    return _facts(spark, d)


@query("""SELECT doc_id AS act, CASE doc_id % 5 WHEN 1 THEN 'stale attachment' ELSE 'under the floor' END AS rule FROM documents WHERE doc_id % 5 < 4 UNION ALL SELECT doc_id, 'not the configured chairs' FROM documents WHERE doc_id % 25 = 4""")
def k27_chair_coverage(spark, d):
    """Stale attachments, chairs too few or too many, and too few attached readings."""
    facts = _facts(spark, d).filter("not (act % 25 = 4 and chair = 'c')")
    return P.coverage_violations(facts, spark.createDataFrame([("a",), ("b",), ("c",)], "chair string"), 2)


@query("""SELECT doc_id AS act, CASE WHEN doc_id % 7 = 5 THEN 'req-2' END AS request, CASE doc_id % 7 WHEN 0 THEN 'names a request without asking' WHEN 1 THEN 'asks without a request' WHEN 2 THEN 'request missing' WHEN 3 THEN 'a newer request exists' END AS rule FROM documents WHERE doc_id % 7 IN (0, 1, 2, 3, 5)""")
def k30_current_recovery_request(spark, d):
    """The request that an act's latest review asks for, by reference."""
    c = F.col
    k = c("act") % 7
    acts = _docs(spark, d).select(c("doc_id").alias("act"))
    first = acts.select("act", F.lit(1).alias("ordinal"), F.lit("recovery-requested").alias("outcome"), F.lit("req-1").alias("request_ref"))
    ref = F.when(k.isin(0, 5), "req-2").when(k == 2, "req-9").when(k == 3, "req-1")
    second = acts.select("act", F.lit(2).alias("ordinal"), F.when(k.isin(1, 2, 3, 5), "recovery-requested").otherwise("accepted").alias("outcome"), ref.alias("request_ref"))
    requests = acts.select("act", F.explode(F.array(F.lit(1), F.lit(2))).alias("ordinal")).withColumn("ref", F.concat(F.lit("req-"), c("ordinal").cast("string")))
    return P.current_requests(first.unionByName(second), requests)


_BAD_CROPS = ["crop of no region", "crop missing", "crop altered", "blank without every region"]


@query(_expected("(SELECT doc_id AS act FROM documents)", "act", _BAD_CROPS))
def k32_crop_closure(spark, d):
    """A record's crops are regions cut for it, by their bytes; a blank record shows every region."""
    c = F.col
    k = c("act") % (len(_BAD_CROPS) + 2)
    base = _docs(spark, d).select(c("doc_id").alias("act"), F.concat(c("doc_id").cast("string"), F.lit(" "), "text").alias("content"))
    blobs = base.filter(k != 1).select(_sha(c("content")).alias("sha256"), F.when(k == 2, "?").otherwise(c("content")).alias("content"))
    crop = F.struct(F.when(k == 0, "r9").otherwise("r1").alias("region"), _sha(c("content")).alias("sha256"))
    records = base.select("act", (k > 2).alias("blank"), F.array(crop).alias("crops"), F.when(k == 3, F.array(F.lit("r1"))).otherwise(F.array(F.lit("r2"), F.lit("r1"))).alias("seen"))
    regions = base.select("act", F.explode(F.array(F.lit("r1"), F.lit("r2"))).alias("region"))
    return P.crop_closure_violations(records, regions, blobs)


_BAD_SERVING = ["state", "model", "revision", "engine", "configuration", "receipt", "receipt of a synthetic run", "names what didn't run"]


@query(_expected("documents", "doc_id", _BAD_SERVING))
def k51_serving_provenance(spark, d):
    """What a chair's provenance has to name of what it ran."""
    c = F.col
    rows = _docs(spark, d).select("doc_id", F.lit("configured").alias("state"), F.lit("model-1").alias("model"), F.left(_sha(c("text")), F.lit(40)).alias("revision"), F.lit("engine-1").alias("engine"), _sha(F.lit("c")).alias("config_sha256"), F.lit("receipts/1").alias("receipt"), F.lit(False).alias("fixture"))
    changes = [{"state": F.lit("dreaming"), "model": _null(), "revision": _null(), "receipt": _null()}, {"model": F.lit(" ")}, {"revision": F.lit("main")}, {"engine": _null()}, {"config_sha256": F.lit("x")}, {"receipt": _null()}, {"fixture": F.lit(True)}, {"state": F.lit("not-configured")}]
    return P.provenance_violations(_planted(rows, "doc_id", list(zip(_BAD_SERVING, changes, strict=True))), ["doc_id"], c("fixture"))


_BAD_EXPORTS = ["not in the manifest, rows", "not in the export", "member twice", "digest, bytes", "bytes", "rows"]


@query(f"""WITH m AS (SELECT doc_id, 'm-' || CAST(doc_id AS VARCHAR) AS member FROM documents) {_expected("m", "doc_id", ["not in the manifest", *_BAD_EXPORTS[1:]], "member")}""")
def c15_export_claims(spark, d):
    """A manifest's claims against the members of the export and the rows of their sources."""
    c = F.col
    k = c("doc_id") % (len(_BAD_EXPORTS) + 2)
    base = _docs(spark, d).select("doc_id", F.concat(F.lit("m-"), c("doc_id").cast("string")).alias("member"), c("text").alias("content"))
    claims = base.filter(k != 0).select("member", _sha(c("content")).alias("sha256"), (F.octet_length("content") + F.when(k == 4, 1).otherwise(0)).alias("bytes"), F.when(k == 5, 9).otherwise(2).alias("rows"))
    members = base.filter(k != 1).select("doc_id", "member", F.when(k == 3, F.concat("content", F.lit("!"))).otherwise(c("content")).alias("content"))
    sources = base.select("member", F.explode(F.array(F.lit(1), F.lit(1))).alias("rows"))
    return P.export_violations(claims, members.unionByName(members.filter(k == 2)).drop("doc_id"), sources)
