"""Queries of layers over texts and pages; see plans/records for how faults are planted."""

from __future__ import annotations

from pyspark.sql import functions as F

from lectern.functions import canonical as C
from lectern.functions import display as D
from lectern.functions import geometry as G
from lectern.functions import text as T
from lectern.operators import layers as L
from lectern.plans.records import _expected, _planted
from lectern.plans.registry import Registry
from lectern.sources.tables import ATTEMPTS, RECTANGLES, attempts, rectangles, table

query = Registry()


def _docs(spark, d):
    return table(spark, d, "documents")


# --- text layers -------------------------------------------------------------------------------------------------


@query("""SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'not-compared' WHEN doc_id % 2 = 0 OR doc_id % 5 = 0 THEN 'compared' ELSE 'unknown' END AS status FROM documents""")
def p05_comparability(spark, d):
    """By the format that a witness declares: one that may hold markup is compared by a view without it, or not at all."""
    i = F.col("doc_id")
    rows = _docs(spark, d).select("doc_id", F.struct((i % 2 == 1).alias("can_express_uncertainty")).alias("format"), F.when(i % 5 == 0, F.col("text")).alias("view"), F.when(i % 3 == 0, "failed").otherwise("read").alias("outcome"))
    return rows.select("doc_id", L.comparability(F.col("format.can_express_uncertainty"), F.col("view"), F.col("outcome")).alias("status"))


@query("""SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN '$.text' WHEN 1 THEN '$.parts[1].literal' WHEN 2 THEN '$.meta.text,$.meta.text.literal' WHEN 3 THEN '$ isn''t JSON' END AS paths FROM documents WHERE doc_id % 5 < 4""")
def p07_forbidden_fields(spark, d):
    """Where payloads hold a key that evidence may not carry, at any depth; a value that reads like one is none."""
    i = F.col("doc_id")
    payload = F.when(i % 5 == 0, '{"text": 1, "n": [2]}').when(i % 5 == 1, '{"parts": [{"a": 1}, {"literal": "x"}]}').when(i % 5 == 2, '{"meta": {"text": {"literal": null}}}').when(i % 5 == 3, '{"text": ').otherwise('{"say": "\\"text\\": 1", "n": ["literal"]}')
    return _docs(spark, d).select("doc_id", F.array_join(L.forbidden_keys(payload, {"text", "literal"}), ",").alias("paths")).filter("paths <> ''")


_BAD_FINDINGS = ["fields", "fields", "count acts", "count acts", "word state"]


@query(_expected("documents", "doc_id", _BAD_FINDINGS))
def p08_public_projection(spark, d):
    """Findings that may be published: allowed fields alone, whole counts, words of a closed vocabulary."""
    line = F.to_json(F.struct(F.length("text").alias("acts"), F.lit("partial").alias("state")))
    rows = _docs(spark, d).select("doc_id", "text", line.alias("line"))
    bad = ['{"acts": 3, "state": "partial", "name": "x"}', '{"acts": 3}', '{"acts": -3, "state": "partial"}', '{"acts": 0.5, "state": "complete"}', '{"acts": 3, "state": "ask Ann"}']
    return L.public_violations(_planted(rows, "doc_id", [(r, {"line": F.lit(b)}) for r, b in zip(_BAD_FINDINGS, bad, strict=True)]), ["doc_id"], "line", ["acts"], {"state": ("complete", "partial")})


_BAD_LAYERS = [
    "span outside the text, gap inside a span", "span outside the text", "confidence", "spans overlap", "gap outside the text, trailing gap", "gap of some width", "gap's place", "leading gap", "trailing gap", "internal gap", "whole-act gap", "gap inside a span",
]


@query(_expected("documents", "doc_id", _BAD_LAYERS))
def f28_uncertainty_layer(spark, d):
    """Spans and gaps that anchor exactly to their text, one fault of each rule."""
    n = F.length("text")
    span = lambda a, b, c="low": F.struct(F.lit(a).alias("start"), (F.lit(b) if isinstance(b, int) else b).alias("end"), F.lit(c).alias("confidence"))
    gap = lambda p, a, b=None: F.struct(F.lit(p).alias("position"), (F.lit(a) if isinstance(a, int) else a).alias("start"), (F.lit(a if b is None else b) if isinstance(a, int) else a if b is None else b).alias("end"))
    rows = _docs(spark, d).select("doc_id", F.concat(F.lit("x" * 40), "text").alias("text")).withColumns({"spans": F.array(span(2, 5), span(5, 9, "high")), "gaps": F.array(gap("leading", 0), gap("internal", 5), gap("trailing", n))})
    changes = [
        {"spans": F.array(span(6, n + 1))}, {"spans": F.array(span(4, 4))}, {"spans": F.array(span(2, 5, "sure"))}, {"spans": F.array(span(2, 6), span(5, 9)), "gaps": F.array(gap("leading", 0))}, {"gaps": F.array(gap("trailing", n + 2))}, {"gaps": F.array(gap("internal", 10, 12))}, {"gaps": F.array(gap("somewhere", 10))},
        {"gaps": F.array(gap("leading", 1))}, {"gaps": F.array(gap("trailing", 12))}, {"gaps": F.array(gap("internal", 0))}, {"gaps": F.array(gap("whole-act", 0))}, {"gaps": F.array(gap("internal", 3))},
    ]
    return L.uncertainty_violations(_planted(rows, "doc_id", list(zip(_BAD_LAYERS, changes, strict=True))), ["doc_id"])


@query(f"""WITH {ATTEMPTS} SELECT subject_id, ordinal, CASE WHEN ordinal % 5 = 0 THEN 'failed' WHEN ordinal % 5 = 1 THEN 'truncated' WHEN trim(text) = '' OR ordinal % 5 = 2 THEN 'no-readable-text' ELSE 'read' END AS outcome FROM attempts""")
def k22_outcome_resolution(spark, d):
    """A declared failure, then a cut-off reading by the engine's word, then an empty one."""
    c = F.col
    k = c("ordinal") % 5
    text = F.when(k == 2, "  ").otherwise(c("text"))
    word = F.when(k == 1, "truncated").otherwise("complete")
    return attempts(spark, d).select("subject_id", "ordinal", L.resolved_outcome(F.when(k == 0, "failed"), word, text).alias("outcome"))


@query(f"""WITH {ATTEMPTS} SELECT subject_id, ordinal, CASE WHEN ordinal % 3 = 0 THEN 'truncated' WHEN ordinal % 3 = 2 OR (length(text) - length(replace(text, '(', ''))) <> (length(text) - length(replace(text, ')', ''))) OR (length(text) - length(replace(text, '[', ''))) <> (length(text) - length(replace(text, ']', '')))
  OR (length(text) - length(replace(text, '“', ''))) <> (length(text) - length(replace(text, '”', ''))) OR (length(text) > 0 AND 1000 > 2000 * length(text)) OR ends_with(rtrim(text), '-') THEN 'unknown' ELSE 'complete' END AS classification FROM attempts""")
def f20_truncation(spark, d):
    """The whole classification: the engine's word first, then the vote of three signals."""
    word = F.when(F.col("ordinal") % 3 == 0, "length").when(F.col("ordinal") % 3 == 1, "stop")
    return attempts(spark, d).select("subject_id", "ordinal", T.truncation(F.col("text"), F.lit(1000), word).alias("classification"))


@query("""SELECT event_id, CASE WHEN event_id % 11 = 0 THEN 'exception' WHEN event_id % 7 = 0 THEN 'wrong type' WHEN event_id % 5 = 0 THEN 'prompt receipt mismatch' WHEN event_id % 3 = 0 THEN 'dossier receipt mismatch' WHEN event_id % 2 = 0 THEN 'delivery receipt mismatch' ELSE 'answered' END AS kind FROM events""")
def k46_failed_attempts(spark, d):
    """By the receipts of what was sent and what the reader saw, the first that differs."""
    i = F.col("event_id")
    sha = lambda k: F.sha2(F.concat(F.lit(k), i.cast("string")), 256)
    names = [k for k, _ in L.RECEIPTS]
    rows = table(spark, d, "events").select("event_id", (i % 11 != 0).alias("came"), F.when(i % 7 == 0, "text").otherwise("response").alias("type"), *(sha(k).alias("sent_" + k) for k in names), *(F.when(i % n == 0, sha("?")).otherwise(sha(k)).alias("seen_" + k) for k, n in zip(names, (5, 3, 2), strict=True)))
    return rows.select("event_id", L.attempt_kind(F.col("came"), F.col("type"), {k: F.col("sent_" + k) for k in names}, {k: F.col("seen_" + k) for k in names}).alias("kind"))


@query(None)
def k48_text_lineage(spark, d):
    """A text's own digest and those of its normalized forms, each once."""
    forms = F.array(F.sha2("text", 256), F.sha2(T.comparison_view("text"), 256), F.sha2(T.graphemic_view("text"), 256), F.sha2(T.search_key("text"), 256))
    return _docs(spark, d).select("doc_id", F.array_join(F.array_distinct(forms), ",").alias("lineage"))


_SHOWN = ["span outside the text", "spans overlap", "gap past the end", "gap inside a span"]


@query(f"""SELECT doc_id, CASE doc_id % 6 {" ".join(f"WHEN {k} THEN '{r}'" for k, r in enumerate(_SHOWN))} ELSE 'same' END AS shown FROM documents""")
def f24_display_round_trip(spark, d):
    """Texts with doubts and gaps, shown and read back; what can't be shown is refused by name."""
    n = F.length("text")
    doubts = lambda *s: F.array(*[F.struct(F.lit(a).alias("start"), (F.lit(b) if isinstance(b, int) else b).alias("end")) for a, b in s])
    gaps = lambda *s: F.array(*[F.struct((F.lit(p) if isinstance(p, int) else p).alias("position"), F.lit("torn").alias("kind")) for p in s])
    rows = _docs(spark, d).select("doc_id", F.concat(F.lit("⟦a\\⟩ b⟧c⟨ "), "text").alias("text")).withColumns({"doubts": doubts((1, 4), (4, 9)), "gaps": gaps(1, 4, n)})
    changes = [{"doubts": doubts((1, n + 1)), "gaps": gaps(0)}, {"doubts": doubts((1, 4), (3, 9))}, {"gaps": gaps(n + 1)}, {"gaps": gaps(2)}]
    bad = _planted(rows, "doc_id", list(zip(_SHOWN, changes, strict=True)))
    return bad.select("doc_id", D.display_round_trip("text", "doubts", "gaps").alias("shown"))


@query("""SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN 'repetition' WHEN 1 THEN 'order' WHEN 2 THEN 'outside every flag' WHEN 3 THEN 'testimony-diff' END AS flag FROM documents""")
def f12_change_attribution(spark, d):
    """The class of the narrowest flag that holds all of a change; ties by start, then class; nothing without a change."""
    c = F.col
    before = F.concat(F.lit("0123456789" * 6), "text")
    at = lambda a, b: F.concat(F.left("before", F.lit(a)), F.lit("#"), F.substr("before", F.lit(b + 1), F.length("before")))
    k = c("doc_id") % 5
    after = F.when(k == 0, at(12, 14)).when(k == 1, at(5, 40)).when(k == 2, at(1, 55)).when(k == 3, at(31, 33)).otherwise(c("before"))
    flags = [(0, 50, "order"), (10, 20, "repetition"), (30, 40, "testimony-diff"), (30, 40, "year-order"), (8, 20, "year-order")]
    spans = F.array(*[F.struct(F.lit(a).alias("start"), F.lit(b).alias("end"), F.lit(w).alias("class")) for a, b, w in flags])
    rows = _docs(spark, d).select("doc_id", before.alias("before")).withColumn("after", after)
    return rows.select("doc_id", D.change_class("before", "after", spans).alias("flag"))


@query("""SELECT doc_id, CASE WHEN doc_id % 3 < 2 THEN '0123456789' || CASE WHEN doc_id % 3 = 0 THEN 'AAAA' ELSE 'BBBBB' END || 'klmnopqrst' || CASE WHEN doc_id % 2 = 0 THEN 'DD' ELSE 'CCC' END || 'uvwxyz' END AS text FROM documents""")
def f19_adjudicated_text(spark, d):
    """A draft rebuilt from the choices made for its disagreements; choices that aren't exactly those are refused."""
    c = F.col
    i = c("doc_id")
    first, second = F.lit("0123456789AAAAklmnopqrstCCCuvwxyz"), F.lit("0123456789BBBBBklmnopqrstDDuvwxyz")
    choice = lambda a, b, t: F.struct(F.lit(a).alias("start"), F.lit(b).alias("end"), t.alias("text"))
    one = choice(10, 14, F.when(i % 3 == 0, "AAAA").otherwise("BBBBB"))
    both = F.array(one, choice(24, 27, F.when(i % 2 == 0, "DD").otherwise("CCC")))
    return _docs(spark, d).select("doc_id", D.adjudicated(first, second, F.when(i % 3 == 2, F.array(one)).otherwise(both)).alias("text"))


@query("""SELECT doc_id, CASE doc_id % 7 WHEN 0 THEN 'document type' WHEN 1 THEN 'not one output element' WHEN 2 THEN 'not one output element' WHEN 3 THEN 'malformed' WHEN 4 THEN 'element inside' END AS fault, CASE WHEN doc_id % 7 > 4 THEN sha256(lang || ' & <' || source || '>') END AS text_sha256 FROM documents""")
def f23_plain_output(spark, d):
    """Whether an answer is one <output> element of plain text, and that text with its entities decoded."""
    c = F.col
    k = c("doc_id") % 7
    inside = F.concat("lang", F.lit(" &amp; &lt;"), "source", F.lit(">"))
    whole = F.concat(F.lit("<output>"), inside, F.lit("</output>"))
    xml = (
        F.when(k == 0, F.concat(F.lit("<!DOCTYPE output>"), whole)).when(k == 1, F.lit("<answer>x</answer>")).when(k == 2, F.concat(F.lit("text "), whole)).when(k == 3, F.lit("<output>a</outpu>")).when(k == 4, F.lit("<output>a<b/>c</output>"))
        .when(k == 5, F.concat(F.lit(" <?xml version='1.0'?>\n"), whole, F.lit("\n"))).otherwise(whole)
    )
    return _docs(spark, d).select("doc_id", T.plain_output(xml).alias("o")).select("doc_id", "o.fault", F.sha2("o.text", 256).alias("text_sha256"))


# --- pages ----------------------------------------------------------------------------------------------------------------


def _box(*xywh):
    return G.box(*(F.lit(v).cast("long") if isinstance(v, int) else v for v in xywh))


@query(None)
def g14_residual_ink(spark, d):
    """Ink outside every region cut for its page, by geometry."""
    boxes = rectangles(spark, d)
    covered = boxes.filter("id <= 2").select("page", _box(*(F.col(c) for c in "xywh")).alias("box"))
    places = F.explode(F.array(*[_box(50 * k, 60 * k, 40, 30) for k in range(4)]))
    return L.residual_ink(boxes.select("page").distinct().select("page", places.alias("box")), covered)


@query(f"""WITH {RECTANGLES}, p AS (SELECT a.page, a.id, b.id AS other, b.x <= a.x AND b.y <= a.y AND b.x + b.w >= a.x + a.w AND b.y + b.h >= a.y + a.h AS holds, a.x <= b.x AND a.y <= b.y AND a.x + a.w >= b.x + b.w AND a.y + a.h >= b.y + b.h AS held,
  least(a.x + a.w, b.x + b.w) > greatest(a.x, b.x) AND least(a.y + a.h, b.y + b.h) > greatest(a.y, b.y) AS meets FROM rectangles a LEFT JOIN rectangles b ON a.page = b.page AND a.id <> b.id)
SELECT page, id, CASE WHEN page % 4 < 2 THEN 'review' ELSE 'accepted-coverage' END AS disposition, CASE page % 4 WHEN 0 THEN 'stain' WHEN 1 THEN 'stain,tape' ELSE '' END AS occlusions,
  coalesce(string_agg(CAST(other AS VARCHAR), ',' ORDER BY other) FILTER (holds), '') AS inside, coalesce(string_agg(CAST(other AS VARCHAR), ',' ORDER BY other) FILTER (meets AND NOT holds AND NOT held), '') AS overlaps FROM p GROUP BY page, id""")
def g17_resolution(spark, d):
    """Every proposal once, with what contains it and what cuts across it; any occlusion on the page asks for review."""
    boxes = rectangles(spark, d).select("page", "id", _box(*(F.col(c) for c in "xywh")).alias("box"))
    pages = boxes.select("page").distinct()
    seen = pages.filter("page % 4 < 2").select("page", F.lit("stain").alias("occlusion_id")).unionByName(pages.filter("page % 4 = 1").select("page", F.lit("tape").alias("occlusion_id")))
    found = L.resolution(boxes, seen)
    told = lambda c: F.array_join(F.col(c).cast("array<string>"), ",").alias(c)
    return found.select("page", "id", "disposition", F.array_join("occlusion_ids", ",").alias("occlusions"), told("inside"), told("overlaps"))


@query("""WITH p AS (SELECT DISTINCT l_orderkey AS page, 100 + l_orderkey % 300 AS w, 90 + l_orderkey % 200 AS h FROM lineitem), g AS (SELECT page, w, h, k, o FROM p, (VALUES (0, 0), (1, 50)) v(k, o)),
y AS (SELECT *, unnest(range(o, h, 100)) AS y FROM g), x AS (SELECT *, unnest(range(0, w, 96)) AS x FROM y) SELECT page, k AS pass_ordinal, x, y, least(120, w - x) AS w, least(100, h - y) AS h FROM x""")
def g09_tile_grid(spark, d):
    """Overlapping tiles, the whole grid twice: from the top, and from half a tile down."""
    pages = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("page")).distinct()
    found = pages.select("page", F.explode(L.tiles(100 + F.col("page") % 300, 90 + F.col("page") % 200, 120, 100, 24, 50)).alias("t"))
    return found.select("page", "t.*")


@query("""SELECT 'act' AS unit, CAST(doc_id AS VARCHAR) AS subject, CASE doc_id % 6 WHEN 0 THEN 'names no page' WHEN 1 THEN 'on a page nobody counted' WHEN 2 THEN 'on a page that wasn''t sealed' END AS rule FROM documents WHERE doc_id % 6 < 3
UNION ALL SELECT 'act', CAST(-doc_id AS VARCHAR), 'unknown act' FROM documents WHERE doc_id % 12 = 3 UNION ALL SELECT 'page', CAST(doc_id AS VARCHAR), 'sealed and silent' FROM documents WHERE doc_id % 6 IN (0, 1)""")
def c05_attribution(spark, d):
    """Acts and the pages that they are marked out on, and sealed pages on which there is none."""
    c = F.col
    acts = _docs(spark, d).select(c("doc_id").alias("act"))
    marked = acts.filter("act % 6 <> 0").select("act", F.when(c("act") % 6 == 1, -c("act")).otherwise(c("act")).alias("page"))
    strangers = acts.filter("act % 12 = 3").select((-c("act")).alias("act"), c("act").alias("page"))
    pages = acts.select(c("act").alias("page"), F.when(c("act") % 6 == 2, "refused").otherwise("sealed").alias("outcome"))
    return L.attribution_violations(acts, marked.unionByName(strangers), pages)


_BAD_CUSTODY = ["binding altered", "blob missing", "blob altered", "receipt missing", "receipt of another page", "two bindings"]


@query(_expected("(SELECT doc_id AS page FROM documents)", "page", _BAD_CUSTODY))
def k53_response_custody(spark, d):
    """One retained answer, one receipt and one page, tied by digests."""
    c = F.col
    n = len(_BAD_CUSTODY) + 2
    fault = lambda k: c("page") % n == k
    base = _docs(spark, d).select(c("doc_id").alias("page"), F.concat(c("doc_id").cast("string"), F.lit(" "), "text").alias("content"))
    bound = base.select("page", F.sha2(F.concat(F.lit("receipt "), c("page").cast("string")), 256).alias("receipt_sha256"), F.sha2("content", 256).alias("response_sha256"))
    bound = bound.withColumn("self_sha256", C.digest(C.record(page=c("page"), receipt_sha256=c("receipt_sha256"), response_sha256=c("response_sha256"))))
    bound = bound.withColumn("self_sha256", F.when(fault(0), "?").otherwise(c("self_sha256")))
    blobs = base.filter(~fault(1)).select(F.sha2("content", 256).alias("sha256"), F.when(fault(2), "?").otherwise(c("content")).alias("content"))
    receipts = bound.filter(~fault(3)).select(c("receipt_sha256").alias("sha256"), F.when(fault(4), -c("page")).otherwise(c("page")).alias("page"))
    return L.custody_violations(bound.unionByName(bound.filter(fault(5))), blobs, receipts)


@query("""SELECT doc_id AS region, CASE doc_id % 5 WHEN 0 THEN 'of an unknown act' WHEN 1 THEN 'on a page of another act' WHEN 2 THEN 'on an unsealed page' END AS rule FROM documents WHERE doc_id % 5 < 3""")
def k39_region_binding(spark, d):
    """Regions, the acts that they were cut for, and the sealed pages that these are marked out on."""
    c = F.col
    k = c("doc_id") % 5
    regions = _docs(spark, d).select(c("doc_id").alias("region"), F.when(k == 0, -1 - c("doc_id")).otherwise(c("doc_id")).alias("act"), (c("doc_id") - F.when(k == 1, 1).otherwise(0)).alias("page"))
    acts = _docs(spark, d).select(c("doc_id").alias("act"), c("doc_id").alias("page"))
    pages = _docs(spark, d).select(c("doc_id").alias("page"), (k != 2).alias("sealed"))
    return L.region_binding_violations(regions, acts, pages)


@query("""SELECT doc_id, CASE doc_id % 6 WHEN 0 THEN 'in both' WHEN 1 THEN 'in neither' WHEN 2 THEN 'not selected' WHEN 3 THEN 'status' END AS rule FROM documents WHERE doc_id % 6 < 4""")
def k43_sample_accounting(spark, d):
    """Scoreable and excluded members are apart, selected, and the whole sample."""
    c = F.col
    k = c("doc_id") % 6
    docs = _docs(spark, d).select("doc_id", F.lit("established").alias("status"))
    scored = docs.filter((k != 1) & (k != 5)).withColumn("status", F.when(k == 3, "partial").otherwise(c("status")))
    return L.sample_violations(docs.filter(k != 2), scored, docs.filter((k == 0) | (k == 5)), "doc_id")
