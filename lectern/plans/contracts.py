"""Queries of record contracts and composite operators."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from lectern.functions import canonical as C
from lectern.functions import geometry as G
from lectern.functions import text as T
from lectern.operators import accounting as A
from lectern.operators import contracts as K
from lectern.operators import reconcile as R
from lectern.plans.registry import Registry
from lectern.sources.tables import ATTEMPTS, CURRENT, READINGS, RECTANGLES, attempts, current_readings, readings, rectangles, table

query = Registry()


def _docs(spark, d):
    return table(spark, d, "documents")


# --- joins and reconciliations ------------------------------------------------------------------------------


@query("""WITH a AS (SELECT doc_id AS ordinal, lang, source FROM documents WHERE doc_id % 9 <> 4), b AS (SELECT doc_id AS ordinal, lang, CASE WHEN doc_id % 6 = 0 THEN 'moved' ELSE source END AS source FROM documents)
SELECT b.ordinal, CASE WHEN a.ordinal IS NULL THEN 'right-only' WHEN a.source = b.source THEN 'agrees' ELSE 'differs' END AS status FROM b LEFT JOIN a USING (ordinal)""")
def j04_admissions_and_authority(spark, d):
    docs = _docs(spark, d).select(F.col("doc_id").alias("ordinal"), "lang", "source")
    moved = docs.withColumn("source", F.when(F.col("ordinal") % 6 == 0, "moved").otherwise(F.col("source")))
    return R.reconcile(docs.filter("ordinal % 9 <> 4"), moved, ["ordinal"], ["lang", "source"])


@query(f"""WITH {RECTANGLES} SELECT page, id, 'missing' AS side FROM rectangles WHERE id > 3 AND page % 5 = 0""")
def j07_components_and_residuals(spark, d):
    parts = rectangles(spark, d).filter("id > 3").select("page", "id")
    return R.difference(parts, parts.filter("page % 5 <> 0"))


@query("""SELECT l.l_orderkey AS page, l.l_linenumber AS region, c.c_custkey AS source FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey AND o.o_orderstatus = 'O' JOIN customer c ON c.c_custkey = o.o_custkey AND c.c_acctbal > 0""")
def j15_crop_lineage(spark, d):
    sealed = table(spark, d, "orders").filter("o_orderstatus = 'O'")
    sources = table(spark, d, "customer").filter("c_acctbal > 0")
    crops = table(spark, d, "lineitem").join(sealed, F.col("o_orderkey") == F.col("l_orderkey")).join(sources, F.col("c_custkey") == F.col("o_custkey"))
    return crops.select(F.col("l_orderkey").alias("page"), F.col("l_linenumber").alias("region"), F.col("c_custkey").alias("source"))


_PLACES = "placed AS (SELECT act, outcome, row_number() OVER (PARTITION BY act, outcome ORDER BY attempt) AS ordinal FROM readings)"


def _placed(spark, d, outcome):
    rows = readings(spark, d).filter(F.col("outcome") == outcome)
    return rows.select("act", F.row_number().over(Window.partitionBy("act", "outcome").orderBy("attempt")).alias("ordinal"))


@query(f"""WITH {READINGS}, {_PLACES}, k AS (SELECT DISTINCT act, ordinal FROM placed WHERE outcome IN ('failed', 'not-run', 'read')),
f AS (SELECT act, ordinal, EXISTS (SELECT 1 FROM placed p WHERE p.act = k.act AND p.ordinal = k.ordinal AND p.outcome = 'failed') AS request, EXISTS (SELECT 1 FROM placed p WHERE p.act = k.act AND p.ordinal = k.ordinal AND p.outcome = 'not-run') AS review,
 EXISTS (SELECT 1 FROM placed p WHERE p.act = k.act AND p.ordinal = k.ordinal AND p.outcome = 'read') AS reread FROM k) SELECT *, CASE WHEN request AND review AND reread THEN 'paired' ELSE 'unpaired' END AS verdict FROM f""")
def j16_recovery_pairs(spark, d):
    return K.paired({"request": _placed(spark, d, "failed"), "review": _placed(spark, d, "not-run"), "reread": _placed(spark, d, "read")}, ["act", "ordinal"])


@query("""SELECT lang, source, 'missing' AS side FROM (SELECT lang, source FROM documents EXCEPT ALL SELECT lang, source FROM documents WHERE doc_id % 7 <> 0)""")
def x04_difference_with_multiplicity(spark, d):
    docs = _docs(spark, d)
    return R.difference(docs.select("lang", "source"), docs.filter("doc_id % 7 <> 0").select("lang", "source"))


# --- text ---------------------------------------------------------------------------------------------------------


@query(None)
def f04_units(spark, d):
    scored = table(spark, d, "benchmark").select("item_id", T.character_score("text", "text").alias("c"), T.word_score("text", "text").alias("w"))
    return scored.select("item_id", F.col("c.reference_units").alias("characters"), F.col("w.reference_units").alias("words"))


@query("""SELECT doc_id, trim(split_part(CASE WHEN doc_id % 2 = 0 THEN 'corrupt : bad byte: 3' ELSE 'empty' END, ':', 1)) AS code FROM documents""")
def f29_reason_code(spark, d):
    detail = F.when(F.col("doc_id") % 2 == 0, "corrupt : bad byte: 3").otherwise("empty")
    return _docs(spark, d).select("doc_id", A.reason_code(detail).alias("code"))


@query("""SELECT doc_id, sha256('{"id":' || CAST(doc_id AS VARCHAR) || ',"rate":' || CAST(n_chars / 8.0::DOUBLE AS VARCHAR) || ',"share":' || CASE WHEN n_chars % 2 = 0 THEN 'null' ELSE CAST(n_chars % 7 / 4.0::DOUBLE AS VARCHAR) END || '}') AS digest FROM documents""")
def f32_measurement_record(spark, d):
    """Measured rates, which are fractions or missing, in canonical form."""
    n = F.col("n_chars")
    return _docs(spark, d).select("doc_id", C.digest(C.record(id=F.col("doc_id"), rate=n / F.lit(8.0), share=F.when(n % 2 == 1, n % 7 / F.lit(4.0)))).alias("digest"))


# --- geometry ---------------------------------------------------------------------------------------------------------


@query(f"""WITH {RECTANGLES}, c AS (SELECT * FROM rectangles WHERE id = 1), i AS (SELECT r.page, r.w * r.h AS ink, greatest(0, least(r.x + r.w, c.x + c.w) - greatest(r.x, c.x)) * greatest(0, least(r.y + r.h, c.y + c.h) - greatest(r.y, c.y)) AS claimed
 FROM rectangles r JOIN c USING (page) WHERE r.id > 1) SELECT page, CAST(sum(ink) AS BIGINT) AS total, CAST(sum(claimed) AS BIGINT) AS claimed, CAST(sum(ink - claimed) AS BIGINT) AS residual, true AS conserved FROM i GROUP BY page""")
def g15_ink_conservation(spark, d):
    """Every unit of ink is claimed or residual; the residual is counted from the pieces that claims leave."""
    boxes = rectangles(spark, d).select("page", "id", G.box(*(F.col(c) for c in "xywh")).alias("b"))
    claims = boxes.filter("id = 1").groupBy("page").agg(F.collect_list("b").alias("claims"))
    ink = boxes.filter("id > 1").join(claims, "page").select("page", (F.col("b.w") * F.col("b.h")).alias("ink"), G.area(G.remaining(F.col("b"), F.col("claims"))).alias("residual"), F.aggregate("claims", F.lit(0).cast("long"), lambda n, c: n + G.overlap_area(F.col("b"), c)).alias("claimed"))
    sums = ink.groupBy("page").agg(F.sum("ink").alias("total"), F.sum("claimed").alias("claimed"), F.sum("residual").alias("residual"))
    return sums.withColumn("conserved", F.col("claimed") + F.col("residual") == F.col("total"))


# --- contracts -----------------------------------------------------------------------------------------------------------


@query("""SELECT cell, sha256('{"cell":"' || cell || '","measures":["seconds"],"state":"not-run"}') AS seal FROM (VALUES ('B0'), ('B0.5'), ('B2'), ('B3'), ('B4'), ('B5'), ('B5a'), ('B6')) t(cell)""")
def c19_sealed_cells(spark, d):
    cells = spark.createDataFrame([(c,) for c in ("B0", "B0.5", "B2", "B3", "B4", "B5", "B5a", "B6")], "cell string")
    return cells.select("cell", C.digest(C.record(cell=F.col("cell"), state=F.lit("not-run"), measures=F.array(F.lit("seconds")))).alias("seal"))


# --- composites ---------------------------------------------------------------------------------------------------------------


@query("""WITH l AS (SELECT source, doc_id, sha256('{"doc_id":' || CAST(doc_id AS VARCHAR) || ',"lang":"' || lang || '"}') AS line FROM documents) SELECT source, count(*) AS n, sha256(string_agg(line, chr(10) ORDER BY doc_id)) AS seal FROM l GROUP BY source""")
def k04_corpus_seal(spark, d):
    return K.sealed(_docs(spark, d), ["source"], "doc_id", ["lang"])


@query(f"""WITH {RECTANGLES}, p AS (SELECT page, id, greatest(0, x - (w * 500 + 5000) // 10000) AS x, greatest(0, y - (h * 500 + 5000) // 10000) AS y, least(260, x + w + (w * 500 + 5000) // 10000) AS x1, least(320, y + h + (h * 500 + 5000) // 10000) AS y1 FROM rectangles)
SELECT page, id, 'rgn_' || left(sha256('{{"bindings":{{"act_id":"act-' || CAST(page AS VARCHAR) || '-' || CAST(id AS VARCHAR) || '","transform":{{"h":' || CAST(y1 - y AS VARCHAR) || ',"w":' || CAST(x1 - x AS VARCHAR) || ',"x":' || CAST(x AS VARCHAR) || ',"y":' || CAST(y AS VARCHAR) || '}}}},"kind":"region"}}'), 16) AS region_id FROM p""")
def k09_region_cut(spark, d):
    boxes = rectangles(spark, d).select("page", "id", G.padded(G.box(*(F.col(c) for c in "xywh")), 260, 320, 500, 500, 500, 500).alias("p"))
    cut = C.record(x=F.col("p.bounds.x"), y=F.col("p.bounds.y"), w=F.col("p.bounds.w"), h=F.col("p.bounds.h"))
    act = F.concat(F.lit("act-"), F.col("page").cast("string"), F.lit("-"), F.col("id").cast("string"))
    return boxes.select("page", "id", C.identity("region", act_id=act, transform=cut).alias("region_id"))


@query(f"""WITH {RECTANGLES}, a AS (SELECT * FROM rectangles WHERE id = 1), b AS (SELECT * FROM rectangles WHERE id = 2) SELECT a.page, CASE WHEN b.x <= a.x AND b.y <= a.y AND b.x + b.w >= a.x + a.w AND b.y + b.h >= a.y + a.h THEN 'adds nothing' ELSE 'allowed' END AS verdict FROM a JOIN b USING (page)""")
def k12_recrop_guard(spark, d):
    """A recrop has to add a pixel that the crops so far don't cover."""
    boxes = rectangles(spark, d).select("page", "id", G.box(*(F.col(c) for c in "xywh")).alias("b"))
    pairs = boxes.filter("id = 1").select("page", F.col("b").alias("recrop")).join(boxes.filter("id = 2").select("page", F.array("b").alias("cut")), "page")
    return pairs.select("page", F.when(G.area(G.remaining(F.col("recrop"), F.col("cut"))) == 0, "adds nothing").otherwise("allowed").alias("verdict"))


@query("""SELECT l_orderkey AS page, count(*) AS acts, count(*) FILTER (l_returnflag = 'A') AS held, sha256(string_agg(CAST(l_linenumber AS VARCHAR), ',' ORDER BY l_linenumber)) AS seal FROM lineitem GROUP BY l_orderkey""")
def k13_proposal_seal(spark, d):
    rows = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("page")).agg(F.count("*").alias("acts"), F.count_if(F.col("l_returnflag") == "A").alias("held"), F.array_sort(F.collect_list("l_linenumber")).alias("m"))
    return rows.select("page", "acts", "held", F.sha2(F.array_join(F.transform("m", lambda x: x.cast("string")), ","), 256).alias("seal"))


@query("""SELECT page_id, page_id % 14 <> 0 AS delivered_as_recorded FROM pages""")
def k21_delivered_digest(spark, d):
    pages = table(spark, d, "pages").select("page_id", F.sha2("html", 256).alias("recorded"))
    sent = pages.select("page_id", F.when(F.col("page_id") % 14 == 0, F.sha2(F.lit("other"), 256)).otherwise(F.col("recorded")).alias("sent"))
    return pages.join(sent, "page_id").select("page_id", (F.col("recorded") == F.col("sent")).alias("delivered_as_recorded"))


@query(f"""WITH {RECTANGLES}, f AS (SELECT page, CAST(sum(w * h) AS BIGINT) AS total, CAST(coalesce(sum(w * h) FILTER (id > 3), 0) AS BIGINT) AS outside FROM rectangles GROUP BY page) SELECT o_custkey AS act, count(*) AS checked, count(*) FILTER (outside * 2 > total) AS flagged FROM orders JOIN f ON page = o_orderkey GROUP BY o_custkey""")
def k28_checked_and_flagged_pages(spark, d):
    area = F.col("w") * F.col("h")
    found = rectangles(spark, d).groupBy("page").agg(F.sum(area).alias("total"), F.coalesce(F.sum(F.when(F.col("id") > 3, area)), F.lit(0)).alias("outside"))
    acts = table(spark, d, "orders").join(found, F.col("o_orderkey") == F.col("page"))
    return acts.groupBy(F.col("o_custkey").alias("act")).agg(F.count("*").alias("checked"), F.count_if(F.col("outside") * 2 > F.col("total")).alias("flagged"))


@query(f"""WITH {CURRENT} SELECT CASE WHEN outcome IN ('read', 'genuinely-empty', 'excluded') THEN 'completed' WHEN outcome = 'not-run' THEN 'unresolved' ELSE 'failed' END AS class, count(*) AS n FROM current GROUP BY ALL""")
def k29_receipt_from_artifacts(spark, d):
    counted = A.classify(current_readings(spark, d).withColumn("stage", F.lit("attestatores"))).groupBy("class").agg(F.count("*").alias("n"))
    return A.zero_filled(counted, "class", A.CLASSES)


@query("""SELECT l_orderkey, l_linenumber, o_orderpriority AS file, c_name AS folder FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey WHERE o_totalprice > 1000""")
def k34_citation_link(spark, d):
    census = table(spark, d, "orders").filter("o_totalprice > 1000").join(table(spark, d, "customer"), F.col("c_custkey") == F.col("o_custkey"))
    return table(spark, d, "lineitem").join(census, F.col("o_orderkey") == F.col("l_orderkey")).select("l_orderkey", "l_linenumber", F.col("o_orderpriority").alias("file"), F.col("c_name").alias("folder"))


@query(f"""WITH {CURRENT}, chairs AS (SELECT DISTINCT chair FROM readings) SELECT act, (SELECT count(*) FROM chairs) AS roster, count(*) AS present, count(*) = (SELECT count(*) FROM chairs) AS agrees FROM current GROUP BY act""")
def k37_roster_agreement(spark, d):
    now = current_readings(spark, d)
    roster = now.agg(F.count_distinct("chair").alias("roster"))
    return now.groupBy("act").agg(F.count("*").alias("present")).join(F.broadcast(roster)).withColumn("agrees", F.col("present") == F.col("roster"))


@query(f"""WITH {CURRENT} SELECT act, count(*) AS n, 'missing' AS side FROM current WHERE act % 4 = 0 GROUP BY act UNION ALL SELECT act, count(*) + 1, 'unexplained' FROM current WHERE act % 4 = 0 GROUP BY act""")
def k38_aggregate_recomputed(spark, d):
    basis = current_readings(spark, d).groupBy("act").agg(F.count("*").alias("n"))
    return R.difference(basis, basis.withColumn("n", F.when(F.col("act") % 4 == 0, F.col("n") + 1).otherwise(F.col("n"))))


@query("""WITH h AS (SELECT doc_id, left(sha256('{"page_sha256":"' || sha256(text) || '","purpose":"gold-set-v1"}'), 1) IN ('0','1','2','3','4','5','6','7') AS cal FROM documents) SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 'calibration' ELSE 'locked-acceptance' END AS stated, CASE WHEN cal THEN 'calibration' ELSE 'locked-acceptance' END AS derived FROM h""")
def k41_manual_pick(spark, d):
    """A hand-picked page keeps its stated set beside the one that its content gives."""
    from lectern.operators.sampling import SETS, set_of

    return _docs(spark, d).select("doc_id", F.when(F.col("doc_id") % 2 == 0, SETS[0]).otherwise(SETS[1]).alias("stated"), set_of(F.sha2("text", 256)).alias("derived"))


@query("""SELECT 'k' || CAST(doc_id AS VARCHAR) AS key, CASE WHEN doc_id % 3 = 0 THEN 'insert' WHEN doc_id % 3 = 1 THEN 'reuse' ELSE 'conflict' END AS action FROM documents""")
def k42_append_only(spark, d):
    i = F.col("doc_id")
    rows = _docs(spark, d).select(F.concat(F.lit("k"), i.cast("string")).alias("key"), F.sha2("text", 256).alias("sha256"), "doc_id")
    stored = rows.filter("doc_id % 3 <> 0").select("key", F.when(i % 3 == 2, F.lit("other")).otherwise(F.col("sha256")).alias("sha256"))
    return R.publish(rows, stored, "key", "sha256").select("key", "action")


@query(f"""WITH {ATTEMPTS}, o AS (SELECT subject_id, string_agg(chair, ',' ORDER BY ordinal) AS witnesses FROM attempts GROUP BY subject_id) SELECT witnesses, count(*) AS acts FROM o GROUP BY witnesses""")
def k44_witness_order(spark, d):
    order = attempts(spark, d).groupBy("subject_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ordinal", "chair"))), lambda x: x["chair"]), ",").alias("witnesses"))
    return order.groupBy("witnesses").agg(F.count("*").alias("acts"))


@query("""WITH p AS (SELECT a.conv_id AS act, a.text <> b.text AS departed, a.turn % 4 = 0 AS unavailable FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1) SELECT act, count(*) FILTER (NOT unavailable) AS compared, count(*) FILTER (NOT unavailable AND departed) AS departed, count(*) FILTER (unavailable) AS unavailable FROM p GROUP BY act""")
def k45_dissent_counts(spark, d):
    turns = attempts(spark, d)
    pairs = turns.join(turns.select("subject_id", (F.col("ordinal") - 1).alias("ordinal"), F.col("text").alias("after")), ["subject_id", "ordinal"])
    gone = (F.col("ordinal") - 1) % 4 == 0
    return pairs.groupBy(F.col("subject_id").alias("act")).agg(F.count_if(~gone).alias("compared"), F.count_if(~gone & (F.col("text") != F.col("after"))).alias("departed"), F.count_if(gone).alias("unavailable"))


@query("""SELECT doc_id, length(text) <= 20000 AS measurable FROM documents""")
def k47_measurable_text(spark, d):
    t = F.col("text")
    return _docs(spark, d).select("doc_id", ((F.length(t) <= 20_000) & ~t.rlike(r"\p{M}{33,}")).alias("measurable"))


@query("""SELECT p_partkey, lower(trim(split_part(trim(p_brand || ' @rev-' || CAST(p_size AS VARCHAR)), '@', 1))) AS repository FROM part""")
def k49_repository(spark, d):
    name = F.concat("p_brand", F.lit(" @rev-"), F.col("p_size").cast("string"))
    return table(spark, d, "part").select("p_partkey", F.lower(F.trim(F.split_part(F.trim(name), F.lit("@"), F.lit(1)))).alias("repository"))


@query(f"""WITH {ATTEMPTS}, b AS (SELECT subject_id, chair, CASE WHEN lag(chair) OVER (PARTITION BY subject_id ORDER BY ordinal) = chair THEN 0 ELSE 1 END AS new FROM attempts) SELECT subject_id, chair, CAST(sum(new) AS BIGINT) AS residencies, sum(new) > 1 AS reloaded FROM b GROUP BY subject_id, chair""")
def t08_single_residency(spark, d):
    before = F.lag("chair").over(Window.partitionBy("subject_id").orderBy("ordinal"))
    rows = attempts(spark, d).withColumn("new", F.when(before == F.col("chair"), 0).otherwise(1))
    return rows.groupBy("subject_id", "chair").agg(F.sum("new").alias("residencies"), (F.sum("new") > 1).alias("reloaded"))
