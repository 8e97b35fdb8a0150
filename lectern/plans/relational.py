"""Queries of sources and sinks, predicates, joins, set operations and sampling."""

from __future__ import annotations

from pyspark.sql import functions as F

from lectern.functions import canonical as C
from lectern.operators import accounting as A
from lectern.operators import intervals as I
from lectern.operators import rectangles as B
from lectern.operators import reconcile as R
from lectern.operators import sampling as S
from lectern.plans.registry import Registry
from lectern.sources import formats, sinks
from lectern.sources.tables import CURRENT, INTERVALS, RECTANGLES, current_readings, intervals, rectangles, table

query = Registry()


def _sources(spark, d):
    return table(spark, d, "documents").select(F.concat(F.col("source"), F.lit("/"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("relative_path"), F.sha2("text", 256).alias("sha256"), F.col("doc_id").alias("ordinal"), F.octet_length("text").alias("bytes"), "lang", "text")


_SOURCES = "sources AS (SELECT source || '/' || CAST(doc_id AS VARCHAR) || '.txt' AS relative_path, sha256(text) AS sha256, doc_id AS ordinal, strlen(text) AS bytes, lang, text FROM documents)"


# --- sources and sinks --------------------------------------------------------------------------------


@query(None)
def s01_file_inventory(spark, d):
    """The files of a folder, with their sizes and digests."""
    return sinks.inventory(spark, d, 1 << 30)


@query(f"""WITH {_SOURCES} SELECT relative_path, sha256, row_number() OVER (ORDER BY relative_path) AS place, bytes FROM sources""")
def s02_source_inventory(spark, d):
    return sinks.numbered_in_order(_sources(spark, d).select("relative_path", "sha256", "bytes"), "relative_path", "place")


@query(f"""WITH {_SOURCES}, m AS (SELECT string_agg('{{"ordinal":' || CAST(ordinal AS VARCHAR) || ',"relative_path":"' || relative_path || '","sha256":"' || sha256 || '"}}', ',' ORDER BY relative_path) AS body, split_part(relative_path, '/', 1) AS folder, count(*) AS entries FROM sources GROUP BY folder)
SELECT folder, entries, sha256('[' || body || ']') AS self_hash FROM m""")
def s03_sealed_manifest(spark, d):
    """A manifest for each folder, sealed by the digest of its entries in path order."""
    entry = C.record(ordinal=F.col("ordinal"), relative_path=F.col("relative_path"), sha256=F.col("sha256"))
    rows = _sources(spark, d).select(F.split_part("relative_path", F.lit("/"), F.lit(1)).alias("folder"), "relative_path", C.canonical(entry).alias("line"))
    return C.digest_in_order(rows, ["folder"], ["relative_path"], "line", "[", ",", "]").withColumnsRenamed({"n": "entries", "digest": "self_hash"})


@query("""WITH b AS (SELECT doc_id, upper(hex(CASE doc_id % 13 WHEN 0 THEN from_hex('89504E470D0A1A0A') WHEN 1 THEN from_hex('FFD8') WHEN 2 THEN from_hex('49492A00') WHEN 3 THEN from_hex('4D4D002B')
   WHEN 4 THEN encode('GIF89a') WHEN 5 THEN encode('BM') WHEN 6 THEN encode('xx%PDF-1.7') WHEN 7 THEN encode('RIFF0000WEBP') WHEN 8 THEN from_hex('00000018') || encode('ftypheic') WHEN 9 THEN from_hex('00000018') || encode('ftypavif')
   WHEN 10 THEN from_hex('00000018') || encode('ftypmif1') WHEN 11 THEN from_hex('00000018') || encode('ftypisom0000mif1') ELSE encode('') END || encode(text))) AS h FROM documents)
SELECT doc_id, CASE WHEN strpos(left(h, 2048), '255044462D') > 0 AND (strpos(left(h, 2048), '255044462D') % 2) = 1 THEN 'pdf' WHEN starts_with(h, '89504E470D0A1A0A') THEN 'png' WHEN starts_with(h, 'FFD8') THEN 'jpeg'
  WHEN starts_with(h, '49492A00') OR starts_with(h, '4D4D002A') OR starts_with(h, '49492B00') OR starts_with(h, '4D4D002B') THEN 'tiff' WHEN starts_with(h, '474946383761') OR starts_with(h, '474946383961') THEN 'gif'
  WHEN left(h, 4) IN ('424D', '4241', '4349', '4350', '4943', '5054') THEN 'bmp' WHEN starts_with(h, '52494646') AND substr(h, 17, 8) = '57454250' THEN 'webp'
  WHEN substr(h, 9, 8) = '66747970' AND substr(h, 17, 8) = '68656963' THEN 'heic' WHEN substr(h, 9, 8) = '66747970' AND substr(h, 17, 8) = '61766966' THEN 'avif'
  WHEN substr(h, 9, 8) = '66747970' AND (substr(h, 17, 8) = '6D696631' OR substr(h, 33, 8) = '6D696631') THEN 'heif' END AS format FROM b""")
def s04_sniffed_format(spark, d):
    heads = ["89504E470D0A1A0A", "FFD8", "49492A00", "4D4D002B", b"GIF89a".hex(), b"BM".hex(), b"xx%PDF-1.7".hex(), b"RIFF0000WEBP".hex(), "00000018" + b"ftypheic".hex(), "00000018" + b"ftypavif".hex(), "00000018" + b"ftypmif1".hex(), "00000018" + b"ftypisom0000mif1".hex()]
    head = F.coalesce(F.get(F.array(*[F.unhex(F.lit(h)) for h in heads]), (F.col("doc_id") % 13).cast("int")), F.lit(bytearray()))
    content = F.concat(head, F.col("text").cast("binary"))
    return table(spark, d, "documents").select("doc_id", formats.sniff(content).alias("format"))


@query(f"""WITH {_SOURCES}, stored AS (SELECT relative_path, CASE WHEN ordinal % 6 = 0 THEN sha256('x') ELSE sha256 END AS held FROM sources WHERE ordinal % 2 = 0)
SELECT relative_path, CASE WHEN held IS NULL THEN 'insert' WHEN held = sha256 THEN 'reuse' ELSE 'conflict' END AS action FROM sources LEFT JOIN stored USING (relative_path)""")
def s11_publish_action(spark, d):
    every = _sources(spark, d).select("relative_path", "sha256", "ordinal")
    stored = every.filter("ordinal % 2 = 0").select("relative_path", F.when(F.col("ordinal") % 6 == 0, F.sha2(F.lit("x"), 256)).otherwise(F.col("sha256")).alias("sha256"))
    return R.publish(every, stored, "relative_path", "sha256").select("relative_path", "action")


@query(f"""WITH {_SOURCES} SELECT sha256 AS digest, any_value(bytes) AS bytes FROM sources GROUP BY sha256""")
def s12_blob_store(spark, d):
    return _sources(spark, d).select(F.col("sha256").alias("digest"), "bytes").dropDuplicates(["digest"])


@query(f"""WITH {_SOURCES} SELECT s.relative_path, s.ordinal FROM sources s JOIN (SELECT relative_path, sha256 FROM sources WHERE ordinal % 25 = 0) r USING (relative_path, sha256)""")
def s13_read_by_reference(spark, d):
    every = _sources(spark, d)
    refs = every.filter("ordinal % 25 = 0").select("relative_path", "sha256")
    return every.join(refs, ["relative_path", "sha256"]).select("relative_path", "ordinal")


@query(f"""WITH {_SOURCES} SELECT relative_path, sha256, bytes FROM sources WHERE lang = 'fr'""")
def s14_stage_manifest(spark, d):
    return _sources(spark, d).filter("lang = 'fr'").select("relative_path", "sha256", "bytes").orderBy("relative_path")


@query(f"""WITH {_SOURCES}, m AS (SELECT relative_path, sha256 FROM sources WHERE ordinal % 40 <> 0) SELECT relative_path, sha256, 'missing' AS side FROM (SELECT relative_path, sha256 FROM sources EXCEPT ALL SELECT * FROM m)""")
def s15_manifest_freshness(spark, d):
    now = _sources(spark, d).select("relative_path", "sha256", "ordinal")
    return R.difference(now.drop("ordinal"), now.filter("ordinal % 40 <> 0").drop("ordinal"))


@query(f"""WITH {_SOURCES} SELECT '{{"act_key":"' || relative_path || '","characters":' || CAST(length(text) AS VARCHAR) || ',"lang":"' || lang || '","text_sha256":"' || sha256 || '"}}' AS line FROM sources""")
def s17_json_lines(spark, d):
    row = C.record(act_key=F.col("relative_path"), characters=F.length("text"), lang=F.col("lang"), text_sha256=F.col("sha256"))
    return sinks.json_lines(_sources(spark, d), row, "relative_path")


@query("""WITH w AS (SELECT DISTINCT doc_id, unnest(string_split(lower(regexp_replace(text, '[^\\p{L}\\p{N}]+', ' ', 'g')), ' ')) AS word FROM documents)
SELECT word, count(*) AS documents, min(doc_id) AS first_id FROM w WHERE word <> '' GROUP BY word HAVING count(*) >= 5""")
def s18_inverted_index(spark, d):
    return sinks.inverted_index(table(spark, d, "documents"), "doc_id", "text").filter("documents >= 5")


@query(f"""WITH {_SOURCES} SELECT split_part(relative_path, '/', 1) AS folder, count(*) AS members, sha256(string_agg(text, chr(10) ORDER BY ordinal)) AS content FROM sources GROUP BY ALL""")
def s19_text_bundle(spark, d):
    rows = _sources(spark, d).withColumn("folder", F.split_part("relative_path", F.lit("/"), F.lit(1)))
    return C.digest_in_order(rows, ["folder"], ["ordinal"], "text").withColumnsRenamed({"n": "members", "digest": "content"})


@query(f"""WITH {_SOURCES} SELECT lang AS member, count(*) AS entries, CAST(sum(bytes) AS BIGINT) AS bytes, sha256(string_agg(sha256, chr(10) ORDER BY relative_path)) AS digest FROM sources GROUP BY lang""")
def s22_export_manifest(spark, d):
    rows = _sources(spark, d).withColumnRenamed("lang", "member")
    sizes = rows.groupBy("member").agg(F.sum("bytes").alias("bytes"))
    return C.digest_in_order(rows, ["member"], ["relative_path"], "sha256").withColumnRenamed("n", "entries").join(sizes, "member")


@query(f"""WITH {_SOURCES} SELECT relative_path AS act_key, length(text) AS characters, sha256 AS text_sha256 FROM sources""")
def s23_scan_back(spark, d):
    """What a reader of the exported JSON lines finds: the rows that went in."""
    row = C.record(act_key=F.col("relative_path"), characters=F.length("text"), text_sha256=F.col("sha256"))
    return sinks.scan_json_lines(sinks.json_lines(_sources(spark, d), row, "relative_path"), "act_key string, characters int, text_sha256 string")


@query(f"""WITH {_SOURCES} SELECT count(*) AS entries, CAST(sum(bytes) AS BIGINT) AS bytes FROM sources""")
def a25_store_census(spark, d):
    return _sources(spark, d).agg(F.count("*").alias("entries"), F.sum("bytes").alias("bytes"))


# --- projections and predicates ------------------------------------------------------------------------


@query("""SELECT doc_id, n_chars FROM documents WHERE lang = 'de' AND source = 'src3'""")
def p01_filtered_artifacts(spark, d):
    return table(spark, d, "documents").filter("lang = 'de' and source = 'src3'").select("doc_id", "n_chars")


@query("""SELECT o_orderkey AS page FROM orders WHERE o_orderstatus = 'O'""")
def p02_sealed_pages(spark, d):
    return table(spark, d, "orders").filter("o_orderstatus = 'O'").select(F.col("o_orderkey").alias("page"))


@query("""SELECT doc_id FROM documents WHERE doc_id % 3 = 0 OR source IN ('src1', 'src2')""")
def p03_scenario_rows(spark, d):
    scenarios = F.when(F.col("doc_id") % 3 != 0, F.array(F.lit("happy"), F.when(F.col("source").isin("src1", "src2"), "review").otherwise("blank")))
    rows = table(spark, d, "documents").withColumn("scenarios", scenarios)
    return rows.filter(F.col("scenarios").isNull() | F.array_contains("scenarios", "review")).select("doc_id")


@query(f"""WITH {CURRENT} SELECT act, chair FROM current WHERE outcome IN ('read', 'genuinely-empty')""")
def p04_readings_only(spark, d):
    return current_readings(spark, d).filter(F.col("outcome").isin("read", "genuinely-empty")).select("act", "chair")


@query("""SELECT doc_id, sha256(text) AS text_sha256, n_chars FROM documents""")
def p06_text_free_evidence(spark, d):
    whole = table(spark, d, "documents").select("doc_id", F.struct("text", F.sha2("text", 256).alias("text_sha256"), "n_chars").alias("payload"))
    return whole.select("doc_id", F.col("payload").dropFields("text").alias("p")).select("doc_id", "p.*")


@query("""SELECT DISTINCT role AS chair, 'witness-' || left(sha256('{"chair":"' || role || '","run_id":"run-1"}'), 12) AS label FROM conversations""")
def p09_blinded_label(spark, d):
    label = F.concat(F.lit("witness-"), F.left(C.digest(C.record(chair=F.col("role"), run_id=F.lit("run-1"))), F.lit(12)))
    return table(spark, d, "conversations").select(F.col("role").alias("chair"), label.alias("label")).distinct()


@query("""SELECT event_id, list_sort(json_keys(props)) = ['k', 'v'] AS closed FROM events""")
def p10_closed_schema(spark, d):
    keys = F.array_sort(F.json_object_keys("props"))
    return table(spark, d, "events").select("event_id", (keys == F.array(F.lit("k"), F.lit("v"))).alias("closed"))


_PATHS = "paths AS (SELECT page_id, CASE page_id % 5 WHEN 0 THEN '/abs/x' WHEN 1 THEN 'a/../b' WHEN 2 THEN 'a//b' WHEN 3 THEN 'ok/' || CAST(page_id AS VARCHAR) ELSE 'back\\slash' END AS p FROM pages)"


@query(f"""WITH {_PATHS} SELECT page_id, NOT starts_with(p, '/') AND NOT contains(p, chr(92)) AND len(list_filter(string_split(p, '/'), lambda x: x IN ('', '.', '..'))) = 0 AS safe FROM paths""")
def p11_safe_path(spark, d):
    i = F.col("page_id")
    p = F.when(i % 5 == 0, "/abs/x").when(i % 5 == 1, "a/../b").when(i % 5 == 2, "a//b").when(i % 5 == 3, F.concat(F.lit("ok/"), i.cast("string"))).otherwise("back\\slash")
    return table(spark, d, "pages").select("page_id", formats.safe_path(p).alias("safe"))


@query("""SELECT page_id, starts_with(url, 'https://') AS approved FROM pages""")
def p12_approved_location(spark, d):
    return table(spark, d, "pages").select("page_id", formats.approved_location(F.col("url"), ["https://"]).alias("approved"))


# --- joins ---------------------------------------------------------------------------------------------


@query(f"""WITH {_SOURCES}, refs AS (SELECT 'art-' || CAST(l.doc_id AS VARCHAR) AS artifact_id, s.relative_path, CASE WHEN l.doc_id % 9 = 0 THEN sha256('y') ELSE s.sha256 END AS sha256, l.doc_id FROM labels l JOIN sources s ON s.ordinal = l.doc_id),
blobs AS (SELECT relative_path, sha256 AS actual FROM sources WHERE ordinal % 8 <> 0)
SELECT artifact_id, relative_path, CASE WHEN actual IS NULL THEN 'missing' ELSE 'differs' END AS rule FROM refs LEFT JOIN blobs USING (relative_path) WHERE actual IS NULL OR actual <> sha256""")
def j01_lineage(spark, d):
    every = _sources(spark, d)
    refs = table(spark, d, "labels").join(every, F.col("doc_id") == F.col("ordinal")).select(F.concat(F.lit("art-"), F.col("doc_id").cast("string")).alias("artifact_id"), "relative_path", F.when(F.col("doc_id") % 9 == 0, F.sha2(F.lit("y"), 256)).otherwise(F.col("sha256")).alias("sha256"))
    return R.lineage_violations(refs, every.filter("ordinal % 8 <> 0"))


@query("""WITH a AS (SELECT doc_id AS page, lang FROM documents WHERE doc_id % 7 <> 0), b AS (SELECT doc_id AS page, CASE WHEN doc_id % 5 = 0 THEN 'xx' ELSE lang END AS lang FROM documents WHERE doc_id % 11 <> 0)
SELECT coalesce(a.page, b.page) AS page, CASE WHEN b.page IS NULL THEN 'left-only' WHEN a.page IS NULL THEN 'right-only' WHEN a.lang = b.lang THEN 'agrees' ELSE 'differs' END AS status FROM a FULL JOIN b ON a.page = b.page""")
def j03_page_census(spark, d):
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("page"), "lang")
    return R.reconcile(docs.filter("page % 7 <> 0"), docs.filter("page % 11 <> 0").withColumn("lang", F.when(F.col("page") % 5 == 0, "xx").otherwise(F.col("lang"))), ["page"], ["lang"])


@query("""WITH e AS (SELECT doc_id FROM documents), f AS (SELECT doc_id FROM labels UNION ALL SELECT -1) SELECT doc_id, 'missing' AS side FROM (SELECT doc_id FROM e EXCEPT ALL SELECT doc_id FROM f)
UNION ALL SELECT doc_id, 'unexplained' FROM (SELECT doc_id FROM f EXCEPT ALL SELECT doc_id FROM e)""")
def j05_denominator(spark, d):
    extra = spark.createDataFrame([(-1,)], "doc_id long")
    return R.difference(table(spark, d, "documents").select("doc_id"), table(spark, d, "labels").select("doc_id").unionByName(extra))


@query(f"""WITH {INTERVALS}, a AS (SELECT owner, id, start, "end" FROM intervals WHERE id % 9 = 0), b AS (SELECT owner, id, start, "end" FROM intervals WHERE id % 9 = 1)
SELECT a.owner, a.id AS left_id, b.id AS right_id, greatest(a.start, b.start) AS start, least(a."end", b."end") AS "end" FROM a JOIN b USING (owner) WHERE a.start < b."end" AND b.start < a."end" """)
def j12_clipped_overlap(spark, d):
    spans = intervals(spark, d)
    return I.overlap_join(spans.filter("id % 9 = 0"), spans.filter("id % 9 = 1"), ["owner"])


_CONTAINS = "{a}.x <= {b}.x AND {a}.y <= {b}.y AND {a}.x + {a}.w >= {b}.x + {b}.w AND {a}.y + {a}.h >= {b}.y + {b}.h"
_OVERLAPS = "a.x < b.x + b.w AND b.x < a.x + a.w AND a.y < b.y + b.h AND b.y < a.y + a.h"


@query(f"""WITH {RECTANGLES} SELECT a.page, a.id AS "left", b.id AS "right", CASE WHEN a.x = b.x AND a.y = b.y AND a.w = b.w AND a.h = b.h THEN 'coincident-aabb' WHEN {_CONTAINS.format(a="a", b="b")} THEN 'contains'
  WHEN {_CONTAINS.format(a="b", b="a")} THEN 'contained' ELSE 'ambiguous-overlap' END AS state FROM rectangles a JOIN rectangles b ON a.page = b.page AND a.id < b.id WHERE {_OVERLAPS}""")
def j08_rectangle_relations(spark, d):
    return B.relations(rectangles(spark, d))


@query(f"""WITH {RECTANGLES}, a AS (SELECT * FROM rectangles WHERE id <= 2), b AS (SELECT * FROM rectangles WHERE id > 2),
s AS (SELECT a.page, a.id, a.w * a.h AS size, b.id AS g, CASE WHEN b.id IS NULL THEN 0 ELSE greatest(0, least(a.x + a.w, b.x + b.w) - greatest(a.x, b.x)) * greatest(0, least(a.y + a.h, b.y + b.h) - greatest(a.y, b.y)) END AS o FROM a LEFT JOIN b USING (page)),
m AS (SELECT page, id, size, max(o) AS top FROM s GROUP BY ALL), n AS (SELECT s.page, s.id, count(*) AS n, min(g) AS g FROM s JOIN m ON s.page = m.page AND s.id = m.id AND s.o = m.top AND s.size = m.size GROUP BY ALL)
SELECT m.page, m.id, CASE WHEN top * 2 >= size AND n = 1 THEN g ELSE -1 END AS "group", top AS overlap, CASE WHEN top * 2 < size THEN 'missed' WHEN n > 1 THEN 'tie' ELSE 'matched' END AS verdict FROM m JOIN n USING (page, id)""")
def j09_best_overlap(spark, d):
    boxes = rectangles(spark, d)
    return B.best_match(boxes.filter("id <= 2"), boxes.filter("id > 2")).withColumn("group", F.coalesce("group", F.lit(-1).cast("long")))


@query("""SELECT l_suppkey AS claim, count(DISTINCT l_orderkey) AS owners FROM lineitem GROUP BY l_suppkey HAVING count(DISTINCT l_orderkey) > 1""")
def j10_claimed_twice(spark, d):
    return R.claimed_twice(table(spark, d, "lineitem").select(F.col("l_suppkey").alias("claim"), F.col("l_orderkey").alias("owner")), "claim", "owner")


@query(f"""WITH {RECTANGLES}, a AS (SELECT * FROM rectangles WHERE id <= 3), b AS (SELECT * FROM rectangles WHERE id > 3), free AS (SELECT * FROM a WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.page = a.page AND {_CONTAINS.format(a="b", b="a")}))
SELECT a.page, a.id, count(DISTINCT b.id) AS touched FROM free a LEFT JOIN b ON a.page = b.page AND {_OVERLAPS} GROUP BY ALL""")
def j11_rescue_candidates(spark, d):
    boxes = rectangles(spark, d)
    return B.uncontained(boxes.filter("id <= 3"), boxes.filter("id > 3"))


@query("""SELECT conv_id, turn FROM conversations c ANTI JOIN (SELECT doc_id FROM labels) l ON c.conv_id = l.doc_id""")
def j18_unaddressed(spark, d):
    return table(spark, d, "conversations").join(table(spark, d, "labels").select(F.col("doc_id").alias("conv_id")), "conv_id", "left_anti").select("conv_id", "turn")


@query("""SELECT lang, 'missing' AS side FROM (SELECT DISTINCT lang FROM documents EXCEPT ALL SELECT DISTINCT lang FROM documents WHERE doc_id < 3)""")
def j19_set_equality(spark, d):
    docs = table(spark, d, "documents")
    return R.difference(docs.select("lang").distinct(), docs.filter("doc_id < 3").select("lang").distinct())


@query("""WITH chairs AS (SELECT DISTINCT role AS chair FROM conversations), acts AS (SELECT DISTINCT conv_id AS act FROM conversations) SELECT chair, act, row_number() OVER (ORDER BY chair, act) AS place FROM chairs CROSS JOIN acts""")
def j20_schedule(spark, d):
    turns = table(spark, d, "conversations")
    return sinks.numbered_in_order(turns.select(F.col("conv_id").alias("act")).distinct().join(A.few_names(turns, "role", "chair")), ("chair", "act"), "place")


@query("""WITH c AS (SELECT DISTINCT role AS candidate FROM conversations), a AS (SELECT DISTINCT conv_id AS act FROM conversations), k(condition) AS (VALUES ('image-only'), ('witnessed'), ('primed')) SELECT candidate, act, condition FROM c CROSS JOIN a CROSS JOIN k""")
def j21_experiment_matrix(spark, d):
    turns = table(spark, d, "conversations")
    conditions = spark.createDataFrame([("image-only",), ("witnessed",), ("primed",)], "condition string")
    return turns.select(F.col("conv_id").alias("act")).distinct().join(A.few_names(turns, "role", "candidate")).join(F.broadcast(conditions)).select("candidate", "act", "condition")


@query(f"""WITH {CURRENT}, policy(outcome, threshold) AS (VALUES ('failed', 3), ('not-run', 5)) SELECT c.act, c.chair, p.threshold FROM current c JOIN policy p USING (outcome)""")
def j17_policy_entries(spark, d):
    policy = spark.createDataFrame([("failed", 3), ("not-run", 5)], "outcome string, threshold int")
    return current_readings(spark, d).join(F.broadcast(policy), "outcome").select("act", "chair", "threshold")


@query("""WITH claim AS (SELECT doc_id, doc_id % 3 = 0 AS claimed FROM documents), evidence AS (SELECT doc_id, quality = 1 AS seen FROM labels)
SELECT doc_id, CASE WHEN claimed AND coalesce(seen, false) THEN 'ok' WHEN claimed THEN 'partial' WHEN coalesce(seen, false) THEN 'fatal' ELSE 'none' END AS verdict FROM claim LEFT JOIN evidence USING (doc_id)""")
def j14_continuation_claims(spark, d):
    claim = table(spark, d, "documents").select("doc_id", (F.col("doc_id") % 3 == 0).alias("claimed"))
    evidence = table(spark, d, "labels").select("doc_id", (F.col("quality") == 1).alias("seen"))
    seen = F.coalesce("seen", F.lit(False))
    return claim.join(evidence, "doc_id", "left").select("doc_id", F.when(F.col("claimed") & seen, "ok").when(F.col("claimed"), "partial").when(seen, "fatal").otherwise("none").alias("verdict"))


# --- set operations --------------------------------------------------------------------------------------


@query("""SELECT sha256(text) AS digest, string_agg(DISTINCT tier, '+' ORDER BY tier) AS seen_in FROM (SELECT text, 'a' AS tier FROM documents WHERE doc_id % 2 = 0 UNION ALL SELECT text, 'b' FROM documents WHERE doc_id % 3 = 0) GROUP BY ALL""")
def x01_union_by_content(spark, d):
    docs = table(spark, d, "documents")
    both = docs.filter("doc_id % 2 = 0").select("text", F.lit("a").alias("tier")).unionByName(docs.filter("doc_id % 3 = 0").select("text", F.lit("b").alias("tier")))
    return both.groupBy(F.sha2("text", 256).alias("digest")).agg(F.array_join(F.array_sort(F.collect_set("tier")), "+").alias("seen_in"))


@query("""SELECT 'document' AS unit, doc_id AS id FROM documents UNION ALL SELECT 'page', page_id FROM pages UNION ALL SELECT 'item', item_id FROM benchmark""")
def x02_typed_ledger(spark, d):
    return R.union_all([table(spark, d, t).select(F.lit(u).alias("unit"), F.col(k).alias("id")) for t, u, k in (("documents", "document", "doc_id"), ("pages", "page", "page_id"), ("benchmark", "item", "item_id"))])


@query(f"""WITH {CURRENT} SELECT act, count(DISTINCT outcome) AS owners FROM current WHERE outcome IN ('failed', 'excluded') GROUP BY act HAVING count(DISTINCT outcome) > 1""")
def x03_in_two_sets(spark, d):
    return R.claimed_twice(current_readings(spark, d).filter(F.col("outcome").isin("failed", "excluded")), "act", "outcome")


@query("""SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey HAVING count(*) > 1""")
def x05_repeated_keys(spark, d):
    return R.duplicates(table(spark, d, "orders"), ["o_custkey"])


# --- sampling ---------------------------------------------------------------------------------------------


@query("""SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice, o_orderkey) AS place FROM orders""")
def o01_total_order(spark, d):
    """A position in a total order of all rows; the key breaks ties."""
    return sinks.numbered_in_order(table(spark, d, "orders").select("o_orderkey", "o_totalprice"), ("o_totalprice", "o_orderkey"), "place").drop("o_totalprice")


@query("""SELECT doc_id, ('0x' || left(sha256('{"act_id":"act-' || CAST(doc_id AS VARCHAR) || '","purpose":"nuda-sample","run_id":"run-1"}'), 8))::BIGINT % 1000 < 250 AS sampled FROM documents""")
def o02_per_mille_sample(spark, d):
    return table(spark, d, "documents").select("doc_id", S.per_mille(F.concat(F.lit("act-"), F.col("doc_id").cast("string")), "run-1", "nuda-sample", 250).alias("sampled"))


_SETS = """catalog AS (SELECT doc_id AS ordinal, sha256(text) AS sha256, lang AS stratum FROM documents), halves AS (SELECT *, CASE WHEN left(sha256('{"page_sha256":"' || sha256 || '","purpose":"gold-set-v1"}'), 1) IN ('0','1','2','3','4','5','6','7') THEN 'calibration' ELSE 'locked-acceptance' END AS gold_set FROM catalog)"""


def _catalog(spark, d):
    return table(spark, d, "documents").select(F.col("doc_id").alias("ordinal"), F.sha2("text", 256).alias("sha256"), F.col("lang").alias("stratum"))


@query(f"""WITH {_SETS} SELECT ordinal, gold_set FROM halves""")
def o03_hash_partition(spark, d):
    return _catalog(spark, d).select("ordinal", S.set_of(F.col("sha256")).alias("gold_set"))


_DRAW = f"""{_SETS}, ranked AS (SELECT *, row_number() OVER (PARTITION BY gold_set, stratum ORDER BY sha256('{{"ordinal":' || CAST(ordinal AS VARCHAR) || ',"page_sha256":"' || sha256 || '","purpose":"gold-sample","seed":"seed-1","stratum":"' || stratum || '"}}'), ordinal) AS place FROM halves)"""


def _draw(spark, d):
    plan = spark.createDataFrame([(s, t, q) for s in S.SETS for t, q in (("en", 7), ("fr", 3), ("de", 2))], "gold_set string, stratum string, quota int")
    return S.stratified(_catalog(spark, d), plan, "seed-1"), plan


@query(f"""WITH {_DRAW} SELECT gold_set, stratum, ordinal, sha256, place FROM ranked WHERE place <= CASE stratum WHEN 'en' THEN 7 WHEN 'fr' THEN 3 WHEN 'de' THEN 2 ELSE 0 END""")
def o04_stratified_draw(spark, d):
    return _draw(spark, d)[0]


@query("""SELECT s.gold_set, 'es' AS stratum, 'omits' AS rule FROM (VALUES ('calibration'), ('locked-acceptance')) s(gold_set) WHERE EXISTS (SELECT 1 FROM documents WHERE lang = 'es')""")
def o05_plan_violations(spark, d):
    return S.plan_violations(_catalog(spark, d), _draw(spark, d)[1])


@query("""SELECT doc_id, sha256(encode('seed-1') || from_hex('00') || encode('doc-' || CAST(doc_id AS VARCHAR))) AS draw_key FROM documents""")
def o06_draw_key(spark, d):
    return table(spark, d, "documents").select("doc_id", S.draw_key("seed-1", F.concat(F.lit("doc-"), F.col("doc_id").cast("string"))).alias("draw_key"))


@query(f"""WITH {_DRAW}, drawn AS (SELECT * FROM ranked WHERE place <= CASE stratum WHEN 'en' THEN 7 WHEN 'fr' THEN 3 WHEN 'de' THEN 2 ELSE 0 END)
SELECT gold_set, stratum, ordinal, 'missing' AS side FROM drawn WHERE place = 2 UNION ALL SELECT gold_set, stratum, -1, 'unexplained' FROM drawn WHERE place = 1 AND stratum = 'fr'""")
def o07_draw_replay(spark, d):
    """Members on which a recorded draw and its replay differ; the record lost its second members and has strangers."""
    drawn, plan = _draw(spark, d)
    strangers = drawn.filter("place = 1 and stratum = 'fr'").withColumn("ordinal", F.lit(-1).cast("long"))
    return S.replay(_catalog(spark, d), plan, "seed-1", drawn.filter("place <> 2").unionByName(strangers))


@query("""WITH r AS (SELECT l_orderkey, l_linenumber, rank() OVER (PARTITION BY l_orderkey ORDER BY l_quantity DESC, l_discount) AS p FROM lineitem), t AS (SELECT l_orderkey, min(l_linenumber) AS line, count(*) AS n FROM r WHERE p = 1 GROUP BY l_orderkey)
SELECT l_orderkey, CASE WHEN n = 1 THEN line ELSE -1 END AS line, n > 1 AS tie FROM t""")
def o08_top_with_ties(spark, d):
    from pyspark.sql import Window

    place = F.rank().over(Window.partitionBy("l_orderkey").orderBy(F.desc("l_quantity"), "l_discount"))
    top = table(spark, d, "lineitem").withColumn("p", place).filter("p = 1").groupBy("l_orderkey").agg(F.min("l_linenumber").alias("line"), F.count("*").alias("n"))
    return top.select("l_orderkey", F.when(F.col("n") == 1, F.col("line")).otherwise(-1).alias("line"), (F.col("n") > 1).alias("tie"))
