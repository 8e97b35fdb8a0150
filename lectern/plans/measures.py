"""Queries of aggregates, ordered logic, text rules and geometry."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from lectern.functions import canonical as C
from lectern.functions import geometry as G
from lectern.functions import text as T
from lectern.operators import intervals as I
from lectern.operators import metrics as M
from lectern.operators import rectangles as B
from lectern.plans.registry import Registry
from lectern.sources.tables import ATTEMPTS, INTERVALS, READINGS, RECTANGLES, attempts, intervals, readings, rectangles, table

query = Registry()


# --- metrics --------------------------------------------------------------------------------------------

_CELLS = """cells AS (SELECT role AS slot, CASE turn % 3 WHEN 0 THEN 'image-only' WHEN 1 THEN 'witnessed' ELSE 'primed' END AS condition,
  CASE WHEN length(text) % 7 = 0 THEN 'complete' WHEN length(text) % 7 = 1 THEN 'truncated' WHEN length(text) % 7 = 2 THEN 'no-readable-text' WHEN length(text) % 7 = 3 THEN 'refused'
       WHEN length(text) % 7 = 4 THEN 'missing' WHEN length(text) % 7 = 5 THEN 'unavailable' ELSE 'malformed' END AS status,
  CAST(length(text) % 13 AS BIGINT) AS cer_errors, CAST(length(text) AS BIGINT) AS cer_units, CAST(turn % 5 AS BIGINT) AS wer_errors, CAST(length(text) // 6 AS BIGINT) AS wer_units,
  CAST(turn AS BIGINT) AS compared, CAST(turn // 2 AS BIGINT) AS departed, CASE WHEN conv_id % 3 <> 0 THEN CAST(length(text) AS DOUBLE) / 8 END AS elapsed_ms FROM conversations)"""


def _cells(spark, d):
    n = F.length("text")
    status = F.get(F.array(*map(F.lit, M.STATES)), n % 7)
    condition = F.get(F.array(F.lit("image-only"), F.lit("witnessed"), F.lit("primed")), (F.col("turn") % 3).cast("int"))
    return table(spark, d, "conversations").select(
        F.col("role").alias("slot"), condition.alias("condition"), status.alias("status"), (n % 13).cast("long").alias("cer_errors"), n.cast("long").alias("cer_units"), (F.col("turn") % 5).alias("wer_errors"),
        F.expr("cast(length(text) div 6 as bigint)").alias("wer_units"), F.col("turn").alias("compared"), F.expr("turn div 2").alias("departed"), F.when(F.col("conv_id") % 3 != 0, n.cast("double") / 8).alias("elapsed_ms"),
    )


@query(f"""WITH {_CELLS} SELECT slot, condition, count(*) AS cells, {", ".join(f"count(*) FILTER (status = '{s}') AS {s.replace('-', '_')}_count" for s in M.STATES)},
{", ".join(f"CAST(sum({c}) AS BIGINT) AS {c}" for c in ("cer_errors", "cer_units", "wer_errors", "wer_units", "compared", "departed"))}, count(elapsed_ms) AS elapsed_observed,
CAST(coalesce(sum(CAST(elapsed_ms AS DECIMAL(18,9))), 0) AS DOUBLE) AS elapsed_total, sum(cer_errors) / nullif(sum(cer_units), 0) AS cer, sum(wer_errors) / nullif(sum(wer_units), 0) AS wer FROM cells GROUP BY slot, condition""")
def a10_micro_metrics(spark, d):
    return M.aggregate(_cells(spark, d), ["slot", "condition"]).withColumn("elapsed_total", F.col("elapsed_total").cast("double"))


@query(f"""WITH {_CELLS} SELECT slot, count(*) AS cells, sum(cer_errors) / nullif(sum(cer_units), 0) AS cer FROM cells GROUP BY slot""")
def a11_metrics_by_slot(spark, d):
    return M.aggregate(_cells(spark, d), ["slot"]).select("slot", "cells", "cer")


_DELTAS = """m AS (SELECT slot, condition, CAST(sum(cer_errors) AS BIGINT) AS e FROM cells GROUP BY ALL), deltas AS (SELECT slot, max(e) FILTER (condition = 'witnessed') - max(e) FILTER (condition = 'image-only') AS delta_witnessed,
 max(e) FILTER (condition = 'primed') - max(e) FILTER (condition = 'image-only') AS delta_primed, count(DISTINCT condition) = 3 AS complete FROM m GROUP BY slot)"""


def _deltas(spark, d):
    sums = M.aggregate(_cells(spark, d), ["slot", "condition"])
    return M.condition_deltas(sums, "slot", "cer_errors", ["image-only", "witnessed", "primed"])


@query(f"""WITH {_CELLS}, {_DELTAS} SELECT * FROM deltas WHERE complete""")
def a12_condition_deltas(spark, d):
    """A slot that lacks a condition is refused: it has no deltas."""
    return _deltas(spark, d).filter("complete")


@query(f"""WITH {_CELLS}, {_DELTAS} SELECT a.slot, a.delta_witnessed - b.delta_witnessed AS advantage_delta_witnessed, a.delta_primed - b.delta_primed AS advantage_delta_primed
FROM deltas a JOIN deltas b ON b.slot = 'user' AND a.slot <> 'user' AND a.complete""")
def a13_advantage_over_base(spark, d):
    return M.advantages(_deltas(spark, d).filter("complete"), "slot", "user", ["delta_witnessed", "delta_primed"])


@query("""WITH r AS (SELECT l_returnflag, CAST(l_quantity AS INT) AS q, row_number() OVER (PARTITION BY l_returnflag ORDER BY CAST(l_quantity AS INT)) AS p, count(*) OVER (PARTITION BY l_returnflag) AS n FROM lineitem)
SELECT l_returnflag, q FROM r WHERE p = greatest(1, (n * 75 + 99) // 100)""")
def a14_nearest_rank(spark, d):
    return M.nearest_rank(table(spark, d, "lineitem").select("l_returnflag", F.col("l_quantity").cast("int").alias("q")), ["l_returnflag"], "q", 75)


@query(f"""WITH {RECTANGLES}, pairs AS (SELECT a.x AS tx, a.y AS ty, a.w AS tw, a.h AS th, b.x, b.y, b.w, b.h FROM rectangles a JOIN rectangles b ON a.page = b.page AND a.id = 1 AND b.id = 2),
edges AS (SELECT 'top' AS edge, (greatest(0, y - ty) * 10000 + h - 1) // h AS bp FROM pairs UNION ALL SELECT 'left', (greatest(0, x - tx) * 10000 + w - 1) // w FROM pairs
 UNION ALL SELECT 'bottom', (greatest(0, ty + th - y - h) * 10000 + h - 1) // h FROM pairs UNION ALL SELECT 'right', (greatest(0, tx + tw - x - w) * 10000 + w - 1) // w FROM pairs),
r AS (SELECT *, row_number() OVER (PARTITION BY edge ORDER BY bp) AS p, count(*) OVER (PARTITION BY edge) AS n FROM edges)
SELECT edge, bp, n < 30 AS small_sample FROM r WHERE p = greatest(1, (n * 90 + 99) // 100)""")
def a15_padding_calibration(spark, d):
    boxes = rectangles(spark, d)
    true = boxes.filter("id = 1").select("page", *(F.col(c).alias("t" + c) for c in "xywh"))
    pairs = boxes.filter("id = 2").join(true, "page")
    c = F.col
    edges = F.array(
        F.struct(F.lit("top").alias("edge"), M.edge_shortfall(c("ty"), c("y"), c("h")).alias("bp")),
        F.struct(F.lit("left").alias("edge"), M.edge_shortfall(c("tx"), c("x"), c("w")).alias("bp")),
        F.struct(F.lit("bottom").alias("edge"), M.edge_shortfall(-(c("ty") + c("th")), -(c("y") + c("h")), c("h")).alias("bp")),
        F.struct(F.lit("right").alias("edge"), M.edge_shortfall(-(c("tx") + c("tw")), -(c("x") + c("w")), c("w")).alias("bp")),
    )
    needs = pairs.select(F.explode(edges).alias("e")).select("e.*")
    return M.nearest_rank(needs, ["edge"], "bp", 90).join(needs.groupBy("edge").agg((F.count("*") < 30).alias("small_sample")), "edge")


_MODE = """h AS (SELECT l_returnflag, CAST(l_quantity AS INT) AS q, count(*) AS n FROM lineitem GROUP BY ALL), m AS (SELECT l_returnflag, arg_max(q, n * 1000 - q) AS mode, max(n) AS n, CAST(sum(n) AS BIGINT) AS total, CAST(sum(q * n) AS BIGINT) AS sum FROM h GROUP BY l_returnflag)"""


@query(f"""WITH {_MODE} SELECT l_returnflag, mode, n FROM m""")
def a16_histogram_mode(spark, d):
    return M.histogram_mode(table(spark, d, "lineitem").select("l_returnflag", F.col("l_quantity").cast("int").alias("q")), ["l_returnflag"], "q").select("l_returnflag", "mode", "n")


@query(f"""WITH {_MODE} SELECT l_returnflag, mode * total < sum AS mode_below_mean FROM m""")
def a17_mode_below_mean(spark, d):
    modes = M.histogram_mode(table(spark, d, "lineitem").select("l_returnflag", F.col("l_quantity").cast("int").alias("q")), ["l_returnflag"], "q")
    return modes.select("l_returnflag", (F.col("mode") * F.col("total") < F.col("sum")).alias("mode_below_mean"))


@query(f"""WITH {RECTANGLES} SELECT page, min(x) AS x, min(y) AS y, max(x + w) - min(x) AS w, max(y + h) - min(y) AS h FROM rectangles GROUP BY page""")
def a18_union_bounds(spark, d):
    return B.union_bounds(rectangles(spark, d), ["page"])


@query(f"""WITH {READINGS} SELECT act, outcome, string_agg(DISTINCT chair, ',' ORDER BY chair) AS chairs FROM readings GROUP BY act, outcome""")
def a19_merged_observations(spark, d):
    return readings(spark, d).groupBy("act", "outcome").agg(F.array_join(F.array_sort(F.collect_set("chair")), ",").alias("chairs"))


@query(f"""WITH {ATTEMPTS} SELECT subject_id, chair, sha256(string_agg(text, chr(10) ORDER BY ordinal) FILTER (text <> '')) AS joined, count(*) FILTER (text <> '') AS parts FROM attempts GROUP BY subject_id, chair""")
def a20_page_join(spark, d):
    rows = attempts(spark, d).filter("text <> ''").groupBy("subject_id", "chair").agg(F.array_sort(F.collect_list(F.struct("ordinal", "text"))).alias("m"))
    return rows.select("subject_id", "chair", F.sha2(F.array_join(F.transform("m", lambda x: x["text"]), "\n"), 256).alias("joined"), F.size("m").cast("long").alias("parts"))


@query(f"""WITH {READINGS} SELECT act, CASE WHEN count(*) FILTER (outcome = 'read') = 0 THEN 'no chair read' WHEN count(*) FILTER (outcome = 'failed') > count(*) FILTER (outcome = 'read') THEN 'mostly failed' ELSE 'some unread' END AS reason FROM readings GROUP BY act""")
def a21_failure_reason(spark, d):
    read, failed = F.count_if(F.col("outcome") == "read"), F.count_if(F.col("outcome") == "failed")
    return readings(spark, d).groupBy("act").agg(F.when(read == 0, "no chair read").when(failed > read, "mostly failed").otherwise("some unread").alias("reason"))


# --- ordered logic ---------------------------------------------------------------------------------------


@query("""WITH y AS (SELECT source, doc_id, nullif(n_chars % 1000, 7) AS v FROM documents), l AS (SELECT *, lag(v) OVER (PARTITION BY source ORDER BY doc_id) AS p FROM y WHERE v IS NOT NULL) SELECT source, doc_id FROM l WHERE v < p""")
def w05_sequence_regression(spark, d):
    rows = table(spark, d, "documents").select("source", "doc_id", F.nullif(F.col("n_chars") % 1000, F.lit(7).cast("long")).alias("v")).filter("v is not null")
    return I.lagged(rows, ["source"], ["doc_id"], "v", "p").filter("v < p").select("source", "doc_id")


@query(f"""WITH {RECTANGLES}, a AS (SELECT page, id, row_number() OVER (PARTITION BY page ORDER BY id) AS p, row_number() OVER (PARTITION BY page ORDER BY y, x, id) AS q FROM rectangles) SELECT page, id FROM a WHERE p <> q""")
def w06_rank_mismatch(spark, d):
    boxes = rectangles(spark, d)
    page = Window.partitionBy("page")
    return boxes.withColumns({"p": F.row_number().over(page.orderBy("id")), "q": F.row_number().over(page.orderBy("y", "x", "id"))}).filter("p <> q").select("page", "id")


@query("""WITH p AS (SELECT DISTINCT l_orderkey AS k, l_suppkey % 30 AS pos FROM lineitem), r AS (SELECT k, pos, pos - row_number() OVER (PARTITION BY k ORDER BY pos) AS run FROM p) SELECT k, min(pos) AS start, max(pos) + 1 AS "end" FROM r GROUP BY k, run""")
def w07_uncovered_ranges(spark, d):
    rows = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("k"), (F.col("l_suppkey") % 30).alias("pos")).distinct()
    return I.positions_to_ranges(rows, ["k"], "pos")


@query(None)
def w08_ink_runs(spark, d):
    """Runs of ink in scanlines: a row of pixels for each order line, ink where a digit of its key repeats."""
    rows = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("page"), F.col("l_linenumber").cast("int").alias("y"), F.md5(F.col("l_partkey").cast("string")).alias("m"))
    ink = F.concat(*[F.when(F.substring("m", k, 1) < "8", F.lit(bytearray(b"\x01"))).otherwise(F.lit(bytearray(b"\x00"))) for k in range(1, 33)])
    return rows.select("page", "y", ink.alias("row")).mapInPandas(B.ink_runs, "page long, y int, x0 long, x1 long")


_MERGED = """o AS (SELECT *, max("end") OVER (PARTITION BY owner ORDER BY start, "end", id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM intervals),
i AS (SELECT *, sum(CASE WHEN reach IS NULL OR start > reach THEN 1 ELSE 0 END) OVER (PARTITION BY owner ORDER BY start, "end", id) AS island FROM o), merged AS (SELECT owner, min(start) AS start, max("end") AS "end" FROM i GROUP BY owner, island)"""


@query(f"""WITH {INTERVALS}, {_MERGED} SELECT owner, start, "end" FROM merged""")
def w09_merged_intervals(spark, d):
    return I.merge(intervals(spark, d), ["owner"], ["start", "end", "id"])


@query(f"""WITH {INTERVALS}, {_MERGED}, n AS (SELECT owner, "end" AS start, lead(start) OVER (PARTITION BY owner ORDER BY start) AS "end" FROM merged) SELECT owner, start, "end" FROM n WHERE "end" > start""")
def w10_interval_gaps(spark, d):
    return I.gaps(I.merge(intervals(spark, d), ["owner"], ["start", "end", "id"]), ["owner"])


@query(f"""WITH {INTERVALS}, o AS (SELECT *, max("end") OVER (PARTITION BY owner ORDER BY start, "end", id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM intervals),
i AS (SELECT *, sum(CASE WHEN reach IS NULL OR start - reach > 3600 THEN 1 ELSE 0 END) OVER (PARTITION BY owner ORDER BY start, "end", id) AS island FROM o) SELECT owner, CAST(island AS BIGINT) AS island, count(*) AS n FROM i GROUP BY ALL""")
def w11_sessions(spark, d):
    return I.with_sessions(intervals(spark, d), ["owner"], ["start", "end", "id"], 3600).groupBy("owner", "island").agg(F.count("*").alias("n"))


@query(f"""WITH {RECTANGLES} SELECT page, id, row_number() OVER (PARTITION BY page ORDER BY y, x, id) AS place FROM rectangles""")
def w12_group_order(spark, d):
    return rectangles(spark, d).select("page", "id", F.row_number().over(Window.partitionBy("page").orderBy("y", "x", "id")).alias("place"))


@query(f"""WITH {RECTANGLES} SELECT DISTINCT page, y AS at FROM rectangles WHERE (2 * x + w) * 100 < 2 * 260 * 15 UNION SELECT page, y + h // 2 FROM rectangles WHERE (2 * x + w) * 100 < 2 * 260 * 15 AND h >= 15""")
def w13_act_starts(spark, d):
    margin = rectangles(spark, d).filter(G.is_margin(F.col("x"), F.col("w"), 260))
    opens = F.array_compact(F.array(F.col("y"), F.when(F.col("h") >= 15, F.col("y") + F.expr("h div 2"))))
    return margin.select("page", F.explode(opens).alias("at")).distinct()


@query(f"""WITH {ATTEMPTS}, b AS (SELECT subject_id, chair, CASE WHEN lag(chair) OVER (PARTITION BY subject_id ORDER BY ordinal) = chair THEN 0 ELSE 1 END AS new FROM attempts) SELECT subject_id, CAST(sum(new) AS BIGINT) AS blocks, sum(new) = count(DISTINCT chair) AS contiguous FROM b GROUP BY subject_id""")
def w14_consecutive_blocks(spark, d):
    before = F.lag("chair").over(Window.partitionBy("subject_id").orderBy("ordinal"))
    rows = attempts(spark, d).withColumn("new", F.when(before == F.col("chair"), 0).otherwise(1))
    return rows.groupBy("subject_id").agg(F.sum("new").alias("blocks"), (F.sum("new") == F.count_distinct("chair")).alias("contiguous"))


@query("""SELECT doc_id, CASE WHEN s <= 120 AND s + 30 >= 130 THEN 'line' WHEN s <= 140 THEN 'page' ELSE 'none' END AS narrowest FROM (SELECT doc_id, doc_id % 200 AS s FROM documents)""")
def o09_narrowest_span(spark, d):
    s = (F.col("doc_id") % 200).cast("int")
    spans = F.array(F.struct(s.alias("start"), (s + 30).alias("end"), F.lit("line").alias("class")), F.struct(F.when(s <= 140, 0).otherwise(500).alias("start"), F.lit(1000).alias("end"), F.lit("page").alias("class")))
    found = I.narrowest_containing(spans, F.lit(120), F.lit(130))
    return table(spark, d, "documents").select("doc_id", F.coalesce(found["class"], F.lit("none")).alias("narrowest"))


@query("""SELECT event_id, length(ltrim(k, '0')) AS n, CASE WHEN ltrim(k, '0') = '' THEN '0' ELSE ltrim(k, '0') END AS digits FROM (SELECT event_id, lpad(CAST(event_id AS VARCHAR), 9, '0') AS k FROM events WHERE event_id > 0)""")
def o10_number_order(spark, d):
    rows = table(spark, d, "events").filter("event_id > 0").select("event_id", T.number_key(F.lpad(F.col("event_id").cast("string"), 9, "0")).alias("key"))
    return rows.select("event_id", "key.n", "key.digits").orderBy("n", "digits")


# --- text --------------------------------------------------------------------------------------------------


@query("""SELECT page_id, length(regexp_replace(html, '<[^>]*>', '', 'g')) AS characters, sha256(regexp_replace(html, '<[^>]*>', '', 'g')) AS digest FROM pages""")
def f01_tags_stripped(spark, d):
    plain = T.without_tags(F.col("html"))
    return table(spark, d, "pages").select("page_id", F.length(plain).alias("characters"), F.sha2(plain, 256).alias("digest"))


@query(None)
def f01_markup_view(spark, d):
    """The whole view of markup: text, loss counters and offset map."""
    view = table(spark, d, "pages").select("page_id", T.markup_text_view("html").alias("v"))
    return view.select("page_id", F.sha2("v.text", 256).alias("digest"), "v.markup_characters", "v.whitespace_characters", "v.unicode_reencoded_characters", F.size("v.offset_map").alias("mapped"))


@query("""SELECT doc_id, sha256(trim(regexp_replace(nfc_normalize(text), '\\s+', ' ', 'g'))) AS digest FROM documents""")
def f02_comparison_view(spark, d):
    return table(spark, d, "documents").select("doc_id", F.sha2(T.comparison_view("text"), 256).alias("digest"))


@query(None)
def f03_graphemic_profile(spark, d):
    return table(spark, d, "documents").select("doc_id", F.sha2(T.graphemic_view("text"), 256).alias("digest"))


@query(None)
def f05_search_key(spark, d):
    return table(spark, d, "documents").select("doc_id", F.sha2(T.search_key("text"), 256).alias("digest"))


@query("""SELECT doc_id, sha256(trim(regexp_replace(lower(text), '[^\\p{L}\\p{N}]+', ' ', 'g'))) AS digest FROM documents""")
def f05_plain_search_key(spark, d):
    return table(spark, d, "documents").select("doc_id", F.sha2(T.plain_search_key(F.col("text")), 256).alias("digest"))


@query(None)
def f06_repeated_word(spark, d):
    return table(spark, d, "documents").select("doc_id", T.repeated_word(F.col("text")).alias("word")).filter("word <> ''")


@query("""SELECT doc_id, regexp_extract(text, '\\b(\\d{4})\\b', 1) AS year, regexp_extract(text, '(?i)\\b(?:no\\.?|number)\\s*(\\d+)\\b', 1) AS number FROM documents""")
def f07_year_and_number(spark, d):
    return table(spark, d, "documents").select("doc_id", T.first_year(F.col("text")).alias("year"), T.first_number(F.col("text")).alias("number"))


@query("""SELECT doc_id, sha256('{"lang":"' || lang || '","n_chars":' || CAST(n_chars AS VARCHAR) || ',"note":null,"source":"' || source || '"}') AS digest FROM documents""")
def f08_canonical_digest(spark, d):
    rec = C.record(lang=F.col("lang"), source=F.col("source"), n_chars=F.col("n_chars"), note=F.lit(None).cast("string"))
    return table(spark, d, "documents").select("doc_id", C.digest(rec).alias("digest"))


@query("""SELECT doc_id, sha256('{"doc_id":' || CAST(doc_id AS VARCHAR) || ',"lang":"' || lang || '"}') AS self_hash, doc_id % 4 <> 0 AS verifies FROM documents""")
def f09_self_hash(spark, d):
    rows = table(spark, d, "documents").select("doc_id", "lang")
    sealed = rows.withColumn("self_hash", C.self_hash(rows))
    edited = sealed.withColumn("doc_id_now", F.when(F.col("doc_id") % 4 == 0, -1).otherwise(F.col("doc_id")))
    now = edited.select(F.col("doc_id_now").alias("doc_id"), "lang", "self_hash")
    return edited.select("doc_id", "self_hash", (C.digest(C.record(doc_id=F.col("doc_id_now"), lang=F.col("lang"))) == F.col("self_hash")).alias("verifies"))


@query("""WITH p AS (SELECT doc_id, 'pg_' || left(sha256('{"bindings":{"ordinal":' || CAST(doc_id AS VARCHAR) || ',"source_sha256":"' || sha256(text) || '"},"kind":"page"}'), 16) AS page_id FROM documents)
SELECT doc_id, page_id, 'att_' || left(sha256('{"bindings":{"operation":"read","ordinal":1,"subject_id":"' || page_id || '"},"kind":"attempt"}'), 16) AS attempt_id FROM p""")
def f10_derived_identities(spark, d):
    pages = table(spark, d, "documents").select("doc_id", C.identity("page", ordinal=F.col("doc_id"), source_sha256=F.sha2("text", 256)).alias("page_id"))
    return pages.withColumn("attempt_id", C.identity("attempt", operation=F.lit("read"), ordinal=F.lit(1), subject_id=F.col("page_id")))


def _turn_pairs(spark, d):
    turns = attempts(spark, d)
    after = turns.select("subject_id", (F.col("ordinal") - 1).alias("ordinal"), F.col("text").alias("after"))
    return turns.select("subject_id", "ordinal", F.col("text").alias("before")).join(after, ["subject_id", "ordinal"])


@query(None)
def f11_change_span(spark, d):
    """The span of a text that an edit changed, and where that ends in the edited text; an insertion leaves a span of nothing."""
    i = F.col("doc_id")
    after = F.concat(F.left("text", F.lit(40)), F.when(i % 3 == 0, "").otherwise(F.concat(F.lit("#"), i.cast("string"))), F.substr("text", F.lit(61), F.length("text")))
    rows = table(spark, d, "documents").select("doc_id", F.col("text").alias("before"), after.alias("after"))
    rows = rows.withColumn("s", T.change_span(F.col("before"), F.col("after")))
    return rows.select("doc_id", "s.start", "s.end", (F.length("after") - F.length("before") + F.col("s.end")).alias("after_end"))


@query(None)
def f13_alignment(spark, d):
    pairs = _turn_pairs(spark, d)
    return pairs.select("subject_id", "ordinal", T.alignment("before", "after").alias("a")).select("subject_id", "ordinal", "a.*")


@query(None)
def f14_departures(spark, d):
    """How many departures a turn has from the one before, or no answer where they are too long to tell."""
    found = _turn_pairs(spark, d).select("subject_id", "ordinal", T.departure_spans("before", "after").alias("s"))
    return found.select("subject_id", "ordinal", F.when(F.col("s").isNull(), "unknown").otherwise("compared").alias("status"), F.when(F.col("s").isNotNull(), F.size("s")).alias("departures"))


@query("""WITH p AS (SELECT a.conv_id AS subject_id, a.turn + 1 AS ordinal, a.text AS x, b.text AS y FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1),
v AS (SELECT *, trim(regexp_replace(nfc_normalize(x), '\\s+', ' ', 'g')) AS vx, trim(regexp_replace(nfc_normalize(y), '\\s+', ' ', 'g')) AS vy FROM p),
s AS (SELECT *, CASE WHEN ordinal % 4 = 0 THEN 'not-compared' WHEN greatest(length(vx), length(vy)) > 100000 OR CAST(length(vx) AS BIGINT) * length(vy) > 100000000 THEN 'unknown' ELSE 'compared' END AS status FROM v)
SELECT subject_id, ordinal, status, CASE WHEN status = 'compared' THEN vx <> vy END AS departed, CASE WHEN status = 'compared' THEN x <> y END AS departed_raw,
  CASE WHEN status = 'compared' THEN length(y) - length(vy) END AS loss FROM s""")
def f15_dissent(spark, d):
    """Three-valued: an uncompared or unbounded pair has no answer, which isn't the answer no. On whole turns."""
    rows = _turn_pairs(spark, d).withColumns({"vx": T.comparison_view("before"), "vy": T.comparison_view("after")})
    return rows.select("subject_id", "ordinal", T.dissent(F.col("before"), F.col("after"), F.col("vx"), F.col("vy"), F.col("ordinal") % 4 != 0).alias("d")).select("subject_id", "ordinal", "d.*")


@query(None)
def f16_edit_distance(spark, d):
    """Substitutions, insertions and deletions between items and edited ones, whose sum has to be the native distance."""
    pairs = table(spark, d, "benchmark").select("item_id", F.lower("text").alias("r"), F.lower(F.expr("substring(text, 3)")).alias("h"))
    found = pairs.select("item_id", F.levenshtein("r", "h").alias("errors"), T.code_point_edits("r", "h").alias("e"))
    return found.select("item_id", "errors", "e.*", (F.col("e.substitutions") + F.col("e.insertions") + F.col("e.deletions") == F.col("errors")).alias("agrees"))


@query(None)
def f17_character_and_word_scores(spark, d):
    """Errors by characters and by words of every answer, non-answers as nothing; blank references can't be scored."""
    status = F.get(F.array(*map(F.lit, M.STATES)), (F.col("ordinal") % 7).cast("int"))
    pairs = _turn_pairs(spark, d).withColumn("status", status).withColumn("given", T.hypothesis_of(F.col("status"), F.col("after"))).filter(T.scoreable(F.col("before")))
    return pairs.select("subject_id", "ordinal", "status", T.character_score("before", "given").alias("cer"), T.word_score("before", "given").alias("wer"))


@query("""SELECT doc_id, sha256(left(text, 10) || substr(text, 21, 30) || substr(text, 61)) AS digest FROM documents""")
def f18_excised(spark, d):
    gaps = F.expr("array(struct(10 as start, 20 as end), struct(50 as start, 60 as end))")
    return table(spark, d, "documents").select("doc_id", F.sha2(T.excise(F.col("text"), gaps), 256).alias("digest"))


@query("""SELECT doc_id, (length(text) - length(replace(text, '(', ''))) <> (length(text) - length(replace(text, ')', ''))) OR (length(text) - length(replace(text, '[', ''))) <> (length(text) - length(replace(text, ']', ''))) OR (length(text) - length(replace(text, '“', ''))) <> (length(text) - length(replace(text, '”', ''))) AS unclosed,
 length(text) > 0 AND 1000000 > 2000 * length(text) AS short, ends_with(rtrim(text), '-') AS abrupt FROM documents""")
def f20_truncation_signals(spark, d):
    t = F.col("text")
    return table(spark, d, "documents").select("doc_id", T.unclosed(t).alias("unclosed"), T.suspiciously_short(t, F.lit(1_000_000)).alias("short"), T.ends_abruptly(t).alias("abrupt"))


@query(None)
def f21_repeated_tail(spark, d):
    return table(spark, d, "documents").select("doc_id", T.repeated_tail_of("text").alias("r")).select("doc_id", "r.*").filter("repeats > 0")


@query("""SELECT doc_id, CASE WHEN text IS NULL THEN 'absent' ELSE 'text' END AS kind, text = '' AS empty, trim(text) = '' AS blank, ends_with(text, '-') OR NOT (doc_id % 6 <> 0) AS truncated, length(text) AS characters FROM documents""")
def f22_content_health(spark, d):
    return table(spark, d, "documents").select("doc_id", T.health(F.col("text"), F.col("doc_id") % 6 != 0).alias("h")).select("doc_id", "h.*")


@query("""SELECT doc_id, 3 + 4 * (doc_id % 5) AS start, 3 + 4 * (doc_id % 5) + 2 AS "end" FROM documents""")
def f25_raw_span(spark, d):
    """A span of the plain view back to the markup that supplied it, through the view's own offset map."""
    i = (F.col("doc_id") % 5).cast("int")
    rows = table(spark, d, "documents").select("doc_id", i.alias("k"), F.concat(F.lit("<i>"), F.repeat(F.lit("xy  "), 6), F.lit("</i>")).alias("markup"))
    view = rows.withColumn("v", T.markup_text_view("markup"))
    span = T.raw_span(F.col("v.offset_map"), 3 * F.col("k"), 3 * F.col("k") + 3)  # two letters and a collapsed space
    return view.select("doc_id", span.alias("s")).select("doc_id", "s.start", "s.end")


@query("""SELECT doc_id, text = trim(text) AND NOT contains(text, chr(13)) AND text = nfc_normalize(text) AS gold FROM documents""")
def f26_gold_text_rules(spark, d):
    t = F.col("text")
    return table(spark, d, "documents").select("doc_id", ((t == F.trim(t)) & ~F.contains(t, F.lit("\r")) & T.is_nfc(t)).alias("gold"))


@query("""SELECT doc_id, CASE WHEN trim(text) = '' THEN 'no_readable_text' WHEN doc_id % 3 = 0 THEN 'partial' ELSE 'established' END AS status FROM documents""")
def f27_text_status(spark, d):
    return table(spark, d, "documents").select("doc_id", T.text_status(F.col("text"), F.when(F.col("doc_id") % 3 == 0, 1).otherwise(0)).alias("status"))


@query("""SELECT doc_id, true AS digest_ok, regexp_full_match(source, '[a-z0-9][a-z0-9._-]{0,63}') AS run_ok, false AS identity_ok FROM documents""")
def f30_shape_predicates(spark, d):
    return table(spark, d, "documents").select("doc_id", C.is_sha256(F.sha2("text", 256)).alias("digest_ok"), C.is_run_id(F.col("source")).alias("run_ok"), C.is_identity(F.col("source")).alias("identity_ok"))


@query("""WITH f AS (SELECT source, sha256('[' || string_agg('{"ordinal":' || CAST(doc_id AS VARCHAR) || ',"sha256":"' || sha256(text) || '"}', ',' ORDER BY doc_id) || ']') AS content FROM documents GROUP BY source) SELECT source, content, sha256('{"content":"' || content || '","run_id":"' || source || '"}') AS seed FROM f""")
def f31_frame_seed(spark, d):
    line = C.canonical(C.record(ordinal=F.col("doc_id"), sha256=F.sha2("text", 256)))
    frame = C.digest_in_order(table(spark, d, "documents").select("source", "doc_id", line.alias("line")), ["source"], ["doc_id"], "line", "[", ",", "]")
    return frame.select("source", F.col("digest").alias("content")).withColumn("seed", C.digest(C.record(content=F.col("content"), run_id=F.col("source"))))


# --- geometry ------------------------------------------------------------------------------------------------


def _boxes(spark, d):
    return rectangles(spark, d).select("page", "id", G.box(*(F.col(c) for c in "xywh")).alias("b"))


@query(f"""WITH {RECTANGLES} SELECT page, id, x >= 0 AND y >= 0 AND w > 0 AND h > 0 AND x + w <= 230 AND y + h <= 270 AS valid FROM rectangles""")
def g01_bounds_validation(spark, d):
    return _boxes(spark, d).select("page", "id", G.valid(F.col("b"), 230, 270).alias("valid"))


@query(f"""WITH {RECTANGLES}, p AS (SELECT page, id, greatest(0, x - (w * 250 + 5000) // 10000) AS x, greatest(0, y - (h * 1500 + 5000) // 10000) AS y, least(260, x + w + (w * 333 + 5000) // 10000) AS x1, least(320, y + h + (h * 2500 + 5000) // 10000) AS y1, x AS x0, y AS y0 FROM rectangles)
SELECT page, id, x, y, x1 - x AS w, y1 - y AS h, y0 - y AS top, x0 - x AS "left" FROM p""")
def g02_padding(spark, d):
    return _boxes(spark, d).select("page", "id", G.padded(F.col("b"), 260, 320, 1500, 333, 2500, 250).alias("p")).select("page", "id", "p.bounds.*", "p.top", "p.left")


@query(f"""WITH {RECTANGLES} SELECT page, id, (x * 97) // 260 AS x, (y * 101) // 320 AS y, greatest(1, least(97, ((x + w) * 97 + 259) // 260) - (x * 97) // 260) AS w, greatest(1, least(101, ((y + h) * 101 + 319) // 320) - (y * 101) // 320) AS h, true AS covered FROM rectangles""")
def g03_model_space(spark, d):
    model = _boxes(spark, d).withColumn("m", G.to_model(F.col("b"), 260, 320, 97, 101))
    back = model.withColumn("r", G.from_model(F.col("m"), 260, 320, 97, 101))
    return back.select("page", "id", "m.*", G.contains(F.col("r"), F.col("b")).alias("covered"))


@query(f"""WITH {RECTANGLES} SELECT page, id, (abs(w * 320 - h * 260) * 10000) // greatest(w * 320, h * 260) AS bp FROM rectangles""")
def g04_anisotropy(spark, d):
    n = lambda v: F.lit(v).cast("long")
    return rectangles(spark, d).select("page", "id", G.anisotropy_bp(F.col("w"), n(260), F.col("h"), n(320)).alias("bp"))


@query("""SELECT l_orderkey, l_linenumber, l_partkey, (l_partkey % 1001 * 260) // 1000 AS x FROM lineitem""")
def g05_thousandths(spark, d):
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", G.from_thousandths(F.col("l_partkey") % 1001, 260).alias("x"))


@query(f"""WITH {RECTANGLES} SELECT a.page, a.id AS a, b.id AS b, greatest(0, least(a.x + a.w, b.x + b.w) - greatest(a.x, b.x)) * greatest(0, least(a.y + a.h, b.y + b.h) - greatest(a.y, b.y)) AS area FROM rectangles a JOIN rectangles b ON a.page = b.page AND a.id < b.id""")
def g06_overlap_area(spark, d):
    boxes = _boxes(spark, d)
    pairs = boxes.select("page", F.col("id").alias("a"), F.col("b").alias("p")).join(boxes.select("page", F.col("id").alias("b"), F.col("b").alias("q")), "page").filter("a < b")
    return pairs.select("page", "a", "b", G.overlap_area(F.col("p"), F.col("q")).alias("area"))


@query(f"""WITH {RECTANGLES}, a AS (SELECT * FROM rectangles WHERE id = 1), b AS (SELECT * FROM rectangles WHERE id = 2) SELECT a.page, a.w * a.h - greatest(0, least(a.x + a.w, b.x + b.w) - greatest(a.x, b.x)) * greatest(0, least(a.y + a.h, b.y + b.h) - greatest(a.y, b.y)) AS area FROM a JOIN b USING (page)""")
def g07_rectangle_subtraction(spark, d):
    boxes = _boxes(spark, d)
    pairs = boxes.filter("id = 1").select("page", F.col("b").alias("region")).join(boxes.filter("id = 2").select("page", F.array("b").alias("claims")), "page")
    return pairs.select("page", G.area(G.remaining(F.col("region"), F.col("claims"))).alias("area"))


@query("""WITH p AS (SELECT l_orderkey AS page, 100 + l_orderkey % 50 AS ph FROM lineitem GROUP BY l_orderkey), t AS (SELECT page, ph, unnest(range(0, 4)) AS i FROM p)
SELECT page, i + 1 AS band, greatest(0, ph * i // 4 - 8) AS y, least(ph, ph * (i + 1) // 4 + 8) - greatest(0, ph * i // 4 - 8) AS h, CAST(260 AS BIGINT) AS w FROM t""")
def g08_fallback_bands(spark, d):
    pages = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("page")).distinct()
    return pages.select("page", F.explode(G.bands(F.lit(260).cast("long"), 100 + F.col("page") % 50)).alias("t")).select("page", "t.*")


@query("""WITH p AS (SELECT DISTINCT l_orderkey AS page, 300 + l_orderkey % 900 AS w, 400 + l_orderkey % 700 AS h FROM lineitem), c AS (SELECT page, v, greatest(1, (2 * h * v + w) // (2 * w)) AS hv FROM (SELECT page, w, h, unnest(range(1, least(w, 512) + 1)) AS v FROM p)) SELECT page, max(v) AS w, arg_max(hv, v) AS h FROM c WHERE hv <= 640 AND v * hv <= 200000 GROUP BY page""")
def g10_fitted_size(spark, d):
    pages = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("page")).distinct()
    return pages.select("page", G.fitted(300 + F.col("page") % 900, 400 + F.col("page") % 700, 512, 640, 200_000).alias("f")).select("page", "f.w", "f.h")


@query(f"""WITH {RECTANGLES} SELECT page, id, CASE WHEN (2 * x + w) * 100 < 2 * 260 * 15 THEN 'margin' ELSE 'body' END AS "column" FROM rectangles""")
def g11_columns(spark, d):
    return rectangles(spark, d).select("page", "id", F.when(G.is_margin(F.col("x"), F.col("w"), 260), "margin").otherwise("body").alias("column"))


@query("""WITH h AS (SELECT l_returnflag, CAST(l_quantity AS INT) AS q, count(*) AS n FROM lineitem GROUP BY ALL), m AS (SELECT l_returnflag, arg_max(q, n * 1000 - q) AS mode FROM h GROUP BY l_returnflag) SELECT l_returnflag, count(*) FILTER (CAST(l_quantity AS INT) <= mode - 5) AS ink, count(*) AS pixels FROM lineitem JOIN m USING (l_returnflag) GROUP BY l_returnflag""")
def g12_ink_threshold(spark, d):
    values = table(spark, d, "lineitem").select("l_returnflag", F.col("l_quantity").cast("int").alias("q"))
    level = M.histogram_mode(values, ["l_returnflag"], "q").select("l_returnflag", "mode")
    return values.join(level, "l_returnflag").groupBy("l_returnflag").agg(F.count_if(F.col("q") <= F.col("mode") - 5).alias("ink"), F.count("*").alias("pixels"))


@query(None)
def g13_components(spark, d):
    return B.components(rectangles(spark, d), 3)


@query(None)
def g16_grouped_acts(spark, d):
    return B.grouped_acts(rectangles(spark, d), 260, 6, 2, 15)


@query(None)
def j13_page_continuation(spark, d):
    acts = B.grouped_acts(rectangles(spark, d), 260, 6, 2, 15).withColumn("id", F.col("act").cast("long"))
    pages = acts.groupBy("page").agg(F.max(F.col("y") + F.col("h")).alias("height")).withColumn("ordinal", F.col("page"))
    return B.continuations(acts, pages, 4)


@query("""SELECT o_orderkey, CAST((CAST(CAST(o_totalprice AS DECIMAL(18,4)) * 10000 AS HUGEINT) * (o_orderkey % 7200) + 180000) // 360000 AS BIGINT) AS cents FROM orders""")
def m14_projected_cost(spark, d):
    rows = table(spark, d, "orders").select("o_orderkey", M.projected_cost(F.col("o_totalprice"), F.col("o_orderkey") % 7200).alias("cost"))
    return rows.select("o_orderkey", (F.col("cost") * 100).cast("long").alias("cents"))


@query("""SELECT event_id, regexp_full_match(s, '\\d{4}-\\d{2}-\\d{2}') AND try_cast(s AS DATE) IS NOT NULL AS is_date FROM (SELECT event_id, CASE WHEN event_id % 5 = 0 THEN '2024-02-3' || CAST(event_id % 10 AS VARCHAR) ELSE CAST(CAST(ts AS DATE) AS VARCHAR) END AS s FROM events)""")
def d01_normalized_date(spark, d):
    s = F.when(F.col("event_id") % 5 == 0, F.concat(F.lit("2024-02-3"), (F.col("event_id") % 10).cast("string"))).otherwise(F.to_date("ts").cast("string"))
    return table(spark, d, "events").select("event_id", (s.rlike(r"^\d{4}-\d{2}-\d{2}\z") & F.try_to_date(s, "yyyy-MM-dd").isNotNull()).alias("is_date"))
