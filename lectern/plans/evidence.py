"""Queries of files, admission, geometry of whole pages and text layers, each through the operator that holds its rule."""

from __future__ import annotations

from pyspark.sql import functions as F

from lectern.functions import canonical as C
from lectern.operators import admission as N
from lectern.operators import reconcile as R
from lectern.plans.registry import Registry
from lectern.sources import policies, sinks, structure
from lectern.sources.samples import file_of as _file
from lectern.sources.tables import table

query = Registry()


def _docs(spark, d):
    return table(spark, d, "documents")


# --- files -----------------------------------------------------------------------------------------------------------

_FAULTS = {5: "chunk checksum", 6: "fewer pixels than declared", 7: "no end", 8: "no end", 9: "no end", 10: "pixels outside the file", 11: "scan before its frame", 12: "unknown format"}


@query(f"""SELECT doc_id, f.fault FROM documents JOIN (VALUES {", ".join(f"({k}, '{v}')" for k, v in _FAULTS.items())}) f(k, fault) ON doc_id % 13 = f.k""")
def s05_structural_faults(spark, d):
    """What is wrong with files, told from their bytes: checksums, sizes, blocks and directories."""
    from lectern.sources.formats import sniff

    files = _docs(spark, d).select("doc_id", _file(F.col("doc_id") % 13, "text").alias("b"))
    return files.select("doc_id", structure.structural_fault(sniff(F.col("b")), F.col("b")).alias("fault")).filter("fault is not null")


@query("""WITH p AS (SELECT doc_id, unnest(range(0, CASE WHEN doc_id % 13 = 3 THEN 3 ELSE 1 END)) AS page FROM documents)
SELECT doc_id, CASE WHEN doc_id % 13 = 3 THEN page END AS page_index, row_number() OVER (ORDER BY doc_id, page) AS ordinal FROM p""")
def s08_container_pages(spark, d):
    """One source, as many pages as its file holds, numbered through."""
    files = _docs(spark, d).select("doc_id", _file(F.col("doc_id") % 13, "text").alias("content"))
    return N.expanded(files, ["doc_id"]).select("doc_id", "page_index", "ordinal")


def _submitted(spark, d):
    i = F.col("doc_id")
    content = F.when(i % 17 == 0, F.lit(bytearray())).otherwise(_file(i % 13, "text"))
    return _docs(spark, d).select("doc_id", content.alias("content")).withColumn("declared_sha256", F.when(i % 19 == 0, F.sha2(F.lit("?"), 256)).when(i % 2 == 0, F.sha2("content", 256)))


_REASON = f"""CASE WHEN doc_id % 19 = 0 THEN 'digest-mismatch' WHEN doc_id % 17 = 0 THEN 'empty' WHEN {{container}} THEN 'unsupported-variant' WHEN doc_id % 13 = 12 THEN 'unrecognized-format'
  {" ".join(f"WHEN doc_id % 13 = {k} THEN 'corrupt: {v}'" for k, v in _FAULTS.items() if k < 12)} END"""


@query(f"""SELECT doc_id, {_REASON.format(container="doc_id % 13 = 3")} AS reason, CASE WHEN {_REASON.format(container="doc_id % 13 = 3")} IS NULL THEN 'admitted' ELSE 'refused' END AS outcome FROM documents""")
def k01_admission_decision(spark, d):
    """Refusal reasons in their fixed precedence, from the bytes; no source names a page, so containers of several are refused."""
    return N.decide(_submitted(spark, d).withColumn("page_index", F.lit(None).cast("int")), 100_000).select("doc_id", "outcome", "reason")


@query(f"""WITH p AS (SELECT doc_id, unnest(range(0, CASE WHEN doc_id % 13 = 3 AND doc_id % 17 <> 0 THEN 3 ELSE 1 END)) AS page FROM documents), n AS (SELECT *, row_number() OVER (ORDER BY doc_id, page) AS ordinal FROM p)
SELECT doc_id, ordinal, {_REASON.format(container="false")} AS reason, CASE WHEN ordinal % 5 = 0 THEN 'conflict' WHEN ordinal % 5 < 3 THEN 'reuse' ELSE 'insert' END AS action FROM n""")
def k02_admissions_by_source(spark, d):
    """A record for each declared page; a second run finds some there, and others under their keys that it never wrote."""
    files = _submitted(spark, d)
    none = spark.createDataFrame([], "key string, sha256 string")
    first = N.admissions(files, ["doc_id"], 100_000, none)
    stored = first.filter("ordinal % 5 < 3").select("key", F.when(F.col("ordinal") % 5 == 0, "other").otherwise(F.col("sha256")).alias("sha256"))
    return N.admissions(files, ["doc_id"], 100_000, stored).select("doc_id", "ordinal", "reason", "action")


# --- transfer, runs, exports ---------------------------------------------------------------------------------------------


@query("""SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN 'copy' WHEN 1 THEN 'verified' WHEN 2 THEN 'copy again' ELSE 'source changed' END AS action FROM documents""")
def s09_checksummed_transfer(spark, d):
    """Each row of a manifest once: what stands at the target is reused if its bytes are those, and a changed source is refused."""
    c = F.col
    k = c("doc_id") % 4
    manifest = _docs(spark, d).select("doc_id", F.sha2("text", 256).alias("sha256"))
    source = _docs(spark, d).select("doc_id", F.when(k == 3, F.concat("text", F.lit("!"))).otherwise(c("text")).alias("content"))
    target = _docs(spark, d).filter("doc_id % 4 in (1, 2)").select("doc_id", F.when(k == 2, F.left("text", F.lit(1))).otherwise(c("text")).alias("content"))
    return R.transfer(manifest, source, target, "doc_id").select("doc_id", "action")


@query("""SELECT 'run-' || CAST(doc_id AS VARCHAR) AS run_id, CASE WHEN doc_id % 7 = 0 THEN 'create' WHEN doc_id % 7 = 6 THEN 'resume' ELSE 'refuse' END AS action, CASE doc_id % 7 WHEN 1 THEN 'config' WHEN 2 THEN 'corpus' WHEN 3 THEN 'models' WHEN 4 THEN 'prompts' WHEN 5 THEN 'regime' END AS differs FROM documents""")
def s10_run_binding(spark, d):
    """A run may be resumed only if all five facts that bind it are as they were; the first that isn't is named."""
    c = F.col
    facts = ["config", "corpus", "models", "prompts", "regime"]
    asked = _docs(spark, d).select("doc_id", F.concat(F.lit("run-"), c("doc_id").cast("string")).alias("run_id"), *(F.sha2(F.concat(F.lit(f), "text"), 256).alias(f) for f in facts))
    stored = asked.filter("doc_id % 7 <> 0").select("run_id", *(F.when(c("doc_id") % 7 == k + 1, "?").otherwise(c(f)).alias(f) for k, f in enumerate(facts)))
    return R.run_binding(asked, stored, "run_id", facts)


def _acts(spark, d):
    return _docs(spark, d).select(F.concat(F.lit("act-"), F.col("doc_id").cast("string")).alias("act_key"), "doc_id", F.col("source").alias("folder"), "text", F.sha2("text", 256).alias("text_sha256"))


@query("""SELECT 'act-' || CAST(doc_id AS VARCHAR) AS act_key, p.pair, p.side FROM documents JOIN (VALUES (0, 'lines/bundle', 'missing'), (0, 'table/bundle', 'missing'), (1, 'lines/bundle', 'missing'), (1, 'lines/bundle', 'unexplained'), (1, 'table/bundle', 'missing'), (1, 'table/bundle', 'unexplained'),
 (2, 'lines/bundle', 'unexplained'), (2, 'lines/table', 'unexplained'), (3, 'lines/table', 'missing'), (3, 'lines/table', 'unexplained'), (3, 'table/bundle', 'missing'), (3, 'table/bundle', 'unexplained')) p(k, pair, side) ON doc_id % 9 = p.k""")
def x06_cross_format_identity(spark, d):
    """Acts on which the JSON lines, the text bundle and the table of acts, each read back, disagree: one fault of each kind."""
    c = F.col
    acts = _acts(spark, d)
    k = c("doc_id") % 9
    lines = sinks.json_lines(acts.filter(k != 2), C.record(act_key=c("act_key"), text_sha256=c("text_sha256")), "act_key")
    bundle = sinks.sections(acts.filter(k != 0).withColumn("text", F.when(k == 1, F.concat("text", F.lit("\n=== act-0 1\nx"))).otherwise(c("text"))), "act_key", "text")
    held = acts.withColumn("text_sha256", F.when(k == 3, "?").otherwise(c("text_sha256"))).select("act_key", "text_sha256")
    read = {
        "lines": sinks.scan_json_lines(lines, "act_key string, text_sha256 string"),
        "bundle": sinks.scan_sections(bundle).select("act_key", F.sha2("text", 256).alias("text_sha256")),
        "table": held,
    }
    return R.pairwise(read, [("lines", "bundle"), ("lines", "table"), ("table", "bundle")]).select("act_key", "pair", "side")


@query("""WITH w AS (SELECT DISTINCT doc_id, unnest(string_split(lower(regexp_replace(text, '[^\\p{L}\\p{N}]+', ' ', 'g')), ' ')) AS word FROM documents) SELECT 'act-' || CAST(doc_id AS VARCHAR) AS act_key, word FROM w WHERE word IN ('the', 'and', 'der', 'les')""")
def s18_word_lookup(spark, d):
    """The acts in which asked words stand, by the inverted index: the lookup that a search table serves."""
    index = sinks.postings(_acts(spark, d), "act_key", "text")
    return sinks.lookup(index, ["the", "and", "DER", "les"])


@query("""SELECT doc_id, '{"act_key":"act-' || CAST(doc_id AS VARCHAR) || '","reason":"' || CASE WHEN toxic = 1 THEN 'refused: toxic' ELSE 'held: quality' END || '","state":"' || CASE WHEN toxic = 1 THEN 'refused' ELSE 'held' END || '"}' AS line FROM labels WHERE quality = 0 OR toxic = 1""")
def s20_review_items(spark, d):
    """JSON lines of what was held or refused, with the reason, and of nothing else."""
    c = F.col
    state = F.when(c("toxic") == 1, "refused").when(c("quality") == 0, "held").otherwise("delivered")
    rows = table(spark, d, "labels").select("doc_id", F.concat(F.lit("act-"), c("doc_id").cast("string")).alias("act_key"), state.alias("state")).withColumn("reason", F.concat_ws(": ", "state", F.when(c("state") == "refused", "toxic").otherwise("quality")))
    return sinks.review_items(rows, "state").select("doc_id", C.canonical(C.record(act_key=c("act_key"), reason=c("reason"), state=c("state"))).alias("line"))


@query("""SELECT doc_id, CASE WHEN doc_id IN (SELECT doc_id FROM labels) THEN 'leaks into the acts' END AS rule FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) OR doc_id % 20 = 0""")
def s21_salvage_tier(spark, d):
    """Salvage rows, and those among them that are acts as well, which the firewall names."""
    acts = table(spark, d, "labels").select("doc_id")
    docs = _docs(spark, d).select("doc_id")
    salvage = docs.join(acts, "doc_id", "left_anti").unionByName(docs.filter("doc_id % 20 = 0")).distinct()
    return R.firewalled(salvage, acts, "doc_id")


@query("""SELECT 'act-' || CAST(doc_id AS VARCHAR) AS act_key, sha256(text) AS text_sha256 FROM documents WHERE doc_id % 3 <> 0""")
def s16_index_round_trip(spark, d):
    """A derived index written over the one before it, and read again: the later one alone, whole."""
    acts = _acts(spark, d).select("act_key", "doc_id", "text_sha256")
    with sinks.shared_folder(spark) as path:
        sinks.overwrite_index(acts.withColumn("text_sha256", F.lit("old")), path)
        return sinks.overwrite_index(acts.filter("doc_id % 3 <> 0"), path).select("act_key", "text_sha256").checkpoint()


@query("""SELECT source AS folder, count(*) AS acts, 'published' AS first, 'refused' AS second FROM documents GROUP BY source""")
def s24_sealed_publication(spark, d):
    """A sealed bundle is published once: a second one at its place is refused, and what stands there is the first."""
    acts = _acts(spark, d).select("act_key", "folder", "text_sha256")
    with sinks.shared_folder(spark) as path:
        first, second = sinks.publish_sealed(acts, ["folder"], path), sinks.publish_sealed(acts.limit(1), ["folder"], path)
        held = spark.read.schema(acts.schema).parquet(path).groupBy("folder").agg(F.count("*").alias("acts"))
        return held.withColumns({"first": F.lit(first), "second": F.lit(second)}).checkpoint()


_POLICY_TEXTS = [
    ("alignment", "[limits]\nmax_characters = 5\nmax_character_pairs = 6\ntimeout_seconds = 7\n", None),
    ("alignment", "[limits]\nmax_characters = 0\nmax_character_pairs = 6\ntimeout_seconds = 7\n", "max_characters"),
    ("alignment", "[limits]\nmax_characters = 5\n", "limits: keys"),
    ("recovery", "absolute_cap = 3\n[budget]\nfallback_recrop = 1\npage_level_reread = 2\n", None),
    ("recovery", "absolute_cap = 2\n[budget]\nfallback_recrop = 1\npage_level_reread = 2\n", "over the absolute cap"),
    ("recovery", "absolute_cap = 3\n[budget]\nfallback_recrop = true\npage_level_reread = 2\n", "fallback_recrop"),
    ("padding", "[padding]\ntop_bp = 1\nright_bp = 0\nbottom_bp = 2\nleft_bp = 3\n[padding.provenance]\nsource = 'gold'\ncaveat = 'few'\n", None),
    ("padding", "[padding]\ntop_bp = 1\nright_bp = 0\nbottom_bp = 2\nleft_bp = 3\n[padding.provenance]\nsource = ' '\ncaveat = 'few'\n", "source"),
    ("hard-failure", "threshold = 2\n[[kind]]\nstage = 'perlector'\noutcome = 'failed'\n[[kind]]\nstage = 'door'\noutcome = 'refused'\nreason = 'corrupt'\n", None),
    ("hard-failure", "threshold = 2\n[[kind]]\nstage = 'perlector'\noutcome = 'read'\n", "no failure of that stage"),
    ("hard-failure", "threshold = 3\n[[kind]]\nstage = 'perlector'\noutcome = 'failed'\n", "threshold"),
    ("tiles", "[tiles]\nwidth_px = 8\nheight_px = 6\nvertical_offset_px = 3\nhorizontal_overlap_px = 4\n", None),
    ("tiles", "[tiles]\nwidth_px = 8\nheight_px = 6\nvertical_offset_px = 2\nhorizontal_overlap_px = 4\n", "not half a tile"),
    ("tiles", "[tiles\n", "unreadable"),
]


@query(f"""SELECT doc_id, f.fault FROM documents JOIN (VALUES {", ".join(f"({k}, '{why}')" for k, (*_, why) in enumerate(_POLICY_TEXTS) if why)}) f(k, fault) ON doc_id % {len(_POLICY_TEXTS)} = f.k""")
def s25_policy_faults(spark, d):
    """Policies with closed keys and bounded values: what keeps each text from being taken."""
    k = (F.col("doc_id") % len(_POLICY_TEXTS)).cast("int")
    pick = lambda n: F.get(F.array(*[F.lit(p[n]) for p in _POLICY_TEXTS]), k)
    return _docs(spark, d).select("doc_id", policies.policy_fault(pick(0), pick(1)).alias("fault")).filter("fault is not null")
