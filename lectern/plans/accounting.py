"""Queries of attempts, accounting, reconciliation and state."""

from __future__ import annotations

from pyspark.sql import functions as F

from lectern.operators import accounting as A
from lectern.operators import attempts as V
from lectern.operators import reconcile as R
from lectern.plans.registry import Registry
from lectern.sources.tables import ATTEMPTS, CURRENT, READINGS, attempts, current_readings, readings, table

query = Registry()


# --- attempts ---------------------------------------------------------------------------------------


@query(f"""WITH {ATTEMPTS}
SELECT subject_id, max(ordinal) AS ordinal, arg_max(chair, ordinal) AS chair, length(arg_max(text, ordinal)) AS characters
FROM attempts GROUP BY subject_id""")
def w01_latest_attempt(spark, d):
    return V.latest(attempts(spark, d), ["subject_id"], "ordinal").select("subject_id", "ordinal", "chair", F.length("text").alias("characters"))


@query(f"""WITH {CURRENT} SELECT act, chair, attempt, outcome FROM current""")
def w02_latest_per_chair(spark, d):
    return current_readings(spark, d).drop("value")


@query(f"""WITH {ATTEMPTS}, holed AS (SELECT * FROM attempts WHERE NOT (subject_id % 5 = 0 AND ordinal = 2)),
seen AS (SELECT subject_id, min(ordinal) AS low, max(ordinal) AS high, count(*) AS n, count(DISTINCT ordinal) AS d FROM holed GROUP BY subject_id)
SELECT subject_id, 'start' AS rule FROM seen WHERE low <> 1 UNION ALL SELECT subject_id, 'duplicate' FROM seen WHERE n <> d
UNION ALL SELECT subject_id, 'gap' FROM seen WHERE high - low + 1 <> d""")
def t01_attempt_log_gaps(spark, d):
    holed = attempts(spark, d).filter(~((F.col("subject_id") % 5 == 0) & (F.col("ordinal") == 2)))
    return V.history_violations(holed, ["subject_id"], "ordinal")


@query(f"""WITH {ATTEMPTS}, subjects AS (SELECT DISTINCT doc_id AS subject_id FROM documents)
SELECT s.subject_id, coalesce(max(a.ordinal), 0) + 1 AS next_ordinal FROM subjects s LEFT JOIN attempts a USING (subject_id) GROUP BY s.subject_id""")
def w03_next_ordinal(spark, d):
    return V.next_ordinal(table(spark, d, "documents").select(F.col("doc_id").alias("subject_id")), attempts(spark, d), ["subject_id"], "ordinal")


@query(f"""WITH {ATTEMPTS}, high AS (SELECT subject_id, max(ordinal) AS high FROM attempts GROUP BY subject_id)
SELECT doc_id AS subject_id, CAST(doc_id % 9 + 1 AS BIGINT) AS ordinal,
       CASE WHEN doc_id % 9 + 1 = coalesce(high, 0) + 1 THEN 'append' WHEN doc_id % 9 + 1 BETWEEN 1 AND coalesce(high, 0) THEN 'rerun' ELSE 'refuse' END AS status
FROM documents LEFT JOIN high ON doc_id = subject_id""")
def k15_appendable_ordinals(spark, d):
    proposed = table(spark, d, "documents").select(F.col("doc_id").alias("subject_id"), (F.col("doc_id") % 9 + 1).alias("ordinal"))
    return V.appendable(proposed, attempts(spark, d), ["subject_id"], "ordinal")


@query(f"""WITH {READINGS} SELECT act, chair, count(*) AS attempts, arg_max(outcome, attempt) AS latest_outcome, count(*) FILTER (outcome = 'failed') AS failed
FROM readings GROUP BY act, chair""")
def a09_attempt_tally(spark, d):
    return V.tally(readings(spark, d), ["act", "chair"], "attempt", "outcome")


@query(f"""WITH {READINGS}, now AS (SELECT act, chair, max(attempt) AS now FROM readings GROUP BY act, chair)
SELECT r.act, r.chair, r.attempt, r.attempt = n.now AS current FROM readings r JOIN now n USING (act, chair) WHERE r.outcome = 'read'""")
def c12_basis_is_current(spark, d):
    every = readings(spark, d)
    return V.currency(every.filter("outcome = 'read'").select("act", "chair", "attempt"), every, ["act", "chair"], "attempt")


@query(f"""WITH {READINGS}, twice AS (SELECT * FROM readings UNION ALL SELECT * FROM readings WHERE attempt % 3 = 0)
SELECT DISTINCT act, chair, attempt, outcome FROM twice""")
def t02_idempotent_replay(spark, d):
    every = readings(spark, d).drop("value")
    return every.unionByName(every.filter("attempt % 3 = 0")).dropDuplicates(["attempt", "act", "chair", "outcome"])


@query(f"""WITH {ATTEMPTS}, planned AS (SELECT DISTINCT doc_id AS subject_id FROM documents)
SELECT subject_id FROM planned WHERE subject_id NOT IN (SELECT subject_id FROM attempts)""")
def t05_resume_pending(spark, d):
    return table(spark, d, "documents").select(F.col("doc_id").alias("subject_id")).distinct().join(attempts(spark, d).select("subject_id"), "subject_id", "left_anti")


@query(f"""WITH {READINGS}, closed AS (SELECT act, min(attempt) AS closed_at FROM readings WHERE outcome = 'excluded' GROUP BY act)
SELECT r.act, r.chair, r.attempt FROM readings r JOIN closed c USING (act) WHERE r.attempt > c.closed_at""")
def t06_late_witnesses(spark, d):
    every = readings(spark, d)
    closed = every.filter("outcome = 'excluded'").groupBy("act").agg(F.min("attempt").alias("closed_at"))
    return every.join(closed, "act").filter("attempt > closed_at").select("act", "chair", "attempt")


@query(f"""WITH {ATTEMPTS}, steps AS (SELECT subject_id, ordinal, length(text) % 4 <> 0 AS done FROM attempts)
SELECT subject_id, coalesce(min(ordinal) FILTER (NOT done), 0) AS first_open, count(*) FILTER (done) AS done FROM steps GROUP BY subject_id""")
def t07_step_journal(spark, d):
    steps = attempts(spark, d).withColumn("done", F.length("text") % 4 != 0)
    return steps.groupBy("subject_id").agg(F.coalesce(F.min(F.when(~F.col("done"), F.col("ordinal"))), F.lit(0)).alias("first_open"), F.count_if("done").alias("done"))


# --- closed vocabularies ------------------------------------------------------------------------------

_ALGEBRA = "algebra(stage, outcome, class, category) AS (VALUES " + ", ".join("(" + ", ".join("NULL" if x is None else f"'{x}'" for x in r) + ")" for r in A.ALGEBRA) + ")"


def _units(spark, d):
    return readings(spark, d).select(F.lit("attestatores").alias("stage"), F.when(F.col("attempt") % 97 == 0, "skimmed").otherwise(F.col("outcome")).alias("outcome"), "attempt")


_UNITS = "units AS (SELECT 'attestatores' AS stage, CASE WHEN attempt % 97 = 0 THEN 'skimmed' ELSE outcome END AS outcome, attempt FROM readings)"


@query(f"""WITH {READINGS}, {_UNITS}, {_ALGEBRA} SELECT u.stage, u.outcome, a.class, count(*) AS units FROM units u LEFT JOIN algebra a USING (stage, outcome) GROUP BY ALL""")
def c01_outcome_class(spark, d):
    return A.classify(_units(spark, d)).groupBy("stage", "outcome", "class").agg(F.count("*").alias("units"))


@query(f"""WITH {READINGS}, {_UNITS}, {_ALGEBRA} SELECT stage, outcome, count(*) AS units FROM units ANTI JOIN algebra USING (stage, outcome) GROUP BY ALL""")
def c01_unknown_outcomes(spark, d):
    return A.unknown_outcomes(_units(spark, d))


_REVIEWS = """reviews AS (SELECT doc_id AS act, CASE WHEN quality = 1 AND toxic = 0 THEN 'accepted' WHEN quality = 0 AND toxic = 0 THEN 'held-for-review'
  WHEN quality = 1 THEN 'failed' ELSE 'confirmed-blank' END AS outcome FROM labels)"""


def _reviews(spark, d):
    outcome = F.when((F.col("quality") == 1) & (F.col("toxic") == 0), "accepted").when((F.col("quality") == 0) & (F.col("toxic") == 0), "held-for-review").when(F.col("quality") == 1, "failed").otherwise("confirmed-blank")
    return table(spark, d, "labels").select(F.col("doc_id").alias("act"), outcome.alias("outcome"))


@query(f"""WITH {_REVIEWS}, {_ALGEBRA} SELECT r.act, r.outcome, a.category FROM reviews r LEFT JOIN algebra a ON a.stage = 'recensor' AND a.outcome = r.outcome""")
def c02_terminal_category(spark, d):
    return A.classify(_reviews(spark, d).withColumn("stage", F.lit("recensor"))).select("act", "outcome", "category")


@query(f"""WITH {_ALGEBRA}, decided AS (SELECT stage, outcome FROM algebra WHERE stage <> 'door')
SELECT stage, outcome, 'transitions' AS missing_from FROM algebra ANTI JOIN decided USING (stage, outcome)""")
def c03_algebra_totality(spark, d):
    words = A.vocabulary(spark)
    return A.algebra_gaps(spark, words, words.filter("stage <> 'door'"))


@query(f"""WITH {CURRENT} SELECT act, chair, attempt FROM current WHERE outcome = 'excluded' AND attempt % 2 = 1""")
def c04_exclusion_needs_approval(spark, d):
    approved = F.when(F.col("attempt") % 2 == 0, F.concat(F.lit("approval-"), F.col("attempt").cast("string")))
    return current_readings(spark, d).withColumn("approval_ref", approved).filter("outcome = 'excluded' and approval_ref is null").select("act", "chair", "attempt")


# --- coverage and ledgers ------------------------------------------------------------------------------


def _chairs(spark, d):
    return current_readings(spark, d).withColumns({"attached": F.col("attempt") % 7 != 0, "truncated": F.col("attempt") % 11 == 0, "health_unrecorded": F.col("attempt") % 13 == 0})


_PAGES = """pages_ AS (SELECT o_orderkey AS page, CASE WHEN count(l_orderkey) = 0 THEN 'held-for-review'
   WHEN bool_or(l_returnflag = 'N') THEN 'delivered' WHEN bool_and(l_returnflag = 'A') THEN 'excluded-with-approval' WHEN bool_and(l_returnflag = 'R') THEN 'confirmed-blank'
   ELSE 'held-for-review' END AS category FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_orderkey)"""


def _pages(spark, d):
    word = F.when(F.col("l_returnflag") == "N", "delivered").when(F.col("l_returnflag") == "A", "excluded-with-approval").otherwise("confirmed-blank")
    acts = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("page")).agg(F.collect_set(word).alias("categories"))
    return table(spark, d, "orders").select(F.col("o_orderkey").alias("page")).join(acts, "page", "left").select("page", A.page_category(F.col("categories")).alias("category"))


@query(f"WITH {_PAGES} SELECT page, category FROM pages_")
def a03_page_category(spark, d):
    return _pages(spark, d)


@query(f"""WITH {_PAGES}, {_REVIEWS}, {_ALGEBRA}, ledger AS (SELECT 'page' AS unit, category FROM pages_
  UNION ALL SELECT 'act', coalesce(a.category, 'delivered') FROM reviews r JOIN algebra a ON a.stage = 'recensor' AND a.outcome = r.outcome),
words(category) AS (VALUES {", ".join(f"('{c}')" for c in A.CATEGORIES)}), units AS (SELECT DISTINCT unit FROM ledger)
SELECT u.unit, w.category, count(l.unit) AS n FROM units u CROSS JOIN words w LEFT JOIN ledger l ON l.unit = u.unit AND l.category = w.category GROUP BY ALL""")
def a04_terminal_ledger(spark, d):
    acts = A.classify(_reviews(spark, d).withColumn("stage", F.lit("recensor"))).select(F.lit("act").alias("unit"), F.coalesce("category", F.lit("delivered")).alias("category"))
    ledger = _pages(spark, d).select(F.lit("page").alias("unit"), "category").unionByName(acts)
    return A.zero_filled(ledger.groupBy("unit", "category").agg(F.count("*").alias("n")), "category", A.CATEGORIES, ["unit"])


@query("""WITH s AS (SELECT sha256(text) AS digest, 'doc-' || CAST(doc_id AS VARCHAR) AS path, doc_id AS ordinal FROM documents)
SELECT digest, arg_min(path, ordinal) AS first_path, min(ordinal) AS first_ordinal, count(*) AS copies, count(*) - 1 AS excess FROM s GROUP BY digest HAVING count(*) >= 2""")
def a05_duplicate_sources(spark, d):
    sources = table(spark, d, "documents").select("text", F.concat(F.lit("doc-"), F.col("doc_id").cast("string")).alias("path"), F.col("doc_id").alias("ordinal"))
    return R.duplicate_groups(sources, F.sha2("text", 256))


_REFUSALS = """refusals AS (SELECT doc_id, CASE WHEN n_chars > 8000 THEN 'too-large: ' || CAST(n_chars AS VARCHAR) WHEN n_chars < 200 THEN 'empty: almost' WHEN doc_id % 50 = 0 THEN NULL END AS detail,
   n_chars > 8000 OR n_chars < 200 OR doc_id % 50 = 0 AS refused FROM documents)"""


@query(f"""WITH {_REFUSALS} SELECT coalesce(trim(split_part(detail, ':', 1)), 'unreadable record') AS code, count(*) AS n FROM refusals WHERE refused GROUP BY ALL""")
def a06_refusal_census(spark, d):
    n = F.col("n_chars")
    detail = F.when(n > 8000, F.concat(F.lit("too-large: "), n.cast("string"))).when(n < 200, "empty: almost")
    refused = table(spark, d, "documents").filter((n > 8000) | (n < 200) | (F.col("doc_id") % 50 == 0))
    return refused.groupBy(F.coalesce(A.reason_code(detail), F.lit("unreadable record")).alias("code")).agg(F.count("*").alias("n"))


@query(f"""WITH {READINGS}, tally AS (SELECT CASE WHEN attempt % 5 < 3 THEN 'production' ELSE 'instrument' END AS arm, count(DISTINCT act) AS failures
  FROM readings WHERE outcome IN ('failed', 'excluded') GROUP BY ALL) SELECT arm, failures, arm = 'production' AND failures > 20 AS stop FROM tally""")
def a07_hard_failures(spark, d):
    events = readings(spark, d).select(F.lit("attestatores").alias("stage"), F.col("act").alias("subject"), "outcome", F.when(F.col("attempt") % 5 < 3, "production").otherwise("unprimed").alias("pass_kind"))
    policy = spark.createDataFrame([("attestatores", "failed"), ("attestatores", "excluded")], "stage string, outcome string")
    return A.hard_failures(events, policy, 20)


@query(f"""WITH {_REVIEWS}, {_ALGEBRA}, words(class) AS (VALUES ('completed'), ('unresolved'), ('failed')),
counted AS (SELECT a.class, count(*) AS n FROM reviews r JOIN algebra a ON a.stage = 'recensor' AND a.outcome = r.outcome GROUP BY a.class)
SELECT class, coalesce(n, 0) AS n FROM words LEFT JOIN counted USING (class)""")
def a08_partition_receipt(spark, d):
    counted = A.classify(_reviews(spark, d).withColumn("stage", F.lit("recensor"))).groupBy("class").agg(F.count("*").alias("n"))
    return A.zero_filled(counted, "class", A.CLASSES)


@query(f"""WITH {CURRENT} SELECT act, count(*) FILTER (outcome = 'genuinely-empty') >= 2 AND count(*) FILTER (outcome = 'read') = 0 AND NOT bool_or(outcome = 'failed') AS corroborated,
 count(*) FILTER (outcome = 'genuinely-empty') AS blank_chairs FROM current GROUP BY act""")
def a22_blank_corroboration(spark, d):
    blank, read = F.count_if(F.col("outcome") == "genuinely-empty"), F.count_if(F.col("outcome") == "read")
    return current_readings(spark, d).groupBy("act").agg(((blank >= 2) & (read == 0) & ~F.bool_or(F.col("outcome") == "failed")).alias("corroborated"), blank.alias("blank_chairs"))


@query(f"""WITH {CURRENT}, f AS (SELECT act, count(*) FILTER (outcome IN ('read', 'genuinely-empty')) AS readings, bool_or(outcome = 'failed') AS failed, bool_or(outcome = 'not-run') AS open FROM current GROUP BY act)
SELECT act, nullif(concat_ws('; ', CASE WHEN readings < 3 THEN 'under-witnessed' END, CASE WHEN failed THEN 'a chair failed' END, CASE WHEN open THEN 'a chair did not run' END), '') AS route FROM f""")
def a23_review_route(spark, d):
    facts = current_readings(spark, d).groupBy("act").agg(
        F.count_if(V.is_rereading(F.col("outcome"))).alias("readings"), F.bool_or(F.col("outcome") == "failed").alias("failed"), F.bool_or(F.col("outcome") == "not-run").alias("open")
    )
    route = F.concat_ws("; ", F.when(F.col("readings") < 3, "under-witnessed"), F.when(F.col("failed"), "a chair failed"), F.when(F.col("open"), "a chair did not run"))
    return facts.select("act", F.nullif(route, F.lit("")).alias("route"))


@query("""SELECT 'nothing was admitted' AS rule, count(*) AS submitted FROM documents HAVING count(*) FILTER (n_chars < 0) = 0""")
def k03_nothing_admitted(spark, d):
    counts = table(spark, d, "documents").agg(F.count("*").alias("submitted"), F.count_if(F.col("n_chars") < 0).alias("admitted"))
    return counts.filter("admitted = 0").select(F.lit("nothing was admitted").alias("rule"), "submitted")


@query(f"""WITH {CURRENT}, acts AS (SELECT DISTINCT act FROM current), chairs AS (SELECT DISTINCT chair FROM current)
SELECT a.act, c.chair, CASE WHEN r.act IS NULL THEN 'dead' WHEN r.outcome = 'not-run' THEN 'not-run' WHEN r.outcome = 'failed' THEN 'failed'
   WHEN r.value < 5 THEN 'malformed' WHEN r.outcome = 'genuinely-empty' THEN 'genuinely-empty' ELSE 'read' END AS resolved
FROM acts a CROSS JOIN chairs c LEFT JOIN current r ON r.act = a.act AND r.chair = c.chair""")
def k14_attempt_resolution(spark, d):
    now = current_readings(spark, d)
    every = now.select("act").distinct().join(A.few_names(now, "chair", "chair"))
    case = (
        F.when(F.col("outcome").isNull(), "dead").when(F.col("outcome") == "not-run", "not-run").when(F.col("outcome") == "failed", "failed")
        .when(F.col("value") < 5, "malformed").when(F.col("outcome") == "genuinely-empty", "genuinely-empty").otherwise("read")
    )
    return every.join(now, ["act", "chair"], "left").select("act", "chair", case.alias("resolved"))


@query(f"""WITH {CURRENT}, base AS (SELECT act, chair, attempt, outcome FROM current)
SELECT 'production' AS pass_kind, act, chair FROM base UNION ALL SELECT 'unprimed', act, chair FROM base WHERE attempt % 10 = 0
UNION ALL SELECT 'primed-without-prior', act, chair FROM base WHERE attempt % 10 = 1""")
def k25_pass_kinds(spark, d):
    base = current_readings(spark, d)
    kinds = F.array_compact(F.array(F.lit("production"), F.when(F.col("attempt") % 10 == 0, "unprimed"), F.when(F.col("attempt") % 10 == 1, "primed-without-prior")))
    return base.select(F.explode(kinds).alias("pass_kind"), "act", "chair")


@query("""SELECT o_orderkey AS act, coalesce(string_agg(DISTINCT CAST(l_linenumber AS VARCHAR), ',' ORDER BY CAST(l_linenumber AS VARCHAR)), '') AS pages
FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_orderkey""")
def k33_pages_of_act(spark, d):
    marked = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("act")).agg(F.array_join(F.transform(F.array_sort(F.collect_set("l_linenumber")), lambda x: x.cast("string")), ",").alias("pages"))
    return table(spark, d, "orders").select(F.col("o_orderkey").alias("act")).join(marked, "act", "left").select("act", F.coalesce("pages", F.lit("")).alias("pages"))


@query("""SELECT doc_id, sha256(text) AS material FROM documents WHERE sha256(text) IN (SELECT sha256(text) FROM documents WHERE doc_id % 10 = 0) AND doc_id % 10 <> 0""")
def c17_holdout_leakage(spark, d):
    docs = table(spark, d, "documents").select("doc_id", F.sha2("text", 256).alias("material"))
    return docs.filter("doc_id % 10 <> 0").join(docs.filter("doc_id % 10 = 0").select("material"), "material", "left_semi").select("doc_id", "material")


@query("""SELECT source AS shard, count(*) AS pages, count(*) <= 30 AS within FROM documents GROUP BY source""")
def c18_shard_bound(spark, d):
    return table(spark, d, "documents").groupBy(F.col("source").alias("shard")).agg(F.count("*").alias("pages"), (F.count("*") <= 30).alias("within"))


@query(f"""WITH {CURRENT}, basis AS (SELECT act, chair FROM current WHERE outcome = 'read'), dissent AS (SELECT act, chair FROM current WHERE attempt % 6 <> 0)
SELECT coalesce(b.act, d.act) AS act, coalesce(b.chair, d.chair) AS chair, CASE WHEN d.act IS NULL THEN 'left-only' WHEN b.act IS NULL THEN 'right-only' ELSE 'agrees' END AS status
FROM basis b FULL JOIN dissent d ON b.act = d.act AND b.chair = d.chair""")
def c09_dissent_completeness(spark, d):
    now = current_readings(spark, d)
    return R.reconcile(now.filter("outcome = 'read'"), now.filter("attempt % 6 <> 0"), ["act", "chair"])


@query(f"""WITH {READINGS} SELECT act, count(*) FILTER (outcome = 'failed') AS production_regions, count(*) FILTER (outcome = 'not-run') AS recovery_regions FROM readings GROUP BY act""")
def c13_recovery_regions(spark, d):
    return readings(spark, d).groupBy("act").agg(F.count_if(F.col("outcome") == "failed").alias("production_regions"), F.count_if(F.col("outcome") == "not-run").alias("recovery_regions"))
