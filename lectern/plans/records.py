"""Queries of whole-record rules: sound records made from the tables, of which some carry one fault each.

The key of a row tells its fault: of n faults and two remainders more, the k-th is in the rows that leave k. The SQL says
which rules have to come out; the operators find them from the records alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.functions import canonical as C
from lectern.operators import contracts as K
from lectern.operators import records as R
from lectern.plans.registry import Registry
from lectern.sources.tables import table

query = Registry()

Faults = list[tuple[str, dict[str, Column]]]  # the rules that a fault breaks, comma-joined, and the columns that it changes


def _planted(df: DataFrame, key: str, faults: Faults) -> DataFrame:
    cases: dict[str, Column] = {}
    for k, (_, changes) in enumerate(faults):
        for c, bad in changes.items():
            here = F.pmod(F.col(key), F.lit(len(faults) + 2)) == k
            cases[c] = cases[c].when(here, bad) if c in cases else F.when(here, bad)
    return df.withColumns({c: case.otherwise(F.col(c)) for c, case in cases.items()})


def _expected(rows: str, key: str, rules: list[str], subject: str = "") -> str:
    pairs = ", ".join(f"({k}, '{r.replace(chr(39), chr(39) * 2)}')" for k, broken in enumerate(rules) for r in broken.split(", "))
    return f"SELECT {subject or key}, f.rule FROM {rows} JOIN (VALUES {pairs}) f(k, rule) ON {key} % {len(rules) + 2} = f.k"


def _docs(spark, d):
    return table(spark, d, "documents")


_id = lambda c: c.cast("string")
_sha = lambda text: F.sha2(text, 256)
_none = lambda: F.lit(None).cast("string")


# --- envelopes and approvals ------------------------------------------------------------------------------------


def _refs(*pairs: tuple[Column, Column]) -> Column:
    return F.array(*[F.struct(p.alias("relative_path"), s.alias("sha256")) for p, s in pairs])


_BAD_ENVELOPES = [
    "fields", "schema", "stage, outcome, artifact binding, producer's stage", "empty field", "artifact identity, artifact binding", "attempt identity, artifact binding", "artifact binding", "producer's stage", "producer's revision",
    "outcome", "approval, artifact binding, producer's stage", "input path", "input path", "input digest", "input listed twice", "payload", "self hash",
]


@query(_expected("documents", "doc_id", _BAD_ENVELOPES))
def c06_envelope(spark, d):
    c = F.col
    rows = _docs(spark, d).select("doc_id", "text").withColumns({
        "subject_id": C.identity("act", doc=c("doc_id")), "stage": F.lit("recensor"), "kind": F.lit("review"), "outcome": F.lit("accepted"), "schema": F.lit("evidence.v0"), "run_id": F.lit("run-1"), "config_digest": _sha(F.lit("config")),
        "attempt_id": C.identity("attempt", doc=c("doc_id")), "producer": F.struct(F.lit("rev-1").alias("adapter_revision"), F.lit("recensor").alias("stage")), "approval_ref": _none(),
        "inputs": _refs((F.concat(F.lit("pages/"), _id(c("doc_id"))), _sha(c("text"))), (F.lit("config.toml"), _sha(F.lit("config")))), "payload": F.lit('{"text_status":"established"}'),
        "keys": F.array(*[F.lit(f) for f in R.ENVELOPE_FIELDS]),
    })
    rows = rows.withColumn("artifact_id", R.artifact_identity(c("stage"), c("kind"), c("subject_id"), c("attempt_id")))
    first = c("inputs")[0]
    changes = [
        {"keys": F.array_append(c("keys"), F.lit("extra"))}, {"schema": F.lit("evidence.v1")}, {"stage": F.lit("scribe")}, {"run_id": F.lit(" ")}, {"artifact_id": F.lit("art_xyz")}, {"attempt_id": F.lit("pg_0123456789abcdef")},
        {"artifact_id": C.identity("artifact", doc=c("doc_id"))}, {"producer": F.struct(F.lit("rev-1").alias("adapter_revision"), F.lit("perlector").alias("stage"))},
        {"producer": F.struct(F.lit(" ").alias("adapter_revision"), F.lit("recensor").alias("stage"))}, {"outcome": F.lit("delivered")}, {"stage": F.lit("designator"), "outcome": F.lit("excluded")},
        {"inputs": _refs((F.lit(""), _sha(c("text"))))}, {"inputs": _refs((F.lit("a/../b"), _sha(c("text"))))}, {"inputs": _refs((F.lit("a"), F.lit("ABC")))}, {"inputs": F.array(first, F.struct(first["relative_path"].alias("relative_path"), _sha(F.lit("x")).alias("sha256")))},
        {"payload": F.lit("[1]")}, {"self_hash": _sha(F.lit("?"))},
    ]
    faults = list(zip(_BAD_ENVELOPES, changes, strict=True))
    seal = lambda df: df.withColumn("self_hash", C.digest(C.record(**{f: c(f) for f in (*R.ENVELOPE_FIELDS, "approval_ref") if f != "self_hash"})))
    unsealed = [(r, {k: v for k, v in ch.items() if k != "self_hash"}) for r, ch in faults]
    sealed = seal(_planted(rows.withColumn("self_hash", F.lit("")), "doc_id", [(r, ch or {"self_hash": F.lit("")}) for r, ch in unsealed]))
    n = len(faults)
    sealed = sealed.withColumn("self_hash", F.when(c("doc_id") % (n + 2) == n - 1, _sha(F.lit("?"))).otherwise(c("self_hash")))
    return R.envelope_violations(sealed, "evidence.v0", ["doc_id"])


_BAD_APPROVALS = ["schema", "approver", "action", "subjects", "subjects", "reason", "timestamp", "target version", "self hash"]


@query(_expected("documents", "doc_id", _BAD_APPROVALS))
def c07_approval_record(spark, d):
    c = F.col
    given = _docs(spark, d).select("doc_id", F.array(_id(c("doc_id")), F.lit("act-0")).alias("subject_ids"), F.lit("exclusion").alias("action"), F.lit("no ink").alias("reason"), _sha(c("text")).alias("target_version_hash"), F.lit("2024-01-01T00:00:00Z").alias("timestamp"))
    rows = R.approvals(given, "lead")
    changes = [
        {"schema": F.lit("approval-record.v9")}, {"approver": F.lit("agent")}, {"action": F.lit("rename")}, {"subject_ids": F.array().cast("array<string>")}, {"subject_ids": F.array(F.lit(" "))}, {"reason": F.lit("")}, {"timestamp": _none()},
        {"target_version_hash": F.lit("v2")}, {"reason": F.lit("edited")},
    ]
    edited = _planted(rows, "doc_id", list(zip(_BAD_APPROVALS, changes, strict=True)))
    last = c("doc_id") % (len(changes) + 2) == len(changes) - 1
    again = C.digest(C.record(**{f: c(f) for f in ("schema", "subject_ids", "action", "approver", "reason", "target_version_hash", "timestamp")}))
    return R.approval_violations(edited.withColumn("self_hash", F.when(last, c("self_hash")).otherwise(again)), "lead", ["doc_id"])


# --- readings, established records and their links ------------------------------------------------------------------

_BAD_READINGS = [
    "a reading without text", "an unprimed reading that dissents", "dissent not on its basis", "witness regime, dossier's regime", "configured chair without identity", "dossier's act", "dossier's regime", "dossier digest", "kind of reading", "prior draft",
    "prior draft", "view of the draft", "witness labels", "truncation, read but not complete", "read but not complete", "truncated but complete",
]


def _blind(chair: Column) -> Column:
    return F.concat(F.lit("witness-"), F.left(_sha(F.concat(F.lit("run-1/"), chair)), F.lit(12)))


@query(_expected("documents", "doc_id", _BAD_READINGS))
def c08_reading_payload(spark, d):
    c = F.col
    chairs = F.array(F.lit("a"), F.lit("b"))

    def dossier(act=c("act_key"), regime="blinded", labels=None, view=F.lit("fed")):
        labels = F.transform(chairs, _blind) if labels is None else labels
        return F.struct(act.alias("act_key"), labels.alias("labels"), view.cast("string").alias("prior_view"), F.lit(regime).alias("witness_regime"))

    provenance = lambda regime="blinded", identity="model-1": F.struct(F.lit("configured").alias("chair_state"), F.lit(identity).cast("string").alias("resolved_identity"), F.lit(regime).alias("witness_regime"))
    rows = _docs(spark, d).select("doc_id", F.concat(F.lit("act-"), _id(c("doc_id"))).alias("act_key"), F.concat(F.lit("x"), "text").alias("text")).withColumns({
        "outcome": F.lit("read"), "lectio_kind": F.lit("primed-with-prior"), "basis": chairs, "dissent": chairs, "provenance": provenance(), "dossier": dossier(), "draft_fed": F.lit(True), "truncation": F.lit("complete"), "seal": F.lit(True),
    })
    nobody = F.array().cast("array<string>")
    changes = [
        {"text": F.lit("  ")}, {"basis": F.lit(None).cast("array<string>"), "dossier": dossier(labels=nobody)}, {"dissent": F.array(F.lit("a"))}, {"provenance": provenance("open")}, {"provenance": provenance(identity="")}, {"dossier": dossier(F.lit("act"))}, {"dossier": dossier(regime="named", labels=chairs)},
        {"seal": F.lit(False)}, {"lectio_kind": F.lit("second-sight")}, {"dossier": dossier(view=F.lit("perhaps")), "draft_fed": F.lit(None).cast("boolean")}, {"lectio_kind": F.lit("primed-without-prior")}, {"draft_fed": F.lit(False)}, {"dossier": dossier(labels=chairs)},
        {"truncation": F.lit("maybe")}, {"truncation": F.lit("unknown")}, {"outcome": F.lit("truncated")},
    ]
    bad = _planted(rows, "doc_id", list(zip(_BAD_READINGS, changes, strict=True)))
    bad = bad.withColumn("dossier_digest", F.when(c("seal"), C.digest(c("dossier"))).otherwise(_sha(F.lit("?"))))
    return R.reading_violations(bad, ["doc_id"], _blind)


_BAD_RECORDS = [
    "self hash", "status", "review missing or not accepted", "another reading than the review's, review doesn't input its reading, reading missing, a newer reading exists, text, gaps, regions, provenance", "text", "gaps, text status", "regions, inputs", "provenance", "text status", "inputs", "a recrop without rereading",
    "review isn't the latest", "a newer reading exists, a recrop without rereading",
]


def _established(spark, d):
    """Records, and the reviews, readings and regions that they were made from; the key is `act`."""
    c = F.col
    n = len(_BAD_RECORDS) + 2
    fault = lambda k: c("act") % n == k
    ref = lambda kind: F.concat(F.lit(kind + "/"), _id(c("act")))
    base = _docs(spark, d).select(c("doc_id").alias("act"), F.concat(F.lit("x"), "text").alias("text"), "source", F.array(F.concat(F.lit("crop/"), _id(c("doc_id")))).alias("regions"), F.array().cast("array<int>").alias("gaps"))
    base = base.withColumns({"review_ref": ref("review"), "reading_ref": ref("reading"), "provenance": c("source")})
    readings = base.select("act", c("reading_ref").alias("ref"), F.lit(1).alias("ordinal"), "text", "gaps", "regions", "provenance")
    newer = readings.filter(fault(12)).withColumns({"ref": F.concat("ref", F.lit("-2")), "ordinal": F.lit(2)})
    reviews = base.select("act", c("review_ref").alias("ref"), F.lit(1).alias("ordinal"), F.when(fault(2), "held-for-review").otherwise("accepted").alias("outcome"), "reading_ref", F.array("reading_ref").alias("inputs"))
    later = reviews.filter(fault(11)).withColumns({"ref": F.concat("ref", F.lit("-2")), "ordinal": F.lit(2)})
    regions = base.select("act", c("regions")[0].alias("path"), F.lit("original").alias("origin"))
    recrops = base.filter(fault(10)).select("act", F.lit("crop/again").alias("path"), F.lit("recovery").alias("origin"))
    rows = base.withColumns({"page": c("act"), "status": F.lit("established"), "text_status": F.lit("established"), "self_ok": F.lit(True), "inputs": F.array("review_ref", "reading_ref", c("regions")[0])})
    changes = [
        {"self_ok": F.lit(False)}, {"status": F.lit("draft")}, {"status": c("status")}, {"reading_ref": F.lit("reading/none"), "inputs": F.array("review_ref", F.lit("reading/none"), c("regions")[0])}, {"text": F.concat("text", F.lit("!"))}, {"gaps": F.array(F.lit(3))}, {"regions": F.array(F.lit("crop/x"))},
        {"provenance": F.lit("?")}, {"text_status": F.lit("partial")}, {"inputs": F.array("review_ref")},
    ]
    while len(changes) < len(_BAD_RECORDS):
        changes.append({"status": c("status")})
    return _planted(rows, "act", list(zip(_BAD_RECORDS, changes, strict=True))), reviews.unionByName(later), readings.unionByName(newer), regions.unionByName(recrops)


@query(_expected("(SELECT doc_id AS act FROM documents)", "act", _BAD_RECORDS))
def k35_record_reconciliation(spark, d):
    """Established records against the reviews, readings and regions that they name, and the latest ones."""
    return R.established_violations(*_established(spark, d))


@query("""SELECT doc_id AS act, CASE WHEN doc_id % 8 > 5 THEN sha256('x' || text) END AS text_sha256, CASE doc_id % 8 WHEN 6 THEN 'partial' WHEN 7 THEN 'established' END AS text_status, CASE WHEN doc_id % 8 > 5 THEN 4 END AS inputs,
 CASE doc_id % 8 WHEN 0 THEN 'review is held-for-review' WHEN 1 THEN 'reading missing' WHEN 2 THEN 'unprimed reading' WHEN 3 THEN 'reading is truncated' WHEN 4 THEN 'reading without text' WHEN 5 THEN 'review is recovery-requested' END AS rule FROM documents""")
def c10_established_record(spark, d):
    """The constructor that takes only what a review accepted."""
    c = F.col
    base = _docs(spark, d).select(c("doc_id").alias("act"), (c("doc_id") % 8).alias("k"), F.concat(F.lit("x"), "text").alias("text"))
    first = base.select("act", F.lit("v1").alias("ref"), F.lit(1).alias("ordinal"), F.when(c("k") == 0, "held-for-review").otherwise("accepted").alias("outcome"), F.when(c("k") == 1, "none").otherwise("r1").alias("reading_ref"))
    second = base.filter("k = 5").select("act", F.lit("v2").alias("ref"), F.lit(2).alias("ordinal"), F.lit("recovery-requested").alias("outcome"), F.lit("r1").alias("reading_ref"))
    readings = base.select(
        "act", F.lit("r1").alias("ref"), F.when(c("k") == 2, "unprimed").otherwise("primed-with-prior").alias("kind"), F.when(c("k") == 3, "truncated").otherwise("read").alias("outcome"), F.when(c("k") == 4, " ").otherwise(c("text")).alias("text"),
        F.when(c("k") == 6, F.array(F.lit(2))).otherwise(F.array().cast("array<int>")).alias("gaps"), F.array(F.lit("b"), F.lit("a")).alias("regions"),
    )
    made = R.establish(first.unionByName(second), readings)
    return made.select("act", _sha(c("text")).alias("text_sha256"), "text_status", F.when(c("inputs").isNotNull(), F.size("inputs")).alias("inputs"), "rule")


@query("""SELECT doc_id AS act, 'not the reading that the review names' AS rule FROM documents WHERE doc_id % 15 = 3 UNION ALL SELECT doc_id, 'a newer reading exists' FROM documents WHERE doc_id % 15 IN (3, 12)""")
def k31_reviewed_reading(spark, d):
    """The exact reading that a review names, never a newer one."""
    records, reviews, readings, _ = _established(spark, d)
    c = F.col
    named = reviews.select("act", c("ref").alias("review_ref"), c("reading_ref").alias("named"))
    last = readings.groupBy("act").agg(F.max_by("ref", "ordinal").alias("last"))
    rows = records.join(named, ["act", "review_ref"], "left").join(last, "act", "left")
    return K.violations(rows, ["act"], {"not the reading that the review names": c("named") == c("reading_ref"), "a newer reading exists": c("last") == c("reading_ref")})


@query("""SELECT doc_id AS act, CASE doc_id % 5 WHEN 0 THEN 'no model' WHEN 1 THEN 'no revision' WHEN 2 THEN 'no configuration' END AS missing FROM documents WHERE doc_id % 5 < 3""")
def k36_missing_provenance(spark, d):
    """The first thing that a record's provenance lacks."""
    c = F.col
    rows = _planted(
        _docs(spark, d).select(c("doc_id").alias("act"), F.lit("model-1").alias("model"), F.left(_sha(c("text")), F.lit(40)).alias("revision"), _sha(F.lit("c")).alias("config")), "act",
        [("no model", {"model": F.lit(" "), "revision": _none()}), ("no revision", {"revision": F.lit("main"), "config": _none()}), ("no configuration", {"config": F.lit("x")})],
    )
    named = K.first_failure([("no model", F.coalesce(F.trim("model") == "", F.lit(True))), ("no revision", ~F.coalesce(C.is_revision(c("revision")), F.lit(False))), ("no configuration", ~F.coalesce(C.is_sha256(c("config")), F.lit(False)))])
    return rows.select("act", named.alias("missing")).filter("missing is not null")


_BAD_CHAINS = ["draft missing, finding of another draft, frozen facts differ, another attempt, change, finding's inputs, reading's inputs", "finding missing, finding of another draft, frozen facts differ, change, finding digest, unresolved, finding's inputs, reading's inputs", "another attempt", "change", "finding digest", "unresolved", "reading's inputs", "request", "request"]


@query(_expected("(SELECT doc_id AS act FROM documents)", "act", _BAD_CHAINS))
def c11_audit_chain(spark, d):
    c = F.col
    n = len(_BAD_CHAINS) + 2
    act = _docs(spark, d).select(c("doc_id").alias("act"), F.concat(F.lit("abcdef "), "text").alias("first"))
    act = act.withColumns({"draft_ref": F.concat(F.lit("draft/"), _id(c("act"))), "finding_ref": F.concat(F.lit("finding/"), _id(c("act"))), "final": F.concat(F.left("first", F.lit(3)), F.lit("X"), F.substr("first", F.lit(5), F.length("first")))})
    flags = F.when(c("act") % n == n - 3, F.array().cast("array<string>")).otherwise(F.array(F.lit("order")))
    drafts = act.select("act", c("draft_ref").alias("ref"), F.lit(1).alias("ordinal"), c("first").alias("text"), flags.alias("flags"), F.lit(1).alias("rounds_left"))
    requests = act.select("act", "draft_ref", flags.alias("flags"), _sha(F.concat(F.lit("request "), "draft_ref")).alias("digest"))
    change = F.struct(F.lit(3).alias("start"), F.lit(4).alias("end"))
    findings = act.select("act", c("finding_ref").alias("ref"), "draft_ref", F.lit(1).alias("ordinal"), flags.alias("flags"), change.alias("change"), F.lit(False).alias("unresolved"), _sha(c("finding_ref")).alias("digest"), F.array("draft_ref").alias("inputs"))
    rows = act.select("act", F.lit(1).alias("ordinal"), c("final").alias("text"), "draft_ref", "finding_ref", _sha(c("finding_ref")).alias("finding_digest"), _sha(F.concat(F.lit("request "), "draft_ref")).alias("request_digest"), F.lit(False).alias("unresolved"), F.array("draft_ref", "finding_ref").alias("inputs"))
    changes = [
        {"draft_ref": F.lit("draft/none"), "request_digest": _none()}, {"finding_ref": F.lit("finding/none")}, {"ordinal": F.lit(2)}, {"text": F.concat("text", F.lit("!"))}, {"finding_digest": F.lit("?")}, {"unresolved": F.lit(True)}, {"inputs": F.array("draft_ref")}, {"request_digest": F.lit("?")}, {"request_digest": c("request_digest")},
    ]
    return R.audit_chain_violations(_planted(rows, "act", list(zip(_BAD_CHAINS, changes, strict=True))), drafts, requests, findings)


# --- recovery --------------------------------------------------------------------------------------------------------

_POLICY = {"fallback-recrop": 1, "page-level-reread": 2}
_BAD_BUDGETS = ["ordinal not bound", "kind", "counters", "gap, ordinal not bound", "ordinal twice", "over its kind, counters", "over the total, over its kind"]


def _requests(spark, d):
    """Three requests of each act: a recrop and two rereads, with the counters that each found."""
    c = F.col
    rows = _docs(spark, d).select(c("doc_id").alias("act"), F.explode(F.array(F.lit(1), F.lit(2), F.lit(3))).alias("ordinal"))
    n = len(_BAD_BUDGETS) + 2
    fault = lambda k: c("act") % n == k
    rows = rows.unionByName(rows.filter(fault(6) & (c("ordinal") == 3)).withColumn("ordinal", F.lit(4)))
    rows = rows.filter(~(fault(3) & (c("ordinal") == 1)) & ~(fault(5) & (c("ordinal") == 3)))
    rows = rows.withColumn("place", c("ordinal") - F.when(fault(3), 2).otherwise(1))
    rows = rows.withColumn("kind", F.when((c("ordinal") == 1) | (fault(5) & (c("ordinal") == 2)), "fallback-recrop").otherwise("page-level-reread"))
    own = F.when(c("kind") == "fallback-recrop", F.lit(0)).when(fault(3), c("place")).otherwise(c("place") - 1)
    rows = rows.withColumns({
        "outcome": F.lit("recovery-requested"), "attempt_id": C.identity("attempt", subject_id=c("act"), operation=F.lit("recover"), ordinal=c("ordinal")), "budget_allowed": F.lit(3), "budget_used": c("place"),
        "kind_budget_allowed": F.when(c("kind") == "fallback-recrop", 1).otherwise(2), "kind_budget_used": own,
    })
    rows = rows.withColumn("attempt_id", F.when(fault(0) & (c("ordinal") == 2), F.lit("att_0")).when(fault(3) & (c("ordinal") == 2), F.lit("att_1")).otherwise(c("attempt_id")))
    rows = rows.withColumn("budget_used", F.when(fault(2) & (c("ordinal") == 3), 0).otherwise(c("budget_used")))
    twice = fault(4) & (c("ordinal") == 3)
    rows = rows.withColumns({"ordinal": F.when(twice, 2).otherwise(c("ordinal")), "attempt_id": F.when(twice, C.identity("attempt", subject_id=c("act"), operation=F.lit("recover"), ordinal=F.lit(2))).otherwise(c("attempt_id"))})
    return rows.withColumn("kind", F.when(fault(1) & (c("ordinal") == 3), "prayer").otherwise(c("kind"))).drop("place")


@query(_expected("(SELECT doc_id AS act FROM documents)", "act", _BAD_BUDGETS))
def w04_recovery_budget(spark, d):
    """Requests for recovery whose history doesn't reconcile to the sealed budget."""
    return R.recovery_violations(_requests(spark, d), _POLICY)


@query("""SELECT doc_id AS act, 3 AS rounds, 'spent' AS state, '' AS "left" FROM documents WHERE doc_id % 9 > 6""")
def t03_bounded_recovery(spark, d):
    """Rounds that each act spent, of those whose requests reconcile; three at most."""
    return R.recovery_rounds(_requests(spark, d), _POLICY)


# --- coverage and the run's aggregate ------------------------------------------------------------------------------------

_OUTCOMES = ("read", "genuinely-empty", "failed", "dead", "not-run", "excluded")


def _chairs(spark, d):
    """Five chairs of each act: outcomes by turns, some unattached, truncated or without a health record."""
    c = F.col
    rows = _docs(spark, d).select(c("doc_id").alias("act"), F.explode(F.sequence(F.lit(0), F.lit(4))).alias("k"))
    outcome = F.get(F.array(*map(F.lit, _OUTCOMES)), ((c("act") * c("k") + c("act")) % 6).cast("int"))
    return rows.select("act", F.concat(F.lit("chair-"), _id(c("k"))).alias("chair"), outcome.alias("outcome"), ((c("act") + c("k")) % 7 != 0).alias("attached"), ((c("act") + c("k")) % 11 == 0).alias("truncated"), ((c("act") + c("k")) % 13 == 0).alias("health_unrecorded"))


_CHAIRS = """chairs AS (SELECT doc_id AS act, 'chair-' || CAST(k AS VARCHAR) AS chair, list_extract(['read', 'genuinely-empty', 'failed', 'dead', 'not-run', 'excluded'], CAST((doc_id * k + doc_id) % 6 AS BIGINT) + 1) AS outcome,
  (doc_id + k) % 7 <> 0 AS attached, (doc_id + k) % 11 = 0 AS truncated, (doc_id + k) % 13 = 0 AS unrecorded FROM (SELECT doc_id, unnest(range(0, 5)) AS k FROM documents)),
cover AS (SELECT act, count(*) FILTER (outcome IN ('read', 'genuinely-empty') AND attached AND NOT truncated) < 2 AS under_witnessed, count(*) FILTER (outcome = 'not-run') AS unresolved_chairs FROM chairs GROUP BY act)"""


@query(f"""WITH {_CHAIRS} SELECT act, count(*) AS configured, {", ".join(f"count(*) FILTER (outcome = '{o}') AS outcome_{o.replace('-', '_')}" for o in _OUTCOMES)},
  count(*) FILTER (outcome IN ('read', 'genuinely-empty', 'excluded')) AS class_completed, count(*) FILTER (outcome = 'not-run') AS class_unresolved, count(*) FILTER (outcome IN ('failed', 'dead')) AS class_failed,
  count(*) FILTER (outcome IN ('read', 'genuinely-empty') AND attached AND NOT truncated) < 2 AS under_witnessed, count(*) FILTER (outcome IN ('read', 'genuinely-empty') AND NOT (attached AND NOT truncated)) AS page_granularity_only,
  count(*) FILTER (unrecorded) AS health_unrecorded, count(*) FILTER (outcome = 'failed') AS shortfall_failed, count(*) FILTER (truncated) AS shortfall_truncated, count(*) FILTER (NOT attached) AS shortfall_unaligned FROM chairs GROUP BY act""")
def a01_witness_coverage(spark, d):
    return R.witness_coverage(_chairs(spark, d), 2)


def _run(spark, d):
    c = F.col
    category = F.when(c("doc_id") % 5 == 0, "held-for-review").when(c("doc_id") % 5 == 1, "confirmed-blank").otherwise("delivered")
    status = F.when(c("doc_id") % 5 >= 2, F.when(c("doc_id") % 7 == 0, None).when(c("doc_id") % 7 == 1, "partial").otherwise("established")).when(c("doc_id") % 35 == 1, "established")
    acts = _docs(spark, d).select(c("doc_id").alias("act"), category.alias("category"), status.alias("text_status"))
    coverage = R.witness_coverage(_chairs(spark, d).filter("act % 9 <> 0"), 2).select("act", "under_witnessed", c("class_unresolved").alias("unresolved_chairs"))
    stranger = coverage.filter("act % 10 = 1").withColumn("act", -c("act"))
    pages = _docs(spark, d).select(c("doc_id").alias("page"), F.when(c("doc_id") % 8 == 0, "refused").otherwise("sealed").alias("outcome"), F.when(c("doc_id") % 16 == 0, "corrupt").alias("reason"))
    act_pages = acts.filter("act % 12 <> 1").select("act", c("act").alias("page"))
    return acts, coverage.unionByName(stranger), pages, act_pages, spark.createDataFrame([("wittness-2",)], "chair string")


_RUN = f"""{_CHAIRS}, acts AS (SELECT doc_id AS act, CASE WHEN doc_id % 5 = 0 THEN 'held-for-review' WHEN doc_id % 5 = 1 THEN 'confirmed-blank' ELSE 'delivered' END AS category,
  CASE WHEN doc_id % 5 >= 2 THEN CASE WHEN doc_id % 7 = 0 THEN NULL WHEN doc_id % 7 = 1 THEN 'partial' ELSE 'established' END WHEN doc_id % 35 = 1 THEN 'established' END AS text_status FROM documents),
reasons AS (SELECT 'act' AS unit, act AS n, 'act is held-for-review' AS reason FROM acts WHERE category = 'held-for-review'
  UNION ALL SELECT 'act', act, CASE WHEN text_status IS NULL THEN 'text status never measured' ELSE 'delivered with partial' END FROM acts WHERE category = 'delivered' AND (text_status IS NULL OR text_status = 'partial')
  UNION ALL SELECT 'act', act, 'no witness coverage' FROM acts WHERE act % 9 = 0 UNION ALL SELECT 'act', act, 'under-witnessed' FROM cover WHERE act % 9 <> 0 AND under_witnessed
  UNION ALL SELECT 'act', act, 'chair without an outcome' FROM cover WHERE act % 9 <> 0 AND unresolved_chairs > 0 UNION ALL SELECT 'act', -act, 'coverage of an unknown act' FROM cover WHERE act % 9 <> 0 AND act % 10 = 1
  UNION ALL SELECT 'act', act, 'text status of an act that wasn''t delivered' FROM acts WHERE category <> 'delivered' AND text_status IS NOT NULL
  UNION ALL SELECT 'page', doc_id, 'page was refused: ' || CASE WHEN doc_id % 16 = 0 THEN 'corrupt' ELSE 'no reason was recorded' END FROM documents WHERE doc_id % 8 = 0
  UNION ALL SELECT 'page', doc_id, 'sealed and silent' FROM documents WHERE doc_id % 8 <> 0 AND doc_id % 12 = 1)"""


@query(f"""WITH {_RUN} SELECT unit, CAST(n AS VARCHAR) AS subject, reason FROM reasons UNION ALL SELECT 'chair', 'wittness-2', 'no stage addresses the chair'""")
def a02_run_reasons(spark, d):
    """Everything that keeps the run from being complete, each by name."""
    return R.run_reasons(*_run(spark, d))


@query(f"""WITH {_RUN} SELECT 'partial' AS status, (SELECT count(*) FROM acts) AS acts, {", ".join(f"(SELECT count(*) FROM acts WHERE category = '{w}') AS {w.replace('-', '_')}" for w in R.A.CATEGORIES)},
 (SELECT count(*) FROM documents WHERE doc_id % 8 <> 0) AS pages_sealed, (SELECT count(*) FROM documents WHERE doc_id % 8 = 0) AS pages_refused, (SELECT count(*) + 1 FROM reasons) AS reasons""")
def a02_run_aggregate(spark, d):
    return R.run_aggregate(*_run(spark, d))


# --- categories, indexes, attachments, dossiers ----------------------------------------------------------------------------


@query("""SELECT doc_id AS act, CASE doc_id % 7 WHEN 0 THEN 'no review' WHEN 1 THEN 'outstanding recovery' WHEN 2 THEN 'accepted but not established' WHEN 3 THEN 'established twice' WHEN 4 THEN 'established but not accepted' END AS rule FROM documents WHERE doc_id % 7 < 5
UNION ALL SELECT -doc_id, r FROM documents, (VALUES ('unknown act'), ('established but not accepted'), ('no review')) x(r) WHERE doc_id % 50 = 6""")
def j02_act_category(spark, d):
    """The latest review with the established records: orphans, repeats and acts without an end."""
    c = F.col
    acts = _docs(spark, d).select(c("doc_id").alias("act"))
    k = c("act") % 7
    first = acts.filter(k != 0).select("act", F.lit(1).alias("ordinal"), F.lit("recovery-requested").alias("outcome"))
    second = acts.filter((k != 0) & (k != 1)).select("act", F.lit(2).alias("ordinal"), F.when(k == 4, "held-for-review").otherwise("accepted").alias("outcome"))
    kept = acts.filter((k > 2)).unionByName(acts.filter(k == 3)).unionByName(acts.filter("act % 50 = 6").select((-c("act")).alias("act")))
    return R.act_category_violations(acts, first.unionByName(second), kept)


@query("""SELECT doc_id AS act, CASE doc_id % 6 WHEN 0 THEN 'not indexed' WHEN 1 THEN 'repeated entry' WHEN 2 THEN 'digest' WHEN 3 THEN 'no record' END AS rule FROM documents WHERE doc_id % 6 < 4""")
def a24_record_index(spark, d):
    c = F.col
    records = _docs(spark, d).select(c("doc_id").alias("act"), _sha(c("text")).alias("digest"))
    entries = records.filter("act % 6 <> 0").withColumn("digest", F.when(c("act") % 6 == 2, _sha(F.lit("?"))).otherwise(c("digest")))
    return R.index_violations(records.filter("act % 6 <> 3"), entries.unionByName(entries.filter("act % 6 = 1")))


_BAD_VIEWS = ["no current testimony", "span of an unattached view, outcome", "span isn't the whole reading", "outcome", "stale", "chairs, no current testimony", "span beyond the reading"]


@query(_expected("(SELECT doc_id AS act FROM documents)", "act", _BAD_VIEWS))
def k19_attachment_view(spark, d):
    """Act attachments against each chair's current testimony and the configured chairs."""
    c = F.col
    chairs = spark.createDataFrame([("a",), ("b",), ("page",)], "chair string")
    n = len(_BAD_VIEWS) + 2
    fault = lambda k: c("act") % n == k
    rows = _docs(spark, d).select(c("doc_id").alias("act"), F.explode(F.array(F.lit("a"), F.lit("b"), F.lit("page"))).alias("chair"), (F.length("text") + 9).alias("characters"))
    now = rows.filter(~(fault(0) & (c("chair") == "a"))).select("act", "chair", F.when(c("chair") == "b", "failed").otherwise("read").alias("outcome"), c("characters") + F.when(fault(4) & (c("chair") == "a"), 1).otherwise(0))
    now = now.toDF("act", "chair", "outcome", "characters")
    span = lambda a, b: F.struct(F.lit(a).alias("start"), b.alias("end"))
    nowhere = F.lit(None).cast("struct<start:int,end:int>")
    views = rows.withColumns({"page_witness": c("chair") == "page", "attached": c("chair") != "b", "span": F.when(c("chair") == "a", span(0, c("characters"))).when(c("chair") == "page", span(2, F.lit(5)))})
    first = c("chair") == "a"
    views = views.withColumns({
        "attached": F.when(first & (fault(1) | fault(3)), False).otherwise(c("attached")), "chair": F.when(fault(5) & (c("chair") == "b"), "z").otherwise(c("chair")),
        "span": F.when(first & fault(3), nowhere).when(first & fault(2), span(1, c("characters"))).when((c("chair") == "page") & fault(6), span(2, c("characters") + 1)).otherwise(c("span")),
    })
    return R.attachment_violations(views, now, chairs)


def _evidence(spark, d):
    c = F.col
    acts = _docs(spark, d).select(c("doc_id").alias("act"))
    regions = _docs(spark, d).select(c("doc_id").alias("act"), F.explode(F.array(F.lit("r2"), F.lit("r1"))).alias("region"), _sha(c("text")).alias("sha256")).withColumn("image", F.concat_ws("/", "act", "region"))
    told = _docs(spark, d).filter("doc_id % 4 <> 0").select(c("doc_id").alias("act"), F.explode(F.array(F.lit("b"), F.lit("a"))).alias("chair"), c("text"))
    told = told.withColumns({"outcome": F.when((c("chair") == "b") & (c("act") % 3 == 0), "failed").otherwise("read"), "seen": F.when(c("chair") == "a", F.array(F.lit("r1"))).otherwise(F.array(F.lit("r1"), F.lit("r2")))})
    return acts, regions, told


@query("""SELECT doc_id AS act, 2 AS regions, CASE WHEN doc_id % 4 = 0 THEN NULL WHEN doc_id % 3 = 0 THEN 1 ELSE 2 END AS covered, CASE WHEN doc_id % 4 <> 0 THEN 2 END AS witnesses, CASE WHEN doc_id % 4 <> 0 THEN CASE WHEN doc_id % 3 = 0 THEN 1 ELSE 2 END END AS reported,
  CASE WHEN doc_id % 4 <> 0 THEN left(sha256('run-1/a'), 12) < left(sha256('run-1/b'), 12) END AS a_first FROM documents""")
def k20_dossier(spark, d):
    """What each reader is shown: regions in order, whether witnesses cover them, blinded names, and no text of a failed witness."""
    c = F.col
    shown = R.dossiers(*_evidence(spark, d), "blinded", _blind).filter("rule is null")
    covered = F.when(F.exists("regions", lambda r: r["witness_covered"].isNotNull()), F.size(F.filter("regions", lambda r: r["witness_covered"])))
    return shown.select(
        "act", F.size("regions").alias("regions"), covered.alias("covered"), F.when(c("witnesses").isNotNull(), F.size("witnesses")).alias("witnesses"), F.when(c("witnesses").isNotNull(), F.size(F.filter("witnesses", lambda w: w["reported"].isNotNull()))).alias("reported"),
        (c("witnesses")[0]["label"] == _blind(F.lit("a"))).alias("a_first"),
    )


@query("""SELECT doc_id AS act, CASE WHEN doc_id % 4 = 0 THEN NULL ELSE 'labels collide' END AS rule, true AS sealed FROM documents""")
def k20_dossier_collisions(spark, d):
    """Names that a blinding gives to two witnesses are found, and the seal covers the same facts in any order of rows."""
    acts, regions, told = _evidence(spark, d)
    one = R.dossiers(acts, regions, told, "blinded", lambda chair: F.lit("witness"))
    other = R.dossiers(acts, regions.orderBy(F.desc("region")), told.orderBy(F.desc("chair")), "blinded", lambda chair: F.lit("witness"))
    return one.select("act", "rule", "dossier_digest").join(other.select("act", F.col("dossier_digest").alias("again")), "act").select("act", "rule", (F.col("dossier_digest") == F.col("again")).alias("sealed"))


# --- gold ------------------------------------------------------------------------------------------------------------------------


@query("""WITH s AS (SELECT doc_id, CAST(doc_id AS VARCHAR) AS t, doc_id % 14 AS k FROM documents)
SELECT '2' AS subject, 'several draws' AS rule UNION ALL SELECT '2', 'several frames' UNION ALL SELECT 'smp-' || t, 'not in the draw' FROM s WHERE k = 0 UNION ALL SELECT 'page-' || t, 'two strata' FROM s WHERE k = 1
UNION ALL SELECT 'page-' || t, 'two ordinals' FROM s WHERE k = 2 UNION ALL SELECT 'smp-' || t, 'digest of two samples' FROM s WHERE k IN (1, 2) UNION ALL SELECT 'tr-' || t || 'x', 'transcription of no sample' FROM s WHERE k = 4
UNION ALL SELECT 'smp-' || t || '/act-' || t || '/a', 'two readings of one transcriber' FROM s WHERE k = 5 UNION ALL SELECT 'adj-' || t, 'not exactly the act''s transcriptions' FROM s WHERE k IN (5, 6, 7)
UNION ALL SELECT 'adj-' || t, 'embeds what isn''t there' FROM s WHERE k = 6 UNION ALL SELECT 'adj-' || t, 'adjudication of no sample' FROM s WHERE k = 7 UNION ALL SELECT 'smp-' || t || '/act-' || t, 'two adjudications' FROM s WHERE k = 8""")
def c16_gold_corpus(spark, d):
    """A whole gold corpus: one draw and frame, one description of a page, and adjudications of exactly their transcriptions."""
    c = F.col
    base = _docs(spark, d).select(_id(c("doc_id")).alias("t"), (c("doc_id") % 14).alias("k"), c("doc_id").alias("ordinal"), F.concat(F.lit("smp-"), _id(c("doc_id"))).alias("digest"), F.concat(F.lit("page-"), _id(c("doc_id"))).alias("page"))
    name = lambda prefix, suffix="": F.concat(F.lit(prefix), c("t"), F.lit(suffix))
    samples = base.select("digest", "page", F.lit("ordinary").alias("stratum"), "ordinal", F.lit("frame-1").alias("frame"), F.lit("stratified-seed").alias("method"), "k")
    again = samples.filter("k in (1, 2)").withColumns({"stratum": F.when(c("k") == 1, "adverse").otherwise(c("stratum")), "ordinal": F.when(c("k") == 2, -1).otherwise(c("ordinal"))})
    draws = base.filter("k <> 0").select(F.when(c("k") == 3, "draw-2").otherwise("draw-1").alias("draw"), F.when(c("k") == 3, "frame-2").otherwise("frame-1").alias("frame"), c("digest").alias("member"))
    tr = base.select("k", "t", c("digest").alias("sample"), name("act-").alias("act"), F.explode(F.array(F.lit("a"), F.lit("b"))).alias("transcriber")).withColumn("hash", F.concat(F.lit("tr-"), "t", "transcriber"))
    lost = base.filter("k = 4").select("k", "t", F.lit("smp-none").alias("sample"), name("act-").alias("act"), F.lit("a").alias("transcriber"), name("tr-", "x").alias("hash"))
    twice = tr.filter("k = 5 and transcriber = 'a'").withColumn("hash", F.concat("hash", F.lit("2")))
    own = F.array(name("tr-", "a"), name("tr-", "b"))
    adj = base.select("k", "t", F.when(c("k") == 7, "smp-none").otherwise(c("digest")).alias("sample"), name("act-").alias("act"), name("adj-").alias("hash"), F.when(c("k") == 6, F.array(name("tr-", "a"), name("tr-", "z"))).otherwise(own).alias("embedded"))
    more = adj.filter("k = 8").withColumn("hash", F.concat("hash", F.lit("2")))
    return R.gold_violations(samples.unionByName(again).drop("k"), draws, tr.unionByName(lost).unionByName(twice).select("hash", "sample", "act", "transcriber"), adj.unionByName(more).select("hash", "sample", "act", "embedded"))


@query("""SELECT 's' AS sample, doc_id AS act, CASE WHEN doc_id % 7 < 2 THEN 'agreed' WHEN doc_id % 7 = 2 THEN 'adjudicated' END AS basis, CASE WHEN doc_id % 7 < 2 THEN lang WHEN doc_id % 7 = 2 THEN lang || '!' END AS text,
 CASE doc_id % 7 WHEN 3 THEN 'not one adjudicator' WHEN 4 THEN 'adjudicates an own reading' WHEN 5 THEN 'adjudicated though agreed' WHEN 6 THEN 'not two transcribers' END AS rule FROM documents""")
def c20_adjudication(spark, d):
    c = F.col
    base = _docs(spark, d).select(F.lit("s").alias("sample"), c("doc_id").alias("act"), c("lang"), (c("doc_id") % 7).alias("k"))
    first = base.select("sample", "act", "k", F.lit("transcriber").alias("role"), F.lit("ann").alias("transcriber"), c("lang").alias("text"))
    second = base.filter("k <> 6").select("sample", "act", "k", F.lit("transcriber").alias("role"), F.lit("bob").alias("transcriber"), F.when(c("k").isin(0, 1, 5), c("lang")).otherwise(F.concat("lang", F.lit("?"))).alias("text"))
    third = base.filter("k in (2, 4, 5)").select("sample", "act", "k", F.lit("adjudicator").alias("role"), F.when(c("k") == 4, "ann").otherwise("eve").alias("transcriber"), F.concat("lang", F.lit("!")).alias("text"))
    return R.adjudications(first.unionByName(second).unionByName(third).drop("k"))
