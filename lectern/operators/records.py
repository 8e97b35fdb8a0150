"""Rules of whole records: what makes an envelope, an approval, a reading, an established record and their links sound.

Every operator takes frames and gives a row for each rule that a record breaks; a sound table gives none. Rules that look
at several records are joins and aggregations on the records' keys.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lectern.functions import canonical as C
from lectern.operators import accounting as A
from lectern.operators.contracts import violations

#: The fields of an envelope and of an approval, and the closed vocabularies of both.
ENVELOPE_FIELDS = ("artifact_id", "attempt_id", "config_digest", "inputs", "kind", "outcome", "payload", "producer", "run_id", "schema", "self_hash", "stage", "subject_id")
APPROVAL_ACTIONS = ("exclusion", "salvage-promotion", "other")
#: What a request for recovery may ask for, and the most that one act may ask.
RECOVERY_KINDS = ("fallback-recrop", "page-level-reread")
ABSOLUTE_CAP = 3
#: Outcomes that are a witness's reading.
READING = ("read", "genuinely-empty")


def _named(text: Column) -> Column:
    return F.coalesce(F.trim(text) != "", F.lit(False))


def artifact_identity(stage: Column, kind: Column, subject: Column, attempt: Column) -> Column:
    """The identity of an artifact from what it is bound to; attempt is null for what is made once."""
    bound = C.record(stage=stage, kind=kind, subject_id=subject, attempt_id=attempt)
    return F.concat(F.lit(C.PREFIXES["artifact"] + "_"), F.left(C.digest(C.record(bindings=bound, kind=F.lit("artifact"))), F.lit(C.DIGEST_CHARS)))


def envelope_violations(df: DataFrame, label: str, subject: list[str]) -> DataFrame:
    """(subject, rule) of envelopes: fields as columns, `keys` the names that the record itself holds.

    inputs is an array of (relative_path, sha256), producer a struct (stage, adapter_revision), payload JSON text.
    self_hash covers every field but itself.
    """
    c = F.col
    known = F.array(*[F.lit(f"{stage}/{outcome}") for stage, outcome, *_ in A.ALGEBRA])
    path = lambda r: r["relative_path"]
    refs = F.coalesce(c("inputs"), F.array().cast("array<struct<relative_path:string,sha256:string>>"))
    escapes = lambda p: p.startswith("/") | F.array_contains(F.split(p, "/"), "..")
    sealed = C.digest(C.record(**{f: c(f) for f in (*ENVELOPE_FIELDS, "approval_ref") if f != "self_hash"}))
    bound = artifact_identity(c("stage"), c("kind"), c("subject_id"), c("attempt_id"))
    return violations(
        df,
        subject,
        {
            "fields": F.array_sort(F.array_except("keys", F.array(F.lit("approval_ref")))) == F.array(*map(F.lit, ENVELOPE_FIELDS)),
            "schema": c("schema") == label,
            "stage": c("stage").isin(sorted({s for s, *_ in A.ALGEBRA})),
            "empty field": _named(c("run_id")) & _named(c("kind")) & _named(c("config_digest")) & _named(c("subject_id")),
            "artifact identity": C.is_identity(c("artifact_id")),
            "attempt identity": c("attempt_id").isNull() | (C.is_identity(c("attempt_id")) & c("attempt_id").startswith("att_")),
            "artifact binding": c("artifact_id") == bound,
            "producer's stage": c("producer.stage") == c("stage"),
            "producer's revision": _named(c("producer.adapter_revision")),
            "outcome": F.array_contains(known, F.concat_ws("/", "stage", "outcome")),
            "approval": (c("outcome") != "excluded") | (c("stage") != "designator") | _named(c("approval_ref")),
            "input path": F.forall(refs, lambda r: _named(path(r)) & ~escapes(path(r))),
            "input digest": F.forall(refs, lambda r: F.coalesce(C.is_sha256(r["sha256"]), F.lit(False))),
            "input listed twice": F.size(F.array_distinct(F.transform(refs, path))) == F.size(refs),
            "payload": F.json_object_keys("payload").isNotNull(),
            "self hash": c("self_hash") == sealed,
        },
    )


def approval_violations(df: DataFrame, approver: str, subject: list[str]) -> DataFrame:
    """(subject, rule) of approvals (schema, subject_ids, action, approver, reason, target_version_hash, timestamp, self_hash)."""
    c = F.col
    sealed = C.digest(C.record(**{f: c(f) for f in ("schema", "subject_ids", "action", "approver", "reason", "target_version_hash", "timestamp")}))
    return violations(
        df,
        subject,
        {
            "schema": c("schema") == "approval-record.v0",
            "approver": c("approver") == approver,
            "action": c("action").isin(*APPROVAL_ACTIONS),
            "subjects": (F.size("subject_ids") > 0) & F.forall("subject_ids", _named),
            "reason": _named(c("reason")),
            "timestamp": _named(c("timestamp")),
            "target version": C.is_sha256(c("target_version_hash")),
            "self hash": c("self_hash") == sealed,
        },
    )


def approvals(df: DataFrame, approver: str) -> DataFrame:
    """Sealed approvals of (subject_ids, action, reason, target_version_hash, timestamp): subjects in order, and the self hash."""
    out = df.withColumns({"schema": F.lit("approval-record.v0"), "approver": F.lit(approver), "subject_ids": F.array_sort("subject_ids")})
    return out.withColumn("self_hash", C.digest(C.record(**{f: F.col(f) for f in ("schema", "subject_ids", "action", "approver", "reason", "target_version_hash", "timestamp")})))


def reading_violations(df: DataFrame, subject: list[str], label_of) -> DataFrame:
    """(subject, rule) of reading payloads.

    act_key, outcome, text, lectio_kind, basis (chairs; null where the reader was shown none), dissent (chairs), provenance
    (witness_regime, chair_state, resolved_identity), dossier (act_key, witness_regime, labels, prior_view),
    dossier_digest, draft_fed, truncation. label_of gives a chair's blinded name as a column.
    """
    c = F.col
    primed = c("basis").isNotNull()
    labels = F.when(c("dossier.witness_regime") == "named", c("basis")).otherwise(F.transform("basis", label_of))
    same = lambda a, b: F.array_sort(a) == F.array_sort(b)
    view = c("dossier.prior_view")
    return violations(
        df,
        subject,
        {
            "a reading without text": (c("outcome") != "read") | _named(c("text")),
            "an unprimed reading that dissents": primed | (F.size("dissent") == 0),
            "dissent not on its basis": ~primed | same(c("dissent"), c("basis")),
            "witness regime": c("provenance.witness_regime").isin("named", "blinded"),
            "configured chair without identity": (c("provenance.chair_state") != "configured") | _named(c("provenance.resolved_identity")),
            "dossier's act": c("dossier.act_key") == c("act_key"),
            "dossier's regime": c("dossier.witness_regime") == c("provenance.witness_regime"),
            "dossier digest": c("dossier_digest") == C.digest(c("dossier")),
            "kind of reading": c("lectio_kind").isNull() | c("lectio_kind").isin("primed-with-prior", "primed-without-prior"),
            "prior draft": F.when(c("lectio_kind") == "primed-with-prior", F.coalesce(view.isin("fed", "withheld"), F.lit(False))).when(c("lectio_kind") == "primed-without-prior", view.isNull()).otherwise(True),
            "view of the draft": view.isNull() | c("draft_fed").isNull() | (view == F.when(c("draft_fed"), "fed").otherwise("withheld")),
            "witness labels": F.when(primed, same(c("dossier.labels"), labels)).otherwise(F.size("dossier.labels") == 0),
            "truncation": c("truncation").isin("complete", "truncated", "unknown"),
            "read but not complete": (c("outcome") != "read") | (c("truncation") == "complete"),
            "truncated but complete": (c("outcome") != "truncated") | (c("truncation") != "complete"),
        },
    )


def established_violations(established: DataFrame, reviews: DataFrame, readings: DataFrame, regions: DataFrame) -> DataFrame:
    """(act, rule) where an established record isn't exactly what its accepted review's reading holds.

    established: act, page, status, text, gaps, text_status, regions, provenance, review_ref, reading_ref, inputs, self_ok.
    reviews: act, ref, ordinal, outcome, reading_ref, inputs. readings: act, ref, ordinal, text, gaps, regions, provenance.
    regions: act, path, origin ('original' or 'recovery'). A record is compared with the review and reading that it names;
    the latest ones have to be the same.
    """
    latest = lambda df, name: df.groupBy("act").agg(F.max_by("ref", "ordinal").alias(name))
    c = F.col
    v = reviews.select("act", c("ref").alias("review_ref"), c("outcome").alias("v_outcome"), c("reading_ref").alias("v_reading"), c("inputs").alias("v_inputs"))
    r = readings.select("act", c("ref").alias("reading_ref"), *(c(k).alias("r_" + k) for k in ("text", "gaps", "regions", "provenance")))
    tries = readings.groupBy("act").agg(F.count("*").alias("readings"))
    cuts = regions.groupBy("act").agg(F.count_if(c("origin") == "recovery").alias("recrops"))
    both = established.join(v, ["act", "review_ref"], "left").join(r, ["act", "reading_ref"], "left")
    both = both.join(latest(reviews, "last_review"), "act", "left").join(latest(readings, "last_reading"), "act", "left").join(tries, "act", "left").join(cuts, "act", "left")
    status = F.when(F.trim("text") == "", "no_readable_text").when(F.size("gaps") > 0, "partial").otherwise("established")
    wanted = F.array_sort(F.concat(F.array("review_ref", "reading_ref"), c("regions")))
    return violations(
        both,
        ["act"],
        {
            "self hash": c("self_ok"),
            "status": c("status") == "established",
            "review missing or not accepted": c("v_outcome") == "accepted",
            "review isn't the latest": c("review_ref") == c("last_review"),
            "another reading than the review's": c("v_reading") == c("reading_ref"),
            "review doesn't input its reading": F.array_contains("v_inputs", c("reading_ref")),
            "reading missing": c("r_text").isNotNull(),
            "a newer reading exists": c("reading_ref") == c("last_reading"),
            "a recrop without rereading": c("readings") == F.coalesce("recrops", F.lit(0)) + 1,
            "text": c("text") == c("r_text"),
            "gaps": c("gaps") == c("r_gaps"),
            "regions": F.array_sort("regions") == F.array_sort("r_regions"),
            "provenance": c("provenance") == c("r_provenance"),
            "text status": c("text_status") == status,
            "inputs": F.array_sort("inputs") == wanted,
        },
    )


def establish(reviews: DataFrame, readings: DataFrame) -> DataFrame:
    """(act, text, text_status, review_ref, reading_ref, inputs, rule): the one established record of each act, or why there is none.

    Only the reading that the latest review accepted may become one: a reading that succeeded, and was primed with its
    witnesses. reviews: act, ref, ordinal, outcome, reading_ref. readings: act, ref, kind, outcome, text, gaps, regions.
    """
    c = F.col
    rest = [k for k in reviews.columns if k != "act"]
    last = reviews.groupBy("act").agg(F.max_by(F.struct(*rest), "ordinal").alias("v"))
    r = readings.select("act", c("ref").alias("reading_ref"), "kind", c("outcome").alias("read_as"), "text", "gaps", "regions")
    both = last.select("act", c("v.ref").alias("review_ref"), c("v.outcome").alias("decided"), c("v.reading_ref").alias("reading_ref")).join(r, ["act", "reading_ref"], "left")
    rule = (
        F.when(c("decided") != "accepted", F.concat(F.lit("review is "), c("decided")))
        .when(c("read_as").isNull(), "reading missing")
        .when(~c("kind").isin("primed-with-prior", "primed-without-prior"), "unprimed reading")
        .when(c("read_as") != "read", F.concat(F.lit("reading is "), c("read_as")))
        .when(~_named(c("text")), "reading without text")
    )
    sound = lambda value: F.when(c("rule").isNull(), value)
    status = F.when(F.size("gaps") > 0, "partial").otherwise("established")
    return both.withColumn("rule", rule).select(
        "act", sound(c("text")).alias("text"), sound(status).alias("text_status"), "review_ref", "reading_ref", sound(F.concat(F.array("review_ref", "reading_ref"), F.array_sort("regions"))).alias("inputs"), "rule"
    )


def audit_chain_violations(readings: DataFrame, drafts: DataFrame, requests: DataFrame, findings: DataFrame) -> DataFrame:
    """(act, rule) where draft, request, finding and final reading don't make one chain.

    drafts: act, ref, ordinal, text, flags (classes), rounds_left. requests: act, draft_ref, flags, digest. findings: act,
    ref, draft_ref, ordinal, flags, change (start, end; null where nothing changed), unresolved, digest, inputs. readings:
    act, ordinal, text, draft_ref, finding_ref, finding_digest, request_digest (null where none was due), unresolved, inputs.
    """
    c = F.col
    d = drafts.select("act", c("ref").alias("draft_ref"), *(c(k).alias("d_" + k) for k in ("ordinal", "text", "flags", "rounds_left")))
    q = requests.select("act", "draft_ref", c("flags").alias("q_flags"), c("digest").alias("q_digest"))
    f = findings.select("act", c("ref").alias("finding_ref"), *(c(k).alias("f_" + k) for k in ("draft_ref", "ordinal", "flags", "change", "unresolved", "digest", "inputs")))
    all_ = readings.join(d, ["act", "draft_ref"], "left").join(q, ["act", "draft_ref"], "left").join(f, ["act", "finding_ref"], "left")
    from lectern.functions.text import change_span

    change = F.when(c("d_text") != c("text"), change_span(c("d_text"), c("text")))
    due = (F.size("d_flags") > 0) & (c("d_rounds_left") > 0)
    return violations(
        all_,
        ["act"],
        {
            "draft missing": c("d_ordinal").isNotNull(),
            "finding missing": c("f_digest").isNotNull(),
            "finding of another draft": c("f_draft_ref") == c("draft_ref"),
            "frozen facts differ": (c("d_ordinal") == c("f_ordinal")) & (c("d_flags") == c("f_flags")),
            "another attempt": c("ordinal") == c("d_ordinal"),
            "change": c("f_change").eqNullSafe(change),
            "finding digest": c("finding_digest") == c("f_digest"),
            "unresolved": c("unresolved") == c("f_unresolved"),
            "finding's inputs": c("f_inputs") == F.array("draft_ref"),
            "reading's inputs": F.array_contains("inputs", c("draft_ref")) & F.array_contains("inputs", c("finding_ref")),
            "request": F.when(due, c("request_digest").eqNullSafe(c("q_digest")) & c("request_digest").isNotNull() & (c("q_flags") == c("d_flags"))).otherwise(c("request_digest").isNull()),
        },
    )


def recovery_violations(requests: DataFrame, policy: dict[str, int]) -> DataFrame:
    """(act, rule) where an act's requests for recovery don't reconcile to the sealed budget.

    requests: act, ordinal, kind, outcome, attempt_id, budget_allowed, budget_used, kind_budget_allowed, kind_budget_used.
    policy: allowances by kind. Recorded counters are checked against the requests that came before, not trusted; a kind
    that isn't known has no allowance but a rule of its own.
    """
    if any(n < 0 for n in policy.values()) or sum(policy.values()) > ABSOLUTE_CAP or set(policy) != set(RECOVERY_KINDS):
        raise ValueError("not a recovery policy: both kinds, none negative, within the absolute cap")
    c, allowed = F.col, sum(policy.values())
    own = F.create_map(*[F.lit(x) for kv in sorted(policy.items()) for x in kv])[c("kind")]
    by = lambda *keys: F.row_number().over(Window.partitionBy("act", *keys).orderBy("ordinal", "budget_used")) - 1
    rows = requests.withColumns({"before": by(), "before_kind": by("kind"), "own": own})
    counters = (c("budget_allowed") == allowed) & (c("budget_used") == c("before")) & (c("kind_budget_allowed") == c("own")) & (c("kind_budget_used") == c("before_kind"))
    each = violations(
        rows,
        ["act"],
        {
            "ordinal not bound": (c("outcome") == "recovery-requested") & (c("attempt_id") == C.identity("attempt", subject_id=c("act"), operation=F.lit("recover"), ordinal=c("ordinal"))),
            "kind": c("kind").isin(*RECOVERY_KINDS),
            "counters": counters | ~c("kind").isin(*RECOVERY_KINDS),
        },
    )
    sums = rows.groupBy("act").agg(F.count("*").alias("n"), F.min("ordinal").alias("low"), F.max("ordinal").alias("high"), F.count_distinct("ordinal").alias("d"), F.max(c("before_kind") + 1 - c("own")).alias("over"))
    whole = violations(
        sums,
        ["act"],
        {"ordinal twice": c("n") == c("d"), "gap": (c("low") == 1) & (c("high") == c("d")), "over the total": (c("n") <= allowed) & (c("n") <= ABSOLUTE_CAP), "over its kind": F.coalesce(c("over") <= 0, F.lit(True))},
    )
    return each.unionByName(whole).distinct()


def recovery_rounds(requests: DataFrame, policy: dict[str, int]) -> DataFrame:
    """(act, rounds, state) of acts with sound requests: how many rounds were spent, and whether more may follow.

    state is 'spent' where the total is used up, else 'open' with the kinds left in `left`.
    """
    broken = recovery_violations(requests, policy).select("act").distinct()
    sound = requests.join(broken, "act", "left_anti").groupBy("act").agg(F.count("*").alias("rounds"), *(F.count_if(F.col("kind") == k).alias(k) for k in RECOVERY_KINDS))
    left = F.array_compact(F.array(*[F.when(F.col(f"`{k}`") < policy[k], k) for k in RECOVERY_KINDS]))
    return sound.select("act", "rounds", F.when(F.col("rounds") >= sum(policy.values()), "spent").otherwise("open").alias("state"), F.array_join(left, ",").alias("left"))


def witness_coverage(chairs: DataFrame, floor: int) -> DataFrame:
    """One row for each act of chairs (act, chair, outcome, attached, truncated, health_unrecorded): counts by outcome and by
    class, shortfalls, and whether attached, untruncated readings fall below the floor.

    An outcome that witnesses don't have, and a chair without a name, are fatal: the job stops.
    """
    c = F.col
    outcomes = [o for s, o, *_ in A.ALGEBRA if s == "attestatores"]
    classes = {o: k for s, o, k, _ in A.ALGEBRA if s == "attestatores"}
    checked = chairs.withColumn("outcome", F.when(c("outcome").isin(*outcomes) & _named(c("chair")), c("outcome")).otherwise(F.raise_error(F.concat(F.lit("no witness outcome or chair: "), F.coalesce("outcome", F.lit("null"))))))
    cut, there, reading = F.coalesce("truncated", F.lit(False)), F.coalesce("attached", F.lit(False)), c("outcome").isin(*READING)
    counted = reading & there & ~cut
    number = lambda ok: F.count_if(ok)
    by_class = [number(c("outcome").isin(*[o for o in outcomes if classes[o] == k])).alias("class_" + k) for k in A.CLASSES]
    return checked.groupBy("act").agg(
        F.count("*").alias("configured"),
        *(number(c("outcome") == o).alias("outcome_" + o.replace("-", "_")) for o in outcomes),
        *by_class,
        (number(counted) < floor).alias("under_witnessed"),
        number(reading & ~counted).alias("page_granularity_only"),
        number(F.coalesce("health_unrecorded", F.lit(False))).alias("health_unrecorded"),
        number(c("outcome") == "failed").alias("shortfall_failed"),
        number(cut).alias("shortfall_truncated"),
        number(~there).alias("shortfall_unaligned"),
    )


def run_reasons(acts: DataFrame, coverage: DataFrame, pages: DataFrame, act_pages: DataFrame, chairs: DataFrame) -> DataFrame:
    """(unit, subject, reason) of everything that keeps a run from being complete.

    acts: act, category, text_status. coverage: act, under_witnessed, unresolved_chairs. pages: page, outcome, reason.
    act_pages: act, page. chairs: configured chairs that no stage addresses.
    """
    c = F.col
    told = lambda df, unit, key, reason: df.select(F.lit(unit).alias("unit"), c(key).cast("string").alias("subject"), reason.alias("reason")).filter("reason is not null")
    own = acts.join(coverage.withColumn("covered", F.lit(True)), "act", "left")
    status = F.when(c("category") == "delivered", F.when(c("text_status").isNull(), "text status never measured").when(c("text_status") != "established", F.concat(F.lit("delivered with "), c("text_status"))))
    marked = act_pages.select("page").distinct().withColumn("marked", F.lit(True))
    census = pages.join(marked, "page", "left")
    page = F.when(c("outcome") != "sealed", F.concat(F.lit("page was refused: "), F.coalesce("reason", F.lit("no reason was recorded")))).when(c("marked").isNull(), "sealed and silent")
    frames = [
        told(own, "act", "act", F.when(~c("category").isin("delivered", "excluded-with-approval", "confirmed-blank"), F.concat(F.lit("act is "), c("category")))),
        told(own, "act", "act", status),
        told(own, "act", "act", F.when(c("covered").isNull(), "no witness coverage")),
        told(own, "act", "act", F.when(c("under_witnessed"), "under-witnessed")),
        told(own, "act", "act", F.when(c("unresolved_chairs") > 0, "chair without an outcome")),
        told(coverage.join(acts.select("act"), "act", "left_anti"), "act", "act", F.lit("coverage of an unknown act")),
        told(acts.filter((c("category") != "delivered") & c("text_status").isNotNull()), "act", "act", F.lit("text status of an act that wasn't delivered")),
        told(census, "page", "page", page),
        told(chairs, "chair", "chair", F.lit("no stage addresses the chair")),
    ]
    return reduce(DataFrame.unionByName, frames)


def run_aggregate(acts: DataFrame, coverage: DataFrame, pages: DataFrame, act_pages: DataFrame, chairs: DataFrame) -> DataFrame:
    """One row (status, acts, by category a count, pages sealed and refused, reasons); a run of nothing isn't complete."""
    c = F.col
    reasons = run_reasons(acts, coverage, pages, act_pages, chairs).agg(F.count("*").alias("reasons"))
    by = acts.agg(F.count("*").alias("acts"), *(F.count_if(c("category") == w).alias(w.replace("-", "_")) for w in A.CATEGORIES))
    census = pages.agg(F.count_if(c("outcome") == "sealed").alias("pages_sealed"), F.count_if(c("outcome") != "sealed").alias("pages_refused"))
    out = by.join(F.broadcast(census)).join(F.broadcast(reasons))  # one row each
    return out.select(F.when((c("reasons") == 0) & (c("acts") + c("pages_sealed") > 0), "complete").otherwise("partial").alias("status"), "*")


def act_category_violations(acts: DataFrame, reviews: DataFrame, established: DataFrame) -> DataFrame:
    """(act, rule) where the latest review and the established records don't give an act one category.

    acts: act. reviews: act, ordinal, outcome. established: act.
    """
    c = F.col
    last = reviews.groupBy("act").agg(F.max_by("outcome", "ordinal").alias("outcome"))
    held = established.groupBy("act").agg(F.count("*").alias("records"))
    both = acts.select("act").join(last, "act", "full").join(held, "act", "full").withColumn("records", F.coalesce("records", F.lit(0)))
    known = both.join(acts.select("act", F.lit(True).alias("known")), "act", "left")
    accepted = F.coalesce(c("outcome") == "accepted", F.lit(False))
    return violations(
        known,
        ["act"],
        {
            "unknown act": F.coalesce("known", F.lit(False)),
            "no review": c("outcome").isNotNull(),
            "outstanding recovery": F.coalesce(c("outcome") != "recovery-requested", F.lit(True)),
            "accepted but not established": ~accepted | (c("records") > 0),
            "established twice": c("records") <= 1,
            "established but not accepted": accepted | (c("records") == 0),
        },
    )


def index_violations(records: DataFrame, index: DataFrame) -> DataFrame:
    """(act, rule) where an index (act, digest) isn't one entry for each record (act, digest)."""
    c = F.col
    entries = index.groupBy("act").agg(F.count("*").alias("entries"), F.max("digest").alias("entered"))
    held = records.groupBy("act").agg(F.count("*").alias("records"), F.max("digest").alias("digest"))
    both = held.join(entries, "act", "full")
    return violations(
        both,
        ["act"],
        {"not indexed": c("entries").isNotNull(), "no record": c("records").isNotNull(), "repeated entry": F.coalesce(c("entries") <= 1, F.lit(True)), "two records": F.coalesce(c("records") <= 1, F.lit(True)), "digest": c("entries").isNull() | c("records").isNull() | (c("digest") == c("entered"))},
    )


def attachment_violations(attachments: DataFrame, current: DataFrame, chairs: DataFrame) -> DataFrame:
    """(act, rule) of act attachments (act, chair, page_witness, attached, characters, span) against each chair's current
    testimony (act, chair, outcome, characters) and the configured chairs (chair)."""
    c = F.col
    now = current.select("act", "chair", c("outcome").alias("now_outcome"), c("characters").alias("now_characters"))
    rows = attachments.join(now, ["act", "chair"], "left")
    each = violations(
        rows,
        ["act"],
        {
            "no current testimony": c("now_outcome").isNotNull(),
            "span of an unattached view": c("attached") | c("span").isNull(),
            "span isn't the whole reading": ~c("attached") | c("page_witness") | F.coalesce((c("span.start") == 0) & (c("span.end") == c("characters")), F.lit(False)),
            "span beyond the reading": c("span").isNull() | ((c("span.start") >= 0) & (c("span.start") <= c("span.end")) & (c("span.end") <= c("characters"))),
            "outcome": c("now_outcome").isNull() | c("page_witness") | (c("attached") == c("now_outcome").isin(*READING)),
            "stale": c("now_outcome").isNull() | (c("characters") == c("now_characters")),
        },
    )
    seats = chairs.agg(F.array_sort(F.collect_set("chair")).alias("seats"))  # the configured chairs are few
    sets = attachments.groupBy("act").agg(F.array_sort(F.collect_list("chair")).alias("own")).join(F.broadcast(seats))
    return each.unionByName(violations(sets, ["act"], {"chairs": c("own") == c("seats")})).distinct()


def dossiers(acts: DataFrame, regions: DataFrame, testimonia: DataFrame, regime: str, label_of) -> DataFrame:
    """(act, regions, witnesses, dossier_digest, rule): what a reader of an act is shown, sealed.

    regions: act, region, image, sha256. testimonia: act, chair, outcome, text, seen (regions). Regions and witnesses stand
    in orders of their own that tell nothing of a preference; a region is `covered` if a witness that read it names it, and
    without witnesses the fact isn't there at all. Blinded names that collide give rule 'labels collide'.
    """
    c = F.col
    reading = testimonia.filter(c("outcome").isin(*READING))
    seen = reading.select("act", F.explode("seen").alias("region")).distinct().withColumn("covered", F.lit(True))
    label = c("chair") if regime == "named" else label_of(c("chair"))
    shown = testimonia.select("act", label.alias("label"), "outcome", F.when(c("outcome").isin(*READING), c("text")).alias("reported"))
    witnesses = shown.groupBy("act").agg(F.array_sort(F.collect_list(F.struct("label", "outcome", "reported"))).alias("witnesses"))
    rows = regions.join(seen, ["act", "region"], "left").join(witnesses.select("act", F.lit(True).alias("primed")), "act", "left")
    covered = F.when(c("primed"), F.coalesce("covered", F.lit(False)))
    rows = rows.groupBy("act").agg(F.array_sort(F.collect_list(F.struct("region", "image", "sha256", covered.alias("witness_covered")))).alias("regions"))
    out = acts.select("act").join(rows, "act", "left").join(witnesses, "act", "left")
    out = out.withColumn("dossier_digest", C.digest(C.record(act=c("act"), witness_regime=F.lit(regime), regions=c("regions"), witnesses=c("witnesses"))))
    names = F.transform("witnesses", lambda w: w["label"])
    return out.withColumn("rule", F.when(F.size(F.array_distinct(names)) < F.size(names), "labels collide"))


def gold_violations(samples: DataFrame, draws: DataFrame, transcriptions: DataFrame, adjudications: DataFrame) -> DataFrame:
    """(subject, rule) over a whole gold corpus.

    samples: digest, page, stratum, ordinal, frame, method. draws: draw, frame, member. transcriptions: hash, sample, act,
    transcriber. adjudications: hash, sample, act, embedded (hashes).
    """
    c = F.col

    def told(df: DataFrame, key: Column, rule: str) -> DataFrame:
        return df.select(key.cast("string").alias("subject"), F.lit(rule).alias("rule"))

    pages = samples.groupBy("page").agg(F.count_distinct("stratum").alias("strata"), F.count_distinct("ordinal").alias("ordinals"))
    frames = samples.select("frame").union(draws.select("frame")).distinct().agg(F.count("*").alias("n"))
    one = draws.agg(F.count_distinct("draw").alias("n"))
    key = ["sample", "act"]
    twice = transcriptions.groupBy("sample", "act", "transcriber").agg(F.count_distinct("hash").alias("n")).filter("n > 1")
    own = transcriptions.groupBy(*key).agg(F.array_sort(F.collect_set("hash")).alias("own"))
    judged = adjudications.join(own, key, "left")
    absent = adjudications.select("hash", F.explode("embedded").alias("part")).join(transcriptions.select(c("hash").alias("part")), "part", "left_anti").select("hash").distinct()
    known = samples.select(c("digest").alias("sample")).distinct()
    described = samples.groupBy("digest").agg(F.count_distinct(F.struct("page", "stratum", "ordinal", "frame", "method")).alias("n"))
    frames_ = [
        told(one.filter("n > 1"), c("n"), "several draws"),
        told(frames.filter("n > 1"), c("n"), "several frames"),
        told(samples.filter("method = 'stratified-seed'").join(draws.select(c("member").alias("digest")), "digest", "left_anti"), c("digest"), "not in the draw"),
        told(pages.filter("strata > 1"), c("page"), "two strata"),
        told(pages.filter("ordinals > 1"), c("page"), "two ordinals"),
        told(described.filter("n > 1"), c("digest"), "digest of two samples"),
        told(transcriptions.join(known, "sample", "left_anti"), c("hash"), "transcription of no sample"),
        told(twice, F.concat_ws("/", "sample", "act", "transcriber"), "two readings of one transcriber"),
        told(adjudications.join(known, "sample", "left_anti"), c("hash"), "adjudication of no sample"),
        told(absent, c("hash"), "embeds what isn't there"),
        told(judged.filter(~F.coalesce(c("own") == F.array_sort("embedded"), F.lit(False))), c("hash"), "not exactly the act's transcriptions"),
        told(adjudications.groupBy(*key).agg(F.count_distinct("hash").alias("n")).filter("n > 1"), F.concat_ws("/", "sample", "act"), "two adjudications"),
    ]
    return reduce(DataFrame.unionByName, frames_)


def adjudications(readings: DataFrame) -> DataFrame:
    """(sample, act, basis, text, rule) of two independent readings (sample, act, transcriber, text) and an adjudicator's.

    readings has role 'transcriber' or 'adjudicator'. Equal texts agree and need no adjudicator; else the adjudicator's
    text stands, who is none of the transcribers.
    """
    c = F.col
    by = readings.groupBy("sample", "act").agg(
        F.array_sort(F.collect_set(F.when(c("role") == "transcriber", F.struct("transcriber", "text")))).alias("two"),
        F.array_sort(F.collect_set(F.when(c("role") == "adjudicator", F.struct("transcriber", "text")))).alias("third"),
    )  # two and three at most, where the table is sound; more are told by the rule
    texts = F.array_distinct(F.transform("two", lambda x: x["text"]))
    names = F.transform("two", lambda x: x["transcriber"])
    agreed = (F.size("two") == 2) & (F.size(texts) == 1)
    judge = F.get("third", F.lit(0))
    rule = (
        F.when((F.size("two") != 2) | (F.size(F.array_distinct(names)) != 2), "not two transcribers")
        .when(agreed & (F.size("third") > 0), "adjudicated though agreed")
        .when(~agreed & (F.size("third") != 1), "not one adjudicator")
        .when(~agreed & F.array_contains(names, judge["transcriber"]), "adjudicates an own reading")
    )
    return by.select("sample", "act", F.when(rule.isNull(), F.when(agreed, "agreed").otherwise("adjudicated")).alias("basis"), F.when(rule.isNull(), F.when(agreed, texts[0]).otherwise(judge["text"])).alias("text"), rule.alias("rule"))
