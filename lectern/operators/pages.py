"""Pages and the acts on them: analysis, conservation, testimony of whole pages and what of it reaches each act."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.functions import geometry as G
from lectern.functions import text as T
from lectern.operators.contracts import first_failure, violations

#: Outcomes that are a witness's reading.
READING = ("read", "genuinely-empty")


def page_evidence_violations(pages: DataFrame, blobs: DataFrame) -> DataFrame:
    """(page, rule) of sealed and refused pages (page, state, pixels, reason, source) against the bytes (sha256, content) they name."""
    c = F.col
    held = blobs.select(c("sha256").alias("pixels"), F.sha2("content", 256).alias("actual"))
    rows = pages.join(held, "pixels", "left")
    sealed = c("state") == "sealed"
    return violations(
        rows,
        ["page"],
        {
            "state": c("state").isin("sealed", "refused"),
            "sealed without pixels": ~sealed | c("pixels").isNotNull(),
            "pixels missing": ~sealed | c("pixels").isNull() | c("actual").isNotNull(),
            "pixels altered": c("actual").isNull() | (c("actual") == c("pixels")),
            "sealed with a reason": ~sealed | c("reason").isNull(),
            "refused with pixels": sealed | c("pixels").isNull(),
            "refused without a reason": sealed | F.coalesce(F.trim("reason") != "", F.lit(False)),
            "no source": c("source").isNotNull(),
        },
    )


def page_analysis(pages: DataFrame, levels: DataFrame, ink: DataFrame, width: int, height: int) -> DataFrame:
    """(page, basis, background, components, regions): what is found on a page, or four bands that are read in its stead.

    pages: page. levels: page, value, n, a histogram of grey. ink: page, id, x, y, w, h, components that stand out. The
    background is the commonest level, the least of equal ones; a page without a histogram has none measured, and is cut
    into bands all the same, as is one on which nothing stands out.
    """
    from lectern.operators.metrics import histogram_mode

    background = histogram_mode(levels.select("page", "value"), ["page"], "value").select("page", F.col("mode").alias("background"))
    found = ink.groupBy("page").agg(F.count("*").alias("components"))
    rows = pages.join(background, "page", "left").join(found, "page", "left")
    measured = F.col("background").isNotNull() & (F.coalesce("components", F.lit(0)) > 0)
    bands = F.size(G.bands(F.lit(width).cast("long"), F.lit(height).cast("long"))).cast("long")
    return rows.select("page", F.when(measured, "detected").otherwise("fallback").alias("basis"), "background", F.when(measured, F.col("components")).alias("components"), F.when(measured, F.col("components")).otherwise(bands).alias("regions"))


def declared_acts(acts: DataFrame, pages: DataFrame, failures: DataFrame) -> DataFrame:
    """(act, disposition): held with a reason where a page of the act isn't sealed, failed, or a continuation lacks its page; else proposed.

    acts: act, page, continues_on (null or a page). pages: page, state. failures: page.
    """
    c = F.col
    own = acts.join(pages.select("page", "state"), "page", "left").join(failures.select("page").distinct().withColumn("failed", F.lit(True)), "page", "left")
    there = pages.filter("state = 'sealed'").select(c("page").alias("continues_on")).distinct().withColumn("continued", F.lit(True))
    rows = own.join(there, "continues_on", "left")
    held = first_failure([("held: page not sealed", ~F.coalesce(c("state") == "sealed", F.lit(False))), ("held: page failed", F.coalesce("failed", F.lit(False))), ("held: continuation missing", c("continues_on").isNotNull() & c("continued").isNull())], "proposed")
    return rows.select("act", held.alias("disposition"))


def residual_acts(parts: DataFrame, claims: DataFrame) -> DataFrame:
    """(page, key, box, outcome): components (page, id, box) that no claim (page, box) touches, held as acts of a namespace of their own."""
    from pyspark.sql import Window

    taken = claims.groupBy("page").agg(F.collect_list("box").alias("claims"))
    rows = parts.join(taken, "page", "left")
    free = F.col("claims").isNull() | F.forall("claims", lambda q: G.overlap_area(F.col("box"), q) == 0)
    place = F.row_number().over(Window.partitionBy("page").orderBy("box.y", "box.x", "id")) - 1  # the components of a page
    rows = rows.filter(free).withColumn("place", place)
    return rows.select("page", F.concat(F.lit("residual:"), F.col("page").cast("string"), F.lit(":"), F.col("place").cast("string")).alias("key"), "box", F.lit("held").alias("outcome"))


def denominator_violations(residual: DataFrame, expected: DataFrame) -> DataFrame:
    """(key, rule): each residual act (key, page) is in the denominator (key, page, kind) once, as one of its kind, and no other is."""
    c = F.col
    kept = expected.groupBy("key").agg(F.count("*").alias("n"), F.max("page").alias("e_page"), F.max("kind").alias("kind"))
    rows = residual.join(kept, "key", "full").filter((c("page").isNotNull()) | (c("kind") == "residual"))
    return violations(
        rows,
        ["key"],
        {"not in the denominator": c("n").isNotNull(), "counted twice": F.coalesce(c("n") <= 1, F.lit(True)), "of another page": c("n").isNull() | c("page").isNull() | (c("e_page") == c("page")), "of another kind": c("n").isNull() | (c("kind") == "residual"), "no such residual": c("page").isNotNull()},
    )


def page_testimony(parts: DataFrame) -> DataFrame:
    """(page, chair, text): a chair's whole text of a page, from its parts (page, chair, ordinal, text) in order, blanks left out."""
    kept = parts.filter(F.trim(F.coalesce("text", F.lit(""))) != "")
    rows = kept.groupBy("page", "chair").agg(F.array_sort(F.collect_list(F.struct("ordinal", "text"))).alias("m"))  # the parts of a page
    return rows.select("page", "chair", F.array_join(F.transform("m", lambda x: x["text"]), "\n").alias("text"))


def act_attachments(testimony: DataFrame, anchors: DataFrame) -> DataFrame:
    """(page, chair, act, attached, start, end, reason): where an act's share of the anchor's text lies in each chair's page text.

    testimony: page, chair, text. anchors: page, text, acts (array of act, start, end in the anchor's text). One alignment
    is made for a page and chair; an act's span is the hull of the blocks within its range, in the chair's own characters.
    """
    both = testimony.withColumnRenamed("text", "own").join(anchors, "page")
    both = both.withColumn("a", T.alignment_blocks("own", "text")).select("page", "chair", "a", F.explode("acts").alias("act"))
    clipped = F.filter(
        F.transform(
            "a.blocks",
            lambda b: F.struct(
                (b["a"] + F.greatest(F.lit(0), F.col("act.start") - b["b"])).alias("start"),
                (b["a"] + F.least(b["size"], F.col("act.end") - b["b"])).alias("end"),
            ),
        ),
        lambda s: s["start"] < s["end"],
    )
    found = both.withColumn("s", clipped)
    there = F.size("s") > 0
    reason = F.when(F.col("a.reason").isNotNull(), F.col("a.reason")).when(~there, "no block in the act's range")
    return found.select(
        "page", "chair", F.col("act.act").alias("act"), (there & F.col("a.reason").isNull()).alias("attached"),
        F.when(there, F.array_min(F.transform("s", lambda x: x["start"]))).alias("start"), F.when(there, F.array_max(F.transform("s", lambda x: x["end"]))).alias("end"), reason.alias("reason"),
    )


def replay_violations(testimonia: DataFrame, regions: DataFrame) -> DataFrame:
    """(act, chair, rule): recorded health, outcome and regions of testimonies against what their text and the cut regions give again.

    testimonia: act, chair, text, completed, outcome, characters, blank, truncated, seen (regions). regions: act, region.
    """
    c = F.col
    now = T.health(c("text"), c("completed"))
    cut = regions.groupBy("act").agg(F.array_sort(F.collect_set("region")).alias("cut"))
    rows = testimonia.join(cut, "act", "left").withColumn("now", now)
    outcome = F.when(c("text").isNull(), "failed").when(c("now.blank"), "genuinely-empty").otherwise("read")
    return violations(
        rows,
        ["act", "chair"],
        {
            "characters": c("now.characters") == c("characters"),
            "blank": c("now.blank") == c("blank"),
            "truncated": c("now.truncated") == c("truncated"),
            "outcome": c("outcome") == outcome,
            "regions": F.size(F.array_except("seen", F.coalesce("cut", F.array().cast("array<string>")))) == 0,
        },
    )


def denominators(current: DataFrame, chairs: DataFrame) -> DataFrame:
    """(act, chairs, missing, strangers, whole): an act's current testimonies (act, chair) against the configured chairs (chair)."""
    seats = chairs.agg(F.array_sort(F.collect_set("chair")).alias("seats"))  # the configured chairs are few
    own = current.groupBy("act").agg(F.array_sort(F.collect_set("chair")).alias("own"), F.count("*").alias("n")).join(F.broadcast(seats))
    missing, strangers = F.array_except("seats", "own"), F.array_except("own", "seats")
    whole = (F.size(missing) == 0) & (F.size(strangers) == 0) & (F.col("n") == F.size("own"))
    return own.select("act", F.size("own").alias("chairs"), F.array_join(missing, ",").alias("missing"), F.array_join(strangers, ",").alias("strangers"), whole.alias("whole"))


def chair_facts(attempts: DataFrame, attachments: DataFrame) -> DataFrame:
    """(act, chair, ordinal, outcome, attached, truncated, stale): each chair's current attempt beside its attachment.

    attempts: act, chair, ordinal, outcome. attachments: act, chair, ordinal (of the attempt that they were made from),
    attached, truncated. An attachment of an earlier attempt is stale; without one nothing is attached.
    """
    from lectern.operators.attempts import latest

    now = latest(attempts.select("act", "chair", "ordinal", "outcome"), ["act", "chair"], "ordinal")
    made = attachments.select("act", "chair", F.col("ordinal").alias("made_from"), "attached", "truncated")
    rows = now.join(made, ["act", "chair"], "left")
    return rows.select(
        "act", "chair", "ordinal", "outcome", F.coalesce(F.col("attached") & F.col("outcome").isin(*READING), F.lit(False)).alias("attached"), F.coalesce("truncated", F.lit(False)).alias("truncated"),
        (F.col("made_from").isNotNull() & (F.col("made_from") != F.col("ordinal"))).alias("stale"),
    )


def coverage_violations(facts: DataFrame, chairs: DataFrame, floor: int) -> DataFrame:
    """(act, rule) of chair_facts: a stale attachment, a chair too few or too many, and attached readings below the floor."""
    d = denominators(facts, chairs).select("act", "whole")
    sums = facts.groupBy("act").agg(F.bool_or("stale").alias("stale"), F.count_if(F.col("attached") & ~F.col("truncated")).alias("readings"))
    return violations(sums.join(d, "act"), ["act"], {"stale attachment": ~F.col("stale"), "not the configured chairs": F.col("whole"), "under the floor": F.col("readings") >= floor})


def current_requests(reviews: DataFrame, requests: DataFrame) -> DataFrame:
    """(act, request, rule): the request for recovery that an act's latest review asks for, by reference.

    reviews: act, ordinal, outcome, request_ref. requests: act, ordinal, ref. A review that asks names the latest request;
    one that doesn't ask names none.
    """
    c = F.col
    last = reviews.groupBy("act").agg(F.max_by(F.struct("outcome", "request_ref"), "ordinal").alias("v"))
    asked = requests.groupBy("act").agg(F.max_by("ref", "ordinal").alias("latest"))
    rows = last.select("act", "v.*").join(requests.select("act", c("ref").alias("request_ref"), F.lit(True).alias("there")), ["act", "request_ref"], "left").join(asked, "act", "left")
    asks = c("outcome") == "recovery-requested"
    rule = first_failure([("names a request without asking", ~asks & c("request_ref").isNotNull()), ("asks without a request", asks & c("request_ref").isNull()), ("request missing", asks & c("there").isNull()), ("a newer request exists", asks & (c("request_ref") != c("latest")))])
    return rows.select("act", F.when(asks & rule.isNull(), c("request_ref")).alias("request"), rule.alias("rule")).filter("request is not null or rule is not null")


def crop_closure_violations(records: DataFrame, regions: DataFrame, blobs: DataFrame) -> DataFrame:
    """(act, rule): a record's crops are regions cut for it whose bytes are those referred to; a blank one shows every region seen.

    records: act, blank, crops (array of region, sha256), seen (regions that the blank finding names). regions: act, region.
    blobs: sha256, content.
    """
    c = F.col
    cut = regions.groupBy("act").agg(F.array_sort(F.collect_set("region")).alias("cut"))
    crops = records.select("act", F.explode("crops").alias("k")).select("act", c("k.region").alias("region"), c("k.sha256").alias("sha256"))
    held = blobs.select("sha256", F.sha2("content", 256).alias("actual"))
    each = crops.join(held, "sha256", "left").join(regions.select("act", "region", F.lit(True).alias("there")), ["act", "region"], "left")
    found = violations(each, ["act"], {"crop of no region": F.coalesce("there", F.lit(False)), "crop missing": c("actual").isNotNull(), "crop altered": c("actual").isNull() | (c("actual") == c("sha256"))})
    blank = records.filter("blank").join(cut, "act", "left")
    return found.unionByName(violations(blank, ["act"], {"blank without every region": F.coalesce(F.array_sort("seen") == c("cut"), F.lit(False))})).distinct()


def provenance_violations(df: DataFrame, subject: list[str], fixture: Column) -> DataFrame:
    """(subject, rule) of serving provenance (state, model, revision, engine, config_sha256, receipt): a configured chair names what it
    ran, by a full revision, and its receipt; one that isn't configured names nothing. fixture tells synthetic runs, which have no receipt."""
    from lectern.functions.canonical import is_revision, is_sha256

    c = F.col
    ran = c("state") == "configured"
    given = lambda k: F.coalesce(F.trim(k) != "", F.lit(False))
    return violations(
        df,
        subject,
        {
            "state": c("state").isin("configured", "not-configured"),
            "model": ~ran | given("model"),
            "revision": ~ran | F.coalesce(is_revision(c("revision")), F.lit(False)),
            "engine": ~ran | given("engine"),
            "configuration": ~ran | F.coalesce(is_sha256(c("config_sha256")), F.lit(False)),
            "receipt": ~ran | fixture | given("receipt"),
            "receipt of a synthetic run": ~fixture | c("receipt").isNull(),
            "names what didn't run": ran | (c("model").isNull() & c("revision").isNull() & c("receipt").isNull()),
        },
    )


def export_violations(claims: DataFrame, members: DataFrame, sources: DataFrame) -> DataFrame:
    """(member, rule): an export manifest's claims (member, sha256, bytes, rows) against the members (member, content) and sources (member, rows)."""
    c = F.col
    held = members.groupBy("member").agg(F.count("*").alias("copies"), F.max(F.sha2("content", 256)).alias("actual"), F.max(F.octet_length("content")).alias("size"))
    own = sources.groupBy("member").agg(F.sum("rows").alias("source_rows"))
    rows = claims.withColumn("claimed", F.lit(True)).join(held, "member", "full").join(own, "member", "left")
    there = c("copies").isNotNull() & c("claimed").isNotNull()
    return violations(
        rows,
        ["member"],
        {
            "not in the manifest": c("claimed").isNotNull(),
            "not in the export": c("copies").isNotNull(),
            "member twice": F.coalesce(c("copies") <= 1, F.lit(True)),
            "digest": ~there | (c("actual") == c("sha256")),
            "bytes": ~there | (c("size") == c("bytes")),
            "rows": c("claimed").isNull() | (c("rows") == F.coalesce("source_rows", F.lit(0))),
        },
    )
