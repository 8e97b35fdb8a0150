"""Rules of layers over texts and pages: comparability, forbidden and public fields, uncertainty, attribution, custody, coverage."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import ArrayType, StringType

from lectern.functions import canonical as C
from lectern.functions import geometry as G
from lectern.operators.contracts import first_failure, spans_apart, violations

#: The places of a gap, and the degrees of confidence.
GAP_PLACES = ("leading", "internal", "trailing", "whole-act")
CONFIDENCE = ("low", "medium", "high")
#: The failures of an attempt in the order in which they are looked for.
RECEIPTS = (("prompt", "prompt receipt mismatch"), ("dossier", "dossier receipt mismatch"), ("delivery", "delivery receipt mismatch"))
#: Ink outside coverage that flags a page: so much, or so much and so many hundredths of all.
SUBSTANTIAL_INK, LEAST_INK, LEAST_PERCENT = 2000, 24, 2


def comparability(can_express_uncertainty: Column, view: Column, outcome: Column) -> Column:
    """'compared', 'unknown' (the format may hold markup and has no view without it) or 'not-compared' (no reading)."""
    plain = ~F.coalesce(can_express_uncertainty, F.lit(False)) | view.isNotNull()
    return F.when(~F.coalesce(outcome.isin("read", "genuinely-empty"), F.lit(False)), "not-compared").when(plain, "compared").otherwise("unknown")


def _paths(value: object, names: frozenset[str], path: str) -> list[str]:
    if isinstance(value, dict):
        return [p for k, v in value.items() for p in ([f"{path}.{k}"] if k in names else []) + _paths(v, names, f"{path}.{k}")]
    if isinstance(value, list):
        return [p for i, v in enumerate(value) for p in _paths(v, names, f"{path}[{i}]")]
    return []


def forbidden_keys(payload: Column, names: set[str]) -> Column:
    """Where a JSON payload has a key of a forbidden name, at any depth; '$ isn't JSON' for what can't be read."""
    words = frozenset(names)

    @pandas_udf(ArrayType(StringType()))
    def find(s: pd.Series) -> pd.Series:
        def one(text: str | None) -> list[str]:
            try:
                return _paths(json.loads(text or "null"), words, "$")
            except ValueError:
                return ["$ isn't JSON"]

        return s.map(one)

    return find(payload)


def public_violations(df: DataFrame, subject: list[str], line: str, counts: list[str], words: dict[str, tuple[str, ...]]) -> DataFrame:
    """(subject, rule) of published findings, JSON lines: exactly the allowed fields, counts that are whole and not negative, and
    words of closed vocabularies; nothing else may leave."""
    allowed = sorted([*counts, *words])
    value = lambda f: F.get_json_object(line, f"$.{f}")
    keys = F.array_sort(F.json_object_keys(line))
    rules = {"fields": keys == F.array(*map(F.lit, allowed))}
    rules |= {f"count {f}": value(f).isNull() | value(f).rlike(r"^[0-9]{1,18}\z") for f in counts}
    rules |= {f"word {f}": value(f).isNull() | value(f).isin(*w) for f, w in words.items()}
    return violations(df, subject, rules)


def uncertainty_violations(df: DataFrame, subject: list[str]) -> DataFrame:
    """(subject, rule) of an uncertainty layer over text: spans (start, end, confidence), gaps (position, start, end)."""
    n = F.length("text")
    inside = lambda s: (s["start"] >= 0) & (s["start"] <= s["end"]) & (s["end"] <= n)
    at = lambda place, ok: F.forall("gaps", lambda g: (g["position"] != place) | ok(g))
    bytes_ = F.col("text").cast("binary")
    return violations(
        df,
        subject,
        {
            "span outside the text": F.forall("spans", lambda s: inside(s) & (s["start"] < s["end"])),
            "confidence": F.forall("spans", lambda s: s["confidence"].isin(*CONFIDENCE)),
            "spans overlap": spans_apart(F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))),
            "gap outside the text": F.forall("gaps", inside),
            "gap of some width": F.forall("gaps", lambda g: g["start"] == g["end"]),
            "gap's place": F.forall("gaps", lambda g: g["position"].isin(*GAP_PLACES)),
            "leading gap": at("leading", lambda g: g["start"] == 0),
            "trailing gap": at("trailing", lambda g: g["end"] == n),
            "internal gap": at("internal", lambda g: (g["start"] > 0) & (g["start"] < n)),
            "whole-act gap": at("whole-act", lambda g: (F.trim("text") == "") & (g["start"] == 0) & (F.size("gaps") == 1)),
            "gap inside a span": ~F.exists("gaps", lambda g: F.exists("spans", lambda s: (s["start"] < g["start"]) & (g["start"] < s["end"]))),
            "bytes": F.decode(bytes_, "UTF-8") == F.col("text"),
        },
    )


def attribution_violations(acts: DataFrame, act_pages: DataFrame, pages: DataFrame) -> DataFrame:
    """(unit, subject, rule): acts without a page, pages that nobody counted or sealed, unknown acts, and silent sealed pages.

    acts: act. act_pages: act, page, a row for every page that an act is marked out on. pages: page, outcome.
    """
    c = F.col
    told = lambda df, unit, rule: df.select(F.lit(unit).alias("unit"), c(unit).cast("string").alias("subject"), F.lit(rule).alias("rule"))
    marked = act_pages.join(pages.select("page", "outcome"), "page", "left")
    known = act_pages.join(acts.select("act"), "act", "left_semi")
    return (
        told(act_pages.select("act").distinct().join(acts.select("act"), "act", "left_anti"), "act", "unknown act")
        .unionByName(told(acts.join(act_pages.select("act").distinct(), "act", "left_anti"), "act", "names no page"))
        .unionByName(told(marked.filter("outcome is null").select("act").distinct(), "act", "on a page nobody counted"))
        .unionByName(told(marked.filter("outcome <> 'sealed'").select("act").distinct(), "act", "on a page that wasn't sealed"))
        .unionByName(told(pages.filter("outcome = 'sealed'").join(known.select("page").distinct(), "page", "left_anti"), "page", "sealed and silent"))
    )


def attempt_kind(answered: Column, kind: Column, sent: dict[str, Column], seen: dict[str, Column]) -> Column:
    """What became of an attempt: an exception, an answer of a wrong type, a receipt for other bytes than were sent, or an answer."""
    return first_failure([("exception", ~answered), ("wrong type", ~kind.eqNullSafe(F.lit("response"))), *((name, ~seen[k].eqNullSafe(sent[k])) for k, name in RECEIPTS)], "answered")


def resolved_outcome(declared: Column, classification: Column, text: Column) -> Column:
    """A declared failure, else a cut-off reading, else one without text, else 'read'."""
    return F.coalesce(declared, F.when(classification != "complete", "truncated"), F.when(F.trim(F.coalesce(text, F.lit(""))) == "", "no-readable-text"), F.lit("read"))


def custody_violations(bindings: DataFrame, blobs: DataFrame, receipts: DataFrame) -> DataFrame:
    """(page, rule) of retained answers: one blob, one receipt and one page, tied by a binding that names both digests.

    bindings: page, receipt_sha256, response_sha256, self_sha256. blobs: sha256, content. receipts: sha256, page.
    """
    c = F.col
    held = blobs.select(c("sha256").alias("response_sha256"), F.sha2("content", 256).alias("actual"))
    given = receipts.groupBy(c("sha256").alias("receipt_sha256")).agg(F.count("*").alias("receipts"), F.max("page").alias("receipt_page"))
    owners = bindings.groupBy("response_sha256").agg(F.count_distinct("page").alias("owners"))
    per = bindings.groupBy("page").agg(F.count("*").alias("bindings"))
    rows = bindings.join(held, "response_sha256", "left").join(given, "receipt_sha256", "left").join(owners, "response_sha256").join(per, "page")
    sealed = C.digest(C.record(page=c("page"), receipt_sha256=c("receipt_sha256"), response_sha256=c("response_sha256")))
    return violations(
        rows,
        ["page"],
        {
            "binding altered": c("self_sha256") == sealed,
            "blob missing": c("actual").isNotNull(),
            "blob altered": c("actual").isNull() | (c("actual") == c("response_sha256")),
            "receipt missing": c("receipts").isNotNull(),
            "receipt of another page": c("receipts").isNull() | (c("receipt_page") == c("page")),
            "blob of two pages": c("owners") == 1,
            "two bindings": c("bindings") == 1,
        },
    ).distinct()


def residual_ink(ink: DataFrame, covered: DataFrame) -> DataFrame:
    """(page, total, outside, flagged): ink boxes (page, box; apart from each other) less every region cut for the page.

    A page is flagged for much ink outside, or for some that is a share of all; whole numbers decide.
    """
    claims = covered.groupBy("page").agg(F.collect_list("box").alias("claims"))  # the regions of a page are few
    none = F.array().cast(covered.select(F.array("box").alias("b")).schema["b"].dataType)
    rows = ink.join(claims, "page", "left").withColumn("claims", F.coalesce("claims", none))
    area = F.col("box.w") * F.col("box.h")
    sums = rows.groupBy("page").agg(F.sum(area).alias("total"), F.sum(G.area(G.remaining(F.col("box"), F.col("claims")))).alias("outside"))
    some = (F.col("outside") >= LEAST_INK) & (F.col("outside") * 100 >= LEAST_PERCENT * F.col("total"))
    return sums.withColumn("flagged", (F.col("outside") >= SUBSTANTIAL_INK) | some)


def resolution(proposals: DataFrame, occlusions: DataFrame) -> DataFrame:
    """(page, id, disposition, occlusion_ids, inside, overlaps): every proposal once; any occlusion on the page asks for review.

    proposals: page, id, box. occlusions: page, occlusion_id, none twice. `inside` are the proposals that contain this one
    (equal boxes contain each other), `overlaps` those that cut across it.
    """
    c = F.col
    pairs = proposals.select("page", c("id").alias("other"), c("box").alias("o")).join(proposals, "page").filter("id <> other")
    holds, meets = G.contains(c("o"), c("box")), G.overlap_area(c("o"), c("box")) > 0
    found = pairs.groupBy("page", "id").agg(
        F.array_sort(F.collect_set(F.when(holds, c("other")))).alias("inside"),
        F.array_sort(F.collect_set(F.when(meets & ~holds & ~G.contains(c("box"), c("o")), c("other")))).alias("overlaps"),
    )
    seen = occlusions.groupBy("page").agg(F.array_sort(F.collect_list("occlusion_id")).alias("occlusion_ids"))
    none = F.array().cast("array<string>")
    rows = proposals.join(found, ["page", "id"], "left").join(seen, "page", "left")
    rows = rows.withColumn("occlusion_ids", F.coalesce("occlusion_ids", none))
    return rows.select("page", "id", F.when(F.size("occlusion_ids") > 0, "review").otherwise("accepted-coverage").alias("disposition"), "occlusion_ids", *(F.coalesce(k, F.array().cast("array<long>")).alias(k) for k in ("inside", "overlaps")))


def tiles(width: Column, height: Column, tile_w: int, tile_h: int, overlap: int, offset: int) -> Column:
    """An array of (pass_ordinal, x, y, w, h): the grid of a page from the top, and once more from the vertical offset."""
    n = lambda v: F.lit(v).cast("long")

    def one(k: int, first: int) -> Column:
        downs = F.when(height > first, F.sequence(n(first), height - 1, n(tile_h))).otherwise(F.array().cast("array<long>"))
        across = F.sequence(n(0), width - 1, n(tile_w - overlap))
        return F.flatten(
            F.transform(downs, lambda y: F.transform(across, lambda x: F.struct(F.lit(k).alias("pass_ordinal"), x.alias("x"), y.alias("y"), F.least(n(tile_w), width - x).alias("w"), F.least(n(tile_h), height - y).alias("h"))))
        )

    return F.concat(one(0, 0), one(1, offset))


def region_binding_violations(regions: DataFrame, acts: DataFrame, pages: DataFrame) -> DataFrame:
    """(region, rule): a region cut for an act lies on a page that the act is marked out on, and that is sealed.

    regions: region, act, page. acts: act, page, a row for each of an act's pages. pages: page, sealed.
    """
    c = F.col
    rows = regions.join(acts.select("act", "page").distinct().withColumn("marked", F.lit(True)), ["act", "page"], "left").join(acts.select("act").distinct().withColumn("known", F.lit(True)), "act", "left")
    rows = rows.join(pages.select("page", "sealed"), "page", "left")
    return violations(rows, ["region"], {"of an unknown act": F.coalesce("known", F.lit(False)), "on a page of another act": F.coalesce("marked", F.lit(False)) | c("known").isNull(), "on an unsealed page": F.coalesce("sealed", F.lit(False))})


def sample_violations(selected: DataFrame, scoreable: DataFrame, excluded: DataFrame, key: str) -> DataFrame:
    """(key, rule): scoreable and excluded members are apart, all selected, and together the whole sample; statuses agree.

    selected: key, status. scoreable and excluded: key, status.
    """
    c = F.col
    flag = lambda df, name: df.select(key, F.lit(True).alias(name), c("status").alias(name + "_status"))
    rows = selected.select(key, F.lit(True).alias("chosen"), "status").join(flag(scoreable, "scored"), key, "full").join(flag(excluded, "left_out"), key, "full")
    got = lambda name: F.coalesce(name, F.lit(False))
    return violations(
        rows,
        [key],
        {
            "in both": ~(got("scored") & got("left_out")),
            "in neither": got("scored") | got("left_out"),
            "not selected": got("chosen"),
            "status": ~got("chosen") | F.coalesce(F.coalesce("scored_status", "left_out_status") == c("status"), F.lit(True)),
        },
    )
