"""Audit of readings on a page: flags frozen once, neutral requests to look again, anchors, conditions, configurations and residue."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.functions import geometry as G
from lectern.functions import text as T
from lectern.operators.contracts import spans_apart, violations
from lectern.operators.intervals import lagged, ranked


def audit_flags(current: DataFrame, siblings: DataFrame) -> DataFrame:
    """(page, act, flags): what about a page's readings asks for a second look, from current and sealed ones together.

    Both hold page, act, declared (the place that the proposal gave it), y (where it stands) and text; a sealed sibling is
    left out where a current reading of the act is there. A flag is (class, start, end) in the act's text: a year below that
    of the last reading that has one, a place that isn't the declared one, a word said twice.
    """
    c = F.col
    every = current.unionByName(siblings.join(current.select("page", "act"), ["page", "act"], "left_anti"))
    year = F.nullif(T.first_year(c("text")), F.lit("")).cast("int")
    rows = ranked(ranked(every.withColumn("year", year), ["page"], ["declared", "act"], "a"), ["page"], ["y", "act"], "b")
    dated = lagged(rows.filter("year is not null").select("page", "act", "declared", "year"), ["page"], ["declared", "act"], "year", "before").select("page", "act", "before")
    rows = rows.join(dated, ["page", "act"], "left").withColumn("twice", T.repeated_word(c("text")))
    flag = lambda name, start, end: F.struct(F.lit(name).alias("class"), start.cast("int").alias("start"), end.cast("int").alias("end"))
    at = F.call_function("position", c("year").cast("string"), c("text")) - 1
    again = F.regexp_instr("text", F.lit(r"(?iU)\b(\w+)\s+\1\b")) - 1
    found = F.array_compact(
        F.array(
            F.when(c("year") < c("before"), flag("date-sequence", at, at + 4)),
            F.when(c("a") != c("b"), flag("order", F.lit(0), F.length("text"))),
            F.when(c("twice") != "", flag("repetition", again, again + F.length("twice"))),
        )
    )
    return rows.select("page", "act", F.array_sort(found).alias("flags")).filter(F.size("flags") > 0)


def reproof_plan(flags: DataFrame) -> DataFrame:
    """(page, act, start, end, request): one neutral question for each flagged place, which names neither the flag nor a witness."""
    places = F.array_sort(F.array_distinct(F.transform("flags", lambda f: F.struct(f["start"].alias("start"), f["end"].alias("end")))))
    rows = flags.select("page", "act", F.explode(places).alias("p")).select("page", "act", "p.*")
    told = F.concat(F.lit("Read characters "), F.col("start").cast("string"), F.lit(" to "), F.col("end").cast("string"), F.lit(" again and write what the ink shows."))
    return rows.withColumn("request", told)


def annotation_violations(df: DataFrame, subject: list[str]) -> DataFrame:
    """(subject, rule) of annotations (start, end, kind) over text beside uncertain spans (start, end)."""
    n = F.length("text")
    over = lambda a: F.exists("uncertain", lambda s: (a["start"] < s["end"]) & (s["start"] < a["end"]))
    bare = F.transform("annotations", lambda a: F.struct(a["start"].alias("start"), a["end"].alias("end")))
    return violations(
        df,
        subject,
        {
            "outside the text": F.forall("annotations", lambda a: (a["start"] >= 0) & (a["start"] < a["end"]) & (a["end"] <= n)),
            "kind": F.forall("annotations", lambda a: a["kind"].isin("illegible", "struck", "inserted")),
            "annotations overlap": spans_apart(bare),
            "over an uncertain span": ~F.exists("annotations", over),
        },
    )


def unclaimed(regions: DataFrame, claims: DataFrame) -> DataFrame:
    """(page, place, area, pieces): what all claims (page, box) on a page leave of each of its regions (page, place, box)."""
    taken = claims.groupBy("page").agg(F.collect_list("box").alias("claims"))  # the claims of a page are few
    rows = regions.join(taken, "page", "left")
    left = F.when(F.col("claims").isNull(), F.array("box")).otherwise(G.remaining(F.col("box"), F.col("claims")))
    return rows.withColumn("left", left).select("page", "place", G.area(F.col("left")).alias("area"), F.size("left").alias("pieces"))


def condition_violations(dossiers: DataFrame, conditions: dict[str, tuple[bool, bool]]) -> DataFrame:
    """(act, condition, rule): a dossier (act, condition, image, testimonia) shows what its condition allows, and each act has all of them.

    conditions: for each, whether the image and whether testimonies are shown.
    """
    c = F.col
    table = F.create_map(*[F.lit(x) for k, (a, b) in sorted(conditions.items()) for x in (k, f"{int(a)}{int(b)}")])
    shown = F.concat(F.when(c("image").isNotNull(), "1").otherwise("0"), F.when(F.size(F.coalesce("testimonia", F.array().cast("array<string>"))) > 0, "1").otherwise("0"))
    each = violations(dossiers.withColumn("want", table[c("condition")]), ["act", "condition"], {"unknown condition": c("want").isNotNull(), "shows other than its condition": c("want").isNull() | (c("want") == shown)})
    sets = dossiers.groupBy("act").agg(F.array_sort(F.collect_list("condition")).alias("own")).withColumn("condition", F.lit("*"))
    return each.unionByName(violations(sets, ["act", "condition"], {"not every condition once": c("own") == F.array(*map(F.lit, sorted(conditions)))}))


def configuration_violations(sealed: DataFrame, uses: DataFrame) -> DataFrame:
    """(run, file, rule): configuration read at use (run, file, content) against what the run sealed (run, file, sha256)."""
    c = F.col
    read = uses.groupBy("run", "file").agg(F.collect_set(F.sha2("content", 256)).alias("read"))  # a digest or two
    rows = sealed.join(read, ["run", "file"], "full")
    return violations(
        rows, ["run", "file"], {"never sealed": c("sha256").isNotNull(), "sealed but never read": c("read").isNotNull(), "read in two forms": F.coalesce(F.size("read") <= 1, F.lit(True)), "differs from its seal": c("sha256").isNull() | c("read").isNull() | F.array_contains("read", c("sha256"))}
    )


def residue(observed: DataFrame, declared: DataFrame) -> DataFrame:
    """(path, rule): files seen after a cleanup (path) against its report (path, state 'removed' or 'kept')."""
    c = F.col
    rows = observed.select("path").distinct().withColumn("there", F.lit(True)).join(declared.select("path", "state"), "path", "full")
    return violations(rows, ["path"], {"left behind": c("there").isNull() | c("state").isNull() | (c("state") == "kept"), "nowhere in the report": c("state").isNotNull(), "kept but gone": c("state").isNull() | (c("state") != "kept") | c("there").isNotNull()})


def testimony_joins(spans: DataFrame, attachments: DataFrame) -> DataFrame:
    """(page, act, chair, characters, rule): attachments (page, act, chair, ref, start, end) with the page testimony (page, chair, ref, text) that they name."""
    c = F.col
    rows = attachments.join(spans.select("page", "chair", "ref", "text"), ["page", "chair", "ref"], "left")
    inside: Column = (c("start") >= 0) & (c("start") <= c("end")) & (c("end") <= F.length("text"))
    rule = F.when(c("text").isNull(), "names no testimony of the page and chair").when(~inside, "span outside the testimony")
    return rows.select("page", "act", "chair", F.when(rule.isNull(), c("end") - c("start")).alias("characters"), rule.alias("rule"))
