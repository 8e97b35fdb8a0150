"""Joins and components of rectangles; every join has the page as its equi-key."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lectern.functions import geometry as G

#: How many pairs of boxes are compared at once; those of one box may be more.
PAIRS = 1 << 20


def _named(df: DataFrame, name: str) -> DataFrame:
    return df.select("page", F.col("id").alias(name), G.box(*(F.col(c) for c in "xywh")).alias(name + "_box"))


def relations(boxes: DataFrame) -> DataFrame:
    """(page, left, right, state) of each pair of boxes on a page that touch each other, left < right."""
    pairs = _named(boxes, "left").join(_named(boxes, "right"), "page").filter("left < right")
    return pairs.select("page", "left", "right", G.relation(F.col("left_box"), F.col("right_box")).alias("state")).filter("state is not null")


def best_match(declared: DataFrame, groups: DataFrame) -> DataFrame:
    """(page, id, group, overlap, verdict): the group that covers most of each declared box.

    'missed' if it covers less than half, 'tie' if several cover most, else 'matched'.
    """
    pairs = _named(declared, "id_").join(_named(groups, "group"), "page", "left")
    scored = pairs.withColumn("overlap", F.when(F.col("group").isNull(), F.lit(0).cast("long")).otherwise(G.overlap_area(F.col("id__box"), F.col("group_box"))))
    best = scored.groupBy("page", F.col("id_").alias("id"), "id__box").agg(F.max_by(F.struct("overlap", "group"), F.struct("overlap", F.negative(F.col("group")))).alias("b"), F.max("overlap").alias("top"))
    ties = scored.join(best.select("page", F.col("id").alias("id_"), "top"), ["page", "id_"]).filter("overlap = top").groupBy("page", F.col("id_").alias("id")).agg(F.count("*").alias("n"))
    size = F.col("id__box")["w"] * F.col("id__box")["h"]
    verdict = F.when(F.col("top") * 2 < size, "missed").when(F.col("n") > 1, "tie").otherwise("matched")
    return best.join(ties, ["page", "id"]).select("page", "id", F.when(verdict == "matched", F.col("b.group")).alias("group"), F.col("top").alias("overlap"), verdict.alias("verdict"))


def structural_evidence(declared: DataFrame, groups: DataFrame, analysis: DataFrame) -> DataFrame:
    """(page, id, basis, bounds, body, anchors, rationale, refused): the evidence that stands behind each declared box.

    groups: page, id, x, y, w, h, body, anchors, rationale. analysis: page, basis. On a page cut into bands there is nothing to
    match, and it says so with nulls and zeros; elsewhere a box that no group covers half of, or that several cover
    alike, is refused, as are two boxes that claim one group.
    """
    c = F.col
    found = best_match(declared, groups).join(analysis.select("page", "basis"), "page")
    facts = groups.select("page", c("id").alias("group"), F.struct("x", "y", "w", "h").alias("bounds"), "body", "anchors", "rationale")
    rows = found.join(facts, ["page", "group"], "left")
    owners = found.filter("basis = 'detected' and group is not null").groupBy("page", "group").agg(F.count("*").alias("owners"))
    rows = rows.join(owners, ["page", "group"], "left")
    detected = c("basis") == "detected"
    refused = F.when(detected, F.when(c("verdict") != "matched", c("verdict")).when(c("owners") > 1, "claimed twice"))
    sound = detected & refused.isNull()
    none = lambda k: F.when(sound, c(k)).otherwise(F.lit(0).cast("long"))
    return rows.select("page", "id", "basis", F.when(sound, c("bounds")).alias("bounds"), none("body").alias("body"), none("anchors").alias("anchors"), F.when(detected, F.when(sound, c("rationale"))).otherwise("fallback band").alias("rationale"), refused.alias("refused"))


def uncontained(candidates: DataFrame, claims: DataFrame) -> DataFrame:
    """(page, id, touched): candidates that no claim on their page contains, and how many claims they touch."""
    a, b = _named(candidates, "id_"), _named(claims, "claim")
    free = a.join(b, (a["page"] == b["page"]) & G.contains(F.col("claim_box"), F.col("id__box")), "left_anti")
    met = free.join(b.withColumnRenamed("page", "p"), (free["page"] == F.col("p")) & G.overlaps(F.col("id__box"), F.col("claim_box")), "left")
    return met.groupBy(free["page"], F.col("id_").alias("id")).agg(F.count_distinct("claim").alias("touched"))


def union_bounds(boxes: DataFrame, keys: list[str]) -> DataFrame:
    x, y = F.min("x"), F.min("y")
    return boxes.groupBy(*keys).agg(x.alias("x"), y.alias("y"), (F.max(F.col("x") + F.col("w")) - x).alias("w"), (F.max(F.col("y") + F.col("h")) - y).alias("h"))


def continuations(groups: DataFrame, pages: DataFrame, reach: int, column_overlap: int = 0) -> DataFrame:
    """(page, next_page, trailing, leading) where a page's last group touches its bottom edge, the next page's
    first one its top edge without an anchor, and the two share a column.

    groups has page, id, x, y, w, h and anchors; pages has page, ordinal and height.
    """
    full = groups.join(pages, "page")
    last = full.groupBy("page", "ordinal", "height").agg(F.max_by(F.struct("id", "x", "w", (F.col("y") + F.col("h")).alias("bottom")), F.struct(F.col("y") + F.col("h"), F.negative("y"), F.negative("x"))).alias("a"))
    first = full.groupBy(F.col("page").alias("next_page"), (F.col("ordinal") - 1).alias("ordinal")).agg(F.min_by(F.struct("id", "x", "w", "y", "anchors"), F.struct("y", "x", "id")).alias("b"))
    near = (F.col("height") - F.col("a.bottom") <= reach) & (F.col("b.y") <= reach) & (F.col("b.anchors") == 0)
    column = (F.col("a.x") <= F.col("b.x") + F.col("b.w") + column_overlap) & (F.col("b.x") <= F.col("a.x") + F.col("a.w") + column_overlap)
    return last.join(first, "ordinal").filter(near & column).select("page", "next_page", F.col("a.id").alias("trailing"), F.col("b.id").alias("leading"))


def _turns(page: pa.Array) -> np.ndarray:
    """Which rows are of another page than the row before."""
    value, null = page.fill_null(0).to_numpy(zero_copy_only=False), page.is_null().to_numpy(zero_copy_only=False)
    return np.concatenate(([False], (value[1:] != value[:-1]) | (null[1:] != null[:-1])))


def _whole_pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows that come by page, in batches of whole pages: a page waits for its last row."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        page = batch.column("page")
        cut = int(np.flatnonzero(_turns(page)).max(initial=0))
        if cut:
            held.append(batch.slice(0, cut))
        if held and (cut or held[-1].column("page")[-1].as_py() != page[0].as_py()):
            yield pa.concat_batches(held)
            held = []
        held.append(batch.slice(cut))
    if held:
        yield pa.concat_batches(held)


def _link(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Makes one of the components of each pair (a, b); root holds the least row of each row's component."""
    while True:
        low, high = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
        if (low == high).all():
            return
        np.minimum.at(root, high, low)
        while (root[root] != root).any():
            root[:] = root[root]


def _roots(rows: pa.RecordBatch, gap: int) -> np.ndarray:
    """The first row of each row's component, for whole pages; a box with a null coordinate, or NaN, is near none.

    A page's boxes are taken by their tops: those near one, and not above it, start no more than gap below its end.
    """
    named = [rows.column(c) for c in "xywh"]
    known = ~np.logical_or.reduce([v.is_null(nan_is_null=True).to_numpy(zero_copy_only=False) for v in named])
    x0, y0, w, h = (v.fill_null(0).to_numpy(zero_copy_only=False) for v in named)
    page = np.cumsum(_turns(rows.column("page")))
    root = np.arange(len(page))
    at = np.flatnonzero(known)
    at = at[np.lexsort((y0[at], page[at]))]
    n, x0, y0, x1, y1 = len(at), x0[at], y0[at], (x0 + w)[at], (y0 + h)[at]
    first = np.arange(n) + 1
    low, high = first, np.searchsorted(page[at], page[at], side="right")
    while (low < high).any():
        middle = (low + high) // 2
        near = (low < high) & (y0[np.minimum(middle, n - 1)] - y1 <= gap)
        low, high = np.where(near, middle + 1, low), np.where(near, high, np.minimum(middle, high))
    upto = np.cumsum(low - first)
    top = 0
    while top < n:
        end = max(top + 1, int(np.searchsorted(upto, (upto[top - 1] if top else 0) + PAIRS, side="right")))
        each = (low - first)[top:end]
        i = np.repeat(np.arange(top, end), each)
        j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(each) - each, each)
        near = (x0[j] - x1[i] <= gap) & (x0[i] - x1[j] <= gap) & (y0[i] - y1[j] <= gap)
        _link(root, at[i[near]], at[j[near]])
        top = end
    return root


def components(boxes: DataFrame, gap: int) -> DataFrame:
    """(page, id, component): boxes of a page no more than gap apart, in either direction, are one; named by least id.

    Pages come in sorted tasks, and all of a batch are labelled together; a task holds one page and one batch.
    """

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _whole_pages(batches):
            page, own = (rows.column(c).cast(pa.int64()) for c in ("page", "id"))
            yield pa.RecordBatch.from_arrays([page, own, own.take(pa.array(_roots(rows, gap)))], ["page", "id", "component"])

    by_page = boxes.select("page", "id", "x", "y", "w", "h").repartition("page").sortWithinPartitions("page", F.col("id").asc_nulls_last())
    return by_page.mapInArrow(label, "page long, id long, component long")


def columns_and_runs(boxes: DataFrame, page_w: int, gap: int, reach: int, brace: int) -> DataFrame:
    """boxes with column ('margin' or 'body') and, for body boxes, run: where a page's text breaks into acts.

    A margin box opens an act at its top, a tall one again at its middle. A run breaks where a box starts
    more than gap below all before it, or past another opening (reach pixels early).
    """
    sided = boxes.withColumn("column", F.when(G.is_margin(F.col("x"), F.col("w"), page_w), "margin").otherwise("body"))
    opens = F.array_compact(F.array(F.col("y"), F.when(F.col("h") >= brace, F.col("y") + F.call_function("div", F.col("h"), F.lit(2)))))
    starts = sided.filter("column = 'margin'").select("page", F.explode(opens).alias("at")).groupBy("page").agg(F.collect_set("at").alias("opens"))
    body = sided.filter("column = 'body'").join(starts, "page", "left")
    index = F.size(F.filter(F.coalesce("opens", F.array().cast("array<bigint>")), lambda a: a <= F.col("y") + reach))
    body = body.withColumn("opening", index).drop("opens")
    within = Window.partitionBy("page", "opening").orderBy("y", "x", "id")
    reached = F.max(F.col("y") + F.col("h")).over(within.rowsBetween(Window.unboundedPreceding, -1))
    body = body.withColumn("new", F.coalesce(F.col("y") - reached > gap, F.lit(True)).cast("int"))
    body = body.withColumn("run", F.sum("new").over(Window.partitionBy("page").orderBy("opening", "y", "x", "id").rowsBetween(Window.unboundedPreceding, 0)))
    return sided.filter("column = 'margin'").withColumn("run", F.lit(None).cast("long")).unionByName(body.drop("opening", "new"))


def grouped_acts(boxes: DataFrame, page_w: int, gap: int, reach: int, brace: int) -> DataFrame:
    """(page, act, x, y, w, h, body, anchors, rationale): a page's acts, numbered by place.

    A run takes the margin boxes within reach of it; one that several runs take links them. A margin box
    that no run takes is an act of its own.
    """
    sided = columns_and_runs(boxes, page_w, gap, reach, brace)
    runs = union_bounds(sided.filter("column = 'body'"), ["page", "run"])
    sizes = sided.filter("column = 'body'").groupBy("page", "run").agg(F.count("*").alias("body"))
    anchors = sided.filter("column = 'margin'").select("page", "id", F.col("x").alias("ax"), F.col("y").alias("ay"), F.col("w").alias("aw"), F.col("h").alias("ah"))
    met = runs.join(anchors, "page").filter((F.col("ay") <= F.col("y") + F.col("h") + reach) & (F.col("y") <= F.col("ay") + F.col("ah") + reach))
    shared = met.groupBy("page", "id").agg(F.count("*").alias("runs"))
    taken = met.join(shared, ["page", "id"])
    per_run = taken.groupBy("page", "run").agg(
        F.count("*").alias("anchors"), F.max("runs").alias("most"), F.min("ax").alias("x0"), F.min("ay").alias("y0"), F.max(F.col("ax") + F.col("aw")).alias("x1"), F.max(F.col("ay") + F.col("ah")).alias("y1")
    )
    acts = runs.join(sizes, ["page", "run"]).join(per_run, ["page", "run"], "left")
    x, y = F.least("x", F.coalesce("x0", "x")), F.least("y", F.coalesce("y0", "y"))
    rationale = F.when(F.col("anchors").isNull(), "leading fragment").when(F.col("most") > 1, "brace-linked").otherwise("single anchor")
    found = acts.select(
        "page", x.alias("x"), y.alias("y"),
        (F.greatest(F.col("x") + F.col("w"), F.coalesce("x1", F.col("x") + F.col("w"))) - x).alias("w"),
        (F.greatest(F.col("y") + F.col("h"), F.coalesce("y1", F.col("y") + F.col("h"))) - y).alias("h"),
        "body", F.coalesce("anchors", F.lit(0).cast("long")).alias("anchors"), rationale.alias("rationale"), F.col("run").alias("tie"),
    )
    alone = anchors.join(met.select("page", "id").distinct(), ["page", "id"], "left_anti")
    notes = alone.select("page", F.col("ax").alias("x"), F.col("ay").alias("y"), F.col("aw").alias("w"), F.col("ah").alias("h"), F.lit(0).cast("long").alias("body"), F.lit(1).cast("long").alias("anchors"), F.lit("isolated note").alias("rationale"), (F.col("id") + 1_000_000).alias("tie"))
    place = F.row_number().over(Window.partitionBy("page").orderBy("y", "x", "tie"))
    return found.unionByName(notes).withColumn("act", place).drop("tie")


def ink_runs(pixels: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(page, y, x0, x1) of the runs of ink in rows (page, y, row) of packed 0/1 bytes: for mapInPandas."""
    for rows in pixels:
        out = []
        for page, y, row in zip(rows["page"], rows["y"], rows["row"], strict=True):
            edge = np.flatnonzero(np.diff(np.concatenate(([0], np.frombuffer(row, np.uint8), [0])).astype(np.int8)))
            out += [(page, y, a, b) for a, b in zip(edge[::2], edge[1::2], strict=True)]
        yield pd.DataFrame(out, columns=["page", "y", "x0", "x1"])
