"""Rectangles (x, y, w, h) in whole pixels and fractions in basis points, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BP = 10_000


def div(a: Column, b: Column | int) -> Column:
    """Floor division for a positive divisor, also of a negative number; exact in whole numbers."""
    b = F.lit(b) if isinstance(b, int) else b
    return F.call_function("div", a - F.pmod(a, b), b)


def ceil_div(a: Column, b: Column | int) -> Column:
    return -div(-a, b)


def box(x: Column, y: Column, w: Column, h: Column) -> Column:
    return F.struct(x.alias("x"), y.alias("y"), w.alias("w"), h.alias("h"))


def valid(b: Column, page_w: Column | int, page_h: Column | int) -> Column:
    return (b["x"] >= 0) & (b["y"] >= 0) & (b["w"] > 0) & (b["h"] > 0) & (b["x"] + b["w"] <= page_w) & (b["y"] + b["h"] <= page_h)


def pad_amount(size: Column, bp: int) -> Column:
    """A fraction of a size, rounded half up."""
    return div(size * bp + BP // 2, BP)


def padded(b: Column, page_w: int, page_h: int, top: int, right: int, bottom: int, left: int) -> Column:
    """b grown by fractions of its own size and clamped to the page, with the pixels applied at each edge."""
    x0 = F.greatest(F.lit(0), b["x"] - pad_amount(b["w"], left))
    y0 = F.greatest(F.lit(0), b["y"] - pad_amount(b["h"], top))
    x1 = F.least(F.lit(page_w), b["x"] + b["w"] + pad_amount(b["w"], right))
    y1 = F.least(F.lit(page_h), b["y"] + b["h"] + pad_amount(b["h"], bottom))
    return F.struct(
        box(x0, y0, x1 - x0, y1 - y0).alias("bounds"),
        (b["y"] - y0).alias("top"),
        (x1 - b["x"] - b["w"]).alias("right"),
        (y1 - b["y"] - b["h"]).alias("bottom"),
        (b["x"] - x0).alias("left"),
    )


def _scaled(b: Column, fx: tuple, fy: tuple, w: Column | int, h: Column | int) -> Column:
    x0, y0 = div(b["x"] * fx[0], fx[1]), div(b["y"] * fy[0], fy[1])
    x1 = F.least(F.lit(w) if isinstance(w, int) else w, ceil_div((b["x"] + b["w"]) * fx[0], fx[1]))
    y1 = F.least(F.lit(h) if isinstance(h, int) else h, ceil_div((b["y"] + b["h"]) * fy[0], fy[1]))
    return box(x0, y0, F.greatest(F.lit(1), x1 - x0), F.greatest(F.lit(1), y1 - y0))


def to_model(b: Column, page_w: int, page_h: int, model_w: int, model_h: int) -> Column:
    """b in a model's own pixels: near edges round down, far edges up."""
    return _scaled(b, (model_w, page_w), (model_h, page_h), model_w, model_h)


def from_model(b: Column, page_w: int, page_h: int, model_w: int, model_h: int) -> Column:
    """The inverse of to_model; a round trip never shrinks a box."""
    return _scaled(b, (page_w, model_w), (page_h, model_h), page_w, page_h)


def anisotropy_bp(x_num: Column, x_den: Column, y_num: Column, y_den: Column) -> Column:
    """How far two axis scales differ, in basis points of the larger, by cross-multiplication."""
    a, b = x_num * y_den, y_num * x_den
    return div(F.abs(a - b) * BP, F.greatest(a, b))


def from_thousandths(v: Column, size: Column | int) -> Column:
    """A 0 to 1000 coordinate in pixels."""
    return div(v * size, 1000)


def overlap_area(a: Column, b: Column) -> Column:
    w = F.least(a["x"] + a["w"], b["x"] + b["w"]) - F.greatest(a["x"], b["x"])
    h = F.least(a["y"] + a["h"], b["y"] + b["h"]) - F.greatest(a["y"], b["y"])
    return F.greatest(F.lit(0), w) * F.greatest(F.lit(0), h)


def contains(a: Column, b: Column) -> Column:
    return (a["x"] <= b["x"]) & (a["y"] <= b["y"]) & (a["x"] + a["w"] >= b["x"] + b["w"]) & (a["y"] + a["h"] >= b["y"] + b["h"])


def overlaps(a: Column, b: Column) -> Column:
    return (a["x"] < b["x"] + b["w"]) & (b["x"] < a["x"] + a["w"]) & (a["y"] < b["y"] + b["h"]) & (b["y"] < a["y"] + a["h"])


def relation(a: Column, b: Column) -> Column:
    """'coincident-aabb', 'contains', 'contained', 'ambiguous-overlap' or null, in this precedence."""
    return F.when(a == b, "coincident-aabb").when(contains(a, b), "contains").when(contains(b, a), "contained").when(overlaps(a, b), "ambiguous-overlap")


def cut_out(piece: Column, claim: Column) -> Column:
    """What of a box a claim leaves: up to four boxes, above, below, left and right of it."""
    x0, y0, x1, y1 = piece["x"], piece["y"], piece["x"] + piece["w"], piece["y"] + piece["h"]
    cx0, cy0 = F.greatest(x0, claim["x"]), F.greatest(y0, claim["y"])
    cx1, cy1 = F.least(x1, claim["x"] + claim["w"]), F.least(y1, claim["y"] + claim["h"])
    pieces = F.array(box(x0, y0, x1 - x0, cy0 - y0), box(x0, cy1, x1 - x0, y1 - cy1), box(x0, cy0, cx0 - x0, cy1 - cy0), box(cx1, cy0, x1 - cx1, cy1 - cy0))
    return F.when((cx0 < cx1) & (cy0 < cy1), F.filter(pieces, lambda p: (p["w"] > 0) & (p["h"] > 0))).otherwise(F.array(piece))


def remaining(region: Column, claims: Column) -> Column:
    """The boxes of a region that an array of claims leaves."""
    return F.aggregate(claims, F.array(region), lambda left, claim: F.flatten(F.transform(left, lambda p: cut_out(p, claim))))


def area(boxes: Column) -> Column:
    return F.aggregate(boxes, F.lit(0).cast("long"), lambda n, b: n + b["w"] * b["h"])


def is_margin(x: Column, w: Column, page_w: int, percent: int = 15) -> Column:
    """Whether a box's middle lies in the margin, a band of percent of the page's width."""
    return (2 * x + w) * 100 < 2 * page_w * percent


def bands(page_w: Column, page_h: Column, n: int = 4, overlap: int = 8) -> Column:
    """n bands that cover a page, neighbours sharing 2 * overlap rows: for a page on which nothing was found."""
    k = F.least(F.lit(n).cast("long"), page_h)

    def band(i: Column) -> Column:
        top, bottom = div(page_h * i, k), div(page_h * (i + 1), k)
        y0, y1 = F.greatest(F.lit(0), top - overlap), F.least(page_h, bottom + overlap)
        return F.struct((i + 1).alias("band"), y0.alias("y"), (y1 - y0).alias("h"), page_w.alias("w"))

    return F.transform(F.sequence(F.lit(0).cast("long"), k - 1), band)


def grid_starts(size: Column, tile: int, overlap: int) -> Column:
    """Where tiles of a size begin so that neighbours share `overlap` and the last one ends at the edge."""
    step = tile - overlap
    n = F.when(size <= tile, F.lit(0)).otherwise(ceil_div(size - tile, step))
    return F.transform(F.sequence(F.lit(0).cast("long"), n.cast("long")), lambda i: F.least(i * step, F.greatest(size - tile, F.lit(0))))


def fitted(w: Column, h: Column, max_w: int, max_h: int, max_area: int) -> Column:
    """The largest (w, h) of the same aspect, in whole pixels of width, under three ceilings.

    Height is rounded half up and is 1 at least; widths are searched by halving.
    """
    height = lambda v: F.greatest(F.lit(1).cast("long"), div(2 * h * v + w, 2 * w))
    fits = lambda v: (v <= max_w) & (height(v) <= max_h) & (v * height(v) <= max_area)
    state = F.struct(F.lit(1).cast("long").alias("low"), F.least(w, F.lit(max_w).cast("long")).alias("high"))

    def halve(s: Column, _: Column) -> Column:
        mid = F.call_function("div", s["low"] + s["high"] + 1, F.lit(2))
        return F.struct(F.when(fits(mid), mid).otherwise(s["low"]).alias("low"), F.when(fits(mid), s["high"]).otherwise(F.greatest(mid - 1, s["low"])).alias("high"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(40)), state, halve, lambda s: F.struct(s["low"].alias("w"), height(s["low"]).alias("h")))
