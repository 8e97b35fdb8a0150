"""Established text shown with its doubts and gaps, read back from what is shown; and texts reconciled span by span."""

from __future__ import annotations

import re
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType

#: The marks of a doubtful passage and of a gap, and the sign that keeps a literal one.
OPEN, CLOSE, GAP_OPEN, GAP_CLOSE, ESCAPE = "⟦", "⟧", "⟨", "⟩", "\\"
_MARK = re.compile(r"\\(.)|⟨[^⟩]*⟩|⟦|⟧", re.DOTALL)


def _escaped(text: str) -> str:
    return re.sub(r"[⟦⟧⟨⟩\\]", lambda m: ESCAPE + m[0], text)


def render(text: str, doubts: list[tuple[int, int]], gaps: list[tuple[int, str]]) -> str:
    """text with doubtful spans in marks and a note at each gap; a gap at a span's start stands before it.

    Refused are spans that aren't within the text or overlap, and gaps past its end or inside a span: a place can't be
    both doubted and gone.
    """
    spans = sorted(doubts)
    if any(not 0 <= a < b <= len(text) for a, b in spans):
        raise ValueError("span outside the text")
    if any(after[0] < before[1] for before, after in zip(spans, spans[1:], strict=False)):
        raise ValueError("spans overlap")
    if any(not 0 <= p <= len(text) for p, _ in gaps):
        raise ValueError("gap past the end")
    if any(a < p < b for a, b in spans for p, _ in gaps):
        raise ValueError("gap inside a span")
    events = sorted([(p, 0, GAP_OPEN + kind + GAP_CLOSE) for p, kind in gaps] + [(a, 1, OPEN) for a, _ in spans] + [(b, -1, CLOSE) for _, b in spans])
    out, at = [], 0
    for place, _, mark in events:
        out += [_escaped(text[at:place]), mark]
        at = place
    return "".join(out) + _escaped(text[at:])


def strip(shown: str) -> str:
    """The text that render was given."""
    return _MARK.sub(lambda m: m[1] or "", shown)


def reconcile_drafts(first: str, second: str, chosen: dict[tuple[int, int], str]) -> str:
    """first with each span where the drafts disagree written as chosen; all of them must be chosen, no others."""
    ops = SequenceMatcher(None, first, second, autojunk=False).get_opcodes()
    spans = [(a, b) for tag, a, b, _, _ in ops if tag != "equal"]
    if len(set(spans)) < len(spans) or set(chosen) != set(spans):
        raise ValueError("the choices aren't those of the drafts' disagreements")
    return "".join(first[a:b] if tag == "equal" else chosen[a, b] for tag, a, b, _, _ in ops)


def attribute_change(before: str, after: str, flags: list[tuple[int, int, str]]) -> str | None:
    """The class of the narrowest flag that contains all of a change, ties by start and class; None without a change."""
    if before == after:
        return None
    start = next((k for k, (a, b) in enumerate(zip(before, after, strict=False)) if a != b), min(len(before), len(after)))
    tail = next((k for k, (a, b) in enumerate(zip(reversed(before[start:]), reversed(after[start:]), strict=False)) if a != b), min(len(before), len(after)) - start)
    end = len(before) - tail
    around = [(b - a, a, kind) for a, b, kind in flags if a <= start and end <= b]
    return min(around)[2] if around else "outside every flag"


def shown_and_read(text: str, doubts: list[tuple[int, int]], gaps: list[tuple[int, str]]) -> str:
    """'same' where what is shown reads back as the text, 'lost' where it doesn't, or why it can't be shown."""
    try:
        return "same" if strip(render(text, doubts, gaps)) == text else "lost"
    except ValueError as e:
        return str(e)


@pandas_udf(StringType())
def display_round_trip(text: pd.Series, doubts: pd.Series, gaps: pd.Series) -> pd.Series:
    """shown_and_read of columns: doubts an array of (start, end), gaps of (position, kind)."""
    rows = zip(text, doubts, gaps, strict=True)
    return pd.Series([None if t is None else shown_and_read(t, [(x["start"], x["end"]) for x in a], [(x["position"], x["kind"]) for x in g]) for t, a, g in rows], dtype=object)


@pandas_udf(StringType())
def change_class(before: pd.Series, after: pd.Series, flags: pd.Series) -> pd.Series:
    """attribute_change of columns: flags an array of (start, end, class)."""
    rows = zip(before, after, flags, strict=True)
    return pd.Series([attribute_change(a, b, [(x["start"], x["end"], x["class"]) for x in f]) for a, b, f in rows], dtype=object)


@pandas_udf(StringType())
def adjudicated(first: pd.Series, second: pd.Series, choices: pd.Series) -> pd.Series:
    """reconcile_drafts of columns: choices an array of (start, end, text); null where they aren't those of the disagreements."""

    def one(a: str, b: str, chosen: list) -> str | None:
        try:
            return reconcile_drafts(a, b, {(x["start"], x["end"]): x["text"] for x in chosen})
        except ValueError:
            return None

    return pd.Series([one(*row) for row in zip(first, second, choices, strict=True)], dtype=object)
