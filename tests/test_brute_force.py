"""Queries that SQL can't express, or is too slow for, against plain Python on small or whole small tables."""

from __future__ import annotations

import hashlib
import re
import unicodedata

import pytest

from lectern import plans
from lectern.functions import text as T
from lectern.sources.tables import rectangles, table
from tests.conftest import SMALL

QUERIES = plans.queries()


@pytest.fixture(scope="module")
def boxes(spark):
    pages: dict[int, list] = {}
    for r in rectangles(spark, SMALL).collect():
        pages.setdefault(r["page"], []).append((r["id"], r["x"], r["y"], r["w"], r["h"]))
    return pages


def rows(spark, name):
    return sorted(map(tuple, QUERIES[name](spark, SMALL).collect()), key=repr)


def texts(spark):
    return {r["doc_id"]: r["text"] for r in table(spark, SMALL, "documents").collect()}


def test_ink_runs(spark):
    want = []
    for r in table(spark, SMALL, "lineitem").collect():
        ink = "".join("#" if c < "8" else "." for c in hashlib.md5(str(r["l_partkey"]).encode()).hexdigest())
        want += [(r["l_orderkey"], r["l_linenumber"], m.start(), m.end()) for m in re.finditer("#+", ink)]
    assert rows(spark, "w08_ink_runs") == sorted(want, key=repr)


def test_repeated_words_and_tails(spark):
    found = texts(spark)
    want = sorted((i, m[1]) for i, t in found.items() if (m := re.search(r"\b(\w+)\s+\1\b", t, re.IGNORECASE)))
    assert sorted(rows(spark, "f06_repeated_word")) == want

    def tail(text):
        text = re.sub(r"\s+", " ", text).strip()
        for width in range(24, 257):
            n = 1
            while len(text) >= (n + 1) * width and text[len(text) - (n + 1) * width : len(text) - n * width] == text[-width:]:
                n += 1
            if n >= 3:
                return width, n
        return None

    odd = ["ab" * 90, "x" * 100, "head " + "abcdefghijklmnopqrstuvwxyz " * 3, "a" * 71, "a" * 72, "q" + "abcdefghijklmnopqrstuvwx" * 4, "", "  "]
    assert [T.repeated_tail(t) for t in [*odd, *found.values()]] == [tail(t) for t in [*odd, *found.values()]]
    assert rows(spark, "f21_repeated_tail") == sorted(((i, *tail(t)) for i, t in found.items() if tail(t)), key=repr)


def test_search_keys_and_lineage(spark):
    letters, gone = {"ȣ": "8", "Ȣ": "8", "œ": "oe", "Œ": "oe", "æ": "ae", "Æ": "ae"}, "'’ʼ`"

    def key(text):
        out = []
        for c in unicodedata.normalize("NFD", text):
            if unicodedata.category(c) != "Mn":
                out += [x if x.isalnum() else " " for x in letters.get(c, c).casefold() if x not in gone]
        return " ".join("".join(out).split())

    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    found = texts(spark)
    assert rows(spark, "f05_search_key") == sorted(((i, sha(key(t))) for i, t in found.items()), key=repr)
    forms = lambda t: ",".join(dict.fromkeys([sha(t), sha(" ".join(unicodedata.normalize("NFC", t).split())), sha(T.graphemic(t)), sha(key(t))]))
    assert rows(spark, "k48_text_lineage") == sorted(((i, forms(t)) for i, t in found.items()), key=repr)


def test_components(spark, boxes):
    want = []
    for page, own in boxes.items():
        root = {b[0]: b[0] for b in own}
        near = lambda a, b: max(a[1] - b[1] - b[3], b[1] - a[1] - a[3], a[2] - b[2] - b[4], b[2] - a[2] - a[4]) <= 3
        for _ in own:
            for a in own:
                for b in own:
                    if near(a, b):
                        root[a[0]] = root[b[0]] = min(root[a[0]], root[b[0]])
        want += [(page, i, r) for i, r in root.items()]
    assert rows(spark, "g13_components") == sorted(want, key=repr)


def plain_acts(own, page_w, gap, reach, brace):
    margin = [b for b in own if (2 * b[1] + b[3]) * 100 < 2 * page_w * 15]
    body = sorted((b for b in own if b not in margin), key=lambda b: (b[2], b[1], b[0]))
    opens = sorted({b[2] for b in margin} | {b[2] + b[4] // 2 for b in margin if b[4] >= brace})
    index = lambda b: sum(a <= b[2] + reach for a in opens)
    runs: list[list] = []
    last, bottom = None, None
    for b in sorted(body, key=lambda b: (index(b), b[2], b[1], b[0])):
        if index(b) != last or b[2] - bottom > gap:
            runs.append([])
            bottom = None if index(b) != last else bottom
        last = index(b)
        bottom = b[2] + b[4] if bottom is None else max(bottom, b[2] + b[4])
        runs[-1].append(b)
    span = lambda bs: (min(b[1] for b in bs), min(b[2] for b in bs), max(b[1] + b[3] for b in bs), max(b[2] + b[4] for b in bs))
    meets = [[m for m in margin if m[2] <= span(r)[3] + reach and span(r)[1] <= m[2] + m[4] + reach] for r in runs]
    acts = []
    for k, (run, taken) in enumerate(zip(runs, meets, strict=True)):
        linked = any(sum(m in t for t in meets) > 1 for m in taken)
        acts.append((span(run + taken), len(run), len(taken), "leading fragment" if not taken else "brace-linked" if linked else "single anchor", k + 1))
    for m in margin:
        if not any(m in t for t in meets):
            acts.append((span([m]), 0, 1, "isolated note", m[0] + 1_000_000))
    acts.sort(key=lambda a: (a[0][1], a[0][0], a[4]))
    return [(x0, y0, x1 - x0, y1 - y0, body_, anchors, why, k) for k, ((x0, y0, x1, y1), body_, anchors, why, _) in enumerate(acts, 1)]


def test_grouped_acts_and_continuations(spark, boxes):
    acts = {page: plain_acts(own, 260, 6, 2, 15) for page, own in boxes.items()}
    names = ("page", "x", "y", "w", "h", "body", "anchors", "rationale", "act")
    got = sorted(tuple(r[n] for n in names) for r in QUERIES["g16_grouped_acts"](spark, SMALL).collect())
    assert got == sorted((page, *a) for page, own in acts.items() for a in own)
    want = set()
    for page, own in acts.items():
        if page + 1 in acts:
            a = max(own, key=lambda a: (a[1] + a[3], -a[1], -a[0]))
            b = min(acts[page + 1], key=lambda b: (b[1], b[0], b[7]))
            edge = max(x[1] + x[3] for x in own) - a[1] - a[3] <= 4 and b[1] <= 4 and b[5] == 0
            if edge and a[0] <= b[0] + b[2] and b[0] <= a[0] + a[2]:
                want.add((page, page + 1, a[7], b[7]))
    assert want and {tuple(r[c] for c in ("page", "next_page", "trailing", "leading")) for r in QUERIES["j13_page_continuation"](spark, SMALL).collect()} == want


def test_residual_ink(spark, boxes):
    want = []
    for page, own in boxes.items():
        covered = {(x, y) for b in own if b[0] <= 2 for x in range(b[1], b[1] + b[3]) for y in range(b[2], b[2] + b[4])}
        ink = {(50 * k + i, 60 * k + j) for k in range(4) for i in range(40) for j in range(30)}
        outside = len(ink - covered)
        want.append((page, len(ink), outside, outside >= 2000 or (outside >= 24 and outside * 100 >= 2 * len(ink))))
    assert rows(spark, "g14_residual_ink") == sorted(want, key=repr)
