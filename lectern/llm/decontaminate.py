"""Benchmark decontamination by exact search over item-sized windows, in DataFrame and SQL functions alone.

An item of m words is compared with windows of m words. Both are multisets of word shingles, of five
words or of all m where m < 5; their similarity is the weighted Jaccard sum(min) / sum(max) of the
shingles' counts. A window qualifies at 0.75 or more.

1. A qualifying window holds three quarters of the item's shingles, so of any quarter and one more of
   them (repeats counted) it holds one. The rarest in the benchmark are the item's anchors; a document
   is compared with an item only if it holds an anchor, once, at the first anchor that it holds.
2. Two windows d words apart have counts in common that differ by d at most. A window that lacks e
   common shingles to be the best is followed by the one e words on; none between can be better.
3. What is found on shingle hashes is computed once more on the words.

The benchmark is broadcast in parts of about PART_WORDS words (every item counts ITEM_WORDS more), one pass over the
documents each; the documents are never shuffled, only verified rows are.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.llm.shared import without

PERCENT = 75
SHINGLE = 5
#: The broadcast of a part: words, and as many more for each item as its row and its first anchor weigh.
PART_WORDS, ITEM_WORDS = 500_000, 16

_WORDS = r"""
  if(trim(BOTH ' \t\n\u000b\u000c\r' FROM coalesce({text}, '')) = '', array(),
     split(lower(trim(BOTH ' \t\n\u000b\u000c\r' FROM {text})), '[\\x20\\x09-\\x0D]+'))
"""


def _hashed(size: int) -> str:
    """One row (w: words, h: shingle hashes) from a text; lambda variables bind each array once."""
    shingle = ", ".join(f"get(v, i + {k})" for k in range(size))
    return f"""
      inline(transform(array({_WORDS.format(text="text")}), w -> struct(w as w,
        transform(array(transform(w, x -> xxhash64(x))), v -> if(size(v) >= {size},
          transform(sequence(0, size(v) - {size}), i -> xxhash64({shingle})), array()))[0] as h)))"""


_SHINGLES = "if(size({w}) >= {k}, transform(sequence(0, size({w}) - {k}), i -> array_join(slice({w}, i + 1, {k}), ' ')), array())"


def _let(name: str, value: str, body: str) -> str:
    return f"transform(array({value}), {name} -> {body})[0]"


def _prepared(b: str) -> str:
    """What _best asks of an item's shingles b: them, their number, and how their repeats are counted.

    levels[t] holds the shingles that occur more than t times. Where repeats go deeper than there are repeated
    shingles, rep holds those with their counts, and levels the first alone.
    """
    rep = "array_distinct(filter(v, (x, i) -> get(v, i - 1) = x))"
    most = "aggregate(v, named_struct('x', v[0], 'n', 0, 'most', 0), (s, x) -> if(s.x = x, named_struct('x', x, 'n', s.n + 1, 'most', greatest(s.most, s.n + 1)), named_struct('x', x, 'n', 1, 'most', greatest(s.most, 1))), s -> s.most)"
    levels = "transform(sequence(0, if(most <= size(rep), most - 1, 0)), t -> array_distinct(filter(v, (x, i) -> get(v, i - t) = x)))"
    counts = "if(most <= size(rep), array(), transform(rep, x -> named_struct('x', x, 'c', size(filter(v, y -> y = x)))))"
    body = f"named_struct('n', size(v), 'levels', {levels}, 'rep', {counts})"
    return _let("v", f"sort_array({b})", _let("rep", rep, _let("most", most, body)))


def _best(h: str, item: str, percent: int) -> str:
    """(common, at, size): the first window of shingles h that has most in common with an item, and its size."""
    window = f"slice({h}, st + 1, {item}.n)"
    deeper = f"""aggregate(sequence(1, size({item}.levels) - 1), 0, (n, t) -> n + size(array_intersect(filter(v, (x, i) -> get(v, i - t) = x), {item}.levels[t])))"""
    repeats = f"""if(size({item}.levels) > 1, {_let("v", "sort_array(w)", deeper)}, 0) + aggregate({item}.rep, 0, (n, r) -> n + greatest(0, least(r.c, size(filter(w, y -> y = r.x))) - 1))"""
    common = _let("w", window, f"size(array_intersect(w, {item}.levels[0])) + {repeats}")
    least = f"cast(ceil({percent} * (least(size({h}), {item}.n) + {item}.n) / {100 + percent}) as int)"
    step = "named_struct('next', st + greatest(1, greatest({least}, s.best + 1, l + 1) - l), 'best', greatest(s.best, l), 'at', if(l > s.best, st, s.at))"
    state = "named_struct('next', 0, 'best', 0, 'at', 0)"
    walk = f"""aggregate(sequence(0, greatest(size({h}) - {item}.n, 0)), {state}, (s, st) -> if(st < s.next, s, {_let("l", common, step.format(least="least"))}),
      s -> named_struct('common', s.best, 'at', s.at, 'both', least(size({h}), {item}.n) + {item}.n))"""
    return _let("least", least, walk)


def contamination(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", percent: int = PERCENT) -> DataFrame:
    """(doc_id, item_id, similarity, start_word): for each document and item with a qualifying window the first of the best.

    Words are runs of other characters than space, tab, line feed, vertical tab, form feed and carriage
    return, in lower case. A null or empty text holds nothing and an item without words is found
    nowhere. Items of one text are all reported, items of a null item_id under null; rows repeated under one id are one document, of several
    texts under one id the best window counts; rows of a null id are judged as one document. A document
    shorter than an item is compared whole. Other columns are not looked at.
    """
    items = benchmark.select("item_id", F.expr(_WORDS.format(text="text")).alias("iw")).filter("size(iw) > 0").distinct()
    items = items.withColumn("m", F.size("iw")).withColumn("k", F.least(F.lit(SHINGLE), F.col("m")))
    sizes = items.groupBy("k").agg(F.sum(F.col("m") + ITEM_WORDS).alias("words")).collect()  # at most SHINGLE rows
    docs = docs.select(F.col(id_column).alias("doc_id"), "text")
    found = [
        _pass(docs, items.filter((F.col("k") == r["k"]) & (F.pmod(F.xxhash64("item_id", "iw"), F.lit(parts)) == p)), r["k"], percent)
        for r in sorted(sizes)
        for parts in [-(-r["words"] // PART_WORDS)]
        for p in range(parts)
    ]
    if not found:
        return docs.limit(0).join(benchmark.limit(0).select("item_id")).select("doc_id", "item_id", F.lit(0.0).alias("similarity"), F.lit(0).alias("start_word"))
    best = reduce(DataFrame.unionByName, found).groupBy("doc_id", "item_id").agg(F.max(F.struct("similarity", F.negative("start_word").alias("at"))).alias("b"))
    return best.select("doc_id", "item_id", F.col("b.similarity").alias("similarity"), F.negative(F.col("b.at")).alias("start_word"))


def _pass(docs: DataFrame, items: DataFrame, size: int, percent: int) -> DataFrame:
    shingle = ", ".join(f"get(v, i + {k})" for k in range(size))
    # items go by the digest of their words: an item_id may be null or stand for several texts
    items = items.withColumn("key", F.unhex(F.sha2(F.array_join("iw", " ").cast("binary"), 256)))
    hashed = items.dropDuplicates(["key"]).select("key", "iw", F.expr(_let("v", "transform(iw, x -> xxhash64(x))", f"transform(sequence(0, m - {size}), i -> xxhash64({shingle}))")).alias("ih"))
    held = hashed.select("key", F.explode("ih").alias("sh"))
    rare = held.join(held.groupBy("sh").agg(F.count("*").alias("rows")), "sh").groupBy("key").agg(F.sort_array(F.collect_list(F.struct("rows", "sh"))).alias("by"))
    few = f"(size(by) * {100 - percent}) div 100 + 1"
    known = rare.join(hashed, "key").select("key", "iw", F.expr(_prepared("ih")).alias("item"), F.expr(f"array_distinct(transform(slice(by, 1, cast({few} as int)), x -> x.sh))").alias("anchors"))
    anchors = known.select("key", F.expr("posexplode(anchors) as (j, sh)"))

    close = docs.select("doc_id", F.expr(_hashed(size))).select("doc_id", "w", "h", F.expr("explode(array_distinct(h)) as sh")).join(F.broadcast(anchors), "sh").drop("sh")
    close = close.join(F.broadcast(known), "key").filter("j = 0 or not arrays_overlap(slice(anchors, 1, j), h)")
    # generated, so that the optimizer neither computes f again in the filter nor joins that to the one above
    close = close.withColumn("f", F.explode(F.array(F.expr(_best("h", "item", percent))))).filter(f"f.common * 100 >= {percent} * (f.both - f.common)")
    close = close.select("doc_id", "key", F.expr(_SHINGLES.format(w="w", k=size)).alias("a"), F.expr(_prepared(_SHINGLES.format(w="iw", k=size))).alias("b"))
    close = close.withColumn("f", F.explode(F.array(F.expr(_best("a", "b", percent))))).filter(f"f.common * 100 >= {percent} * (f.both - f.common)")
    close = close.join(F.broadcast(items.select("key", "item_id")), "key")
    return close.select("doc_id", "item_id", F.expr("f.common / (f.both - f.common)").alias("similarity"), F.col("f.at").alias("start_word"))


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs whose text holds no item. Each row is judged by its own text, whatever its doc_id.

    Null and empty texts hold nothing and stay; without items all rows stay.
    """
    keyed = docs.withColumn("__text", F.unhex(F.sha2(F.col("text").cast("binary"), 256)))
    return without(keyed, contamination(keyed, benchmark, "__text").select("doc_id"), "__text").drop("__text")
