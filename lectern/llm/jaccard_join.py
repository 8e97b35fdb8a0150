"""N-gram Jaccard join by T-occurrence search over inverted lists of word shingles (DivideSkip).

A document is the set of its distinct five-word shingles; two documents link when their sets satisfy
100 * intersection >= 75 * union. A query of n shingles needs T = ceil(0.75 n) of them in a partner, so
with its T - 1 longest lists put aside every partner still occurs on one of the n - T + 1 short ones.
Only these short lists (each document's rarest shingles) are built over the whole table, as sorted runs that
tasks merge by sorting them together in numpy, which visits the elements in a heap's order.

* Which shingles are rare is told by one count sketch over all documents. It only orders shingles, the
  same way everywhere, so that an estimate can't lose a link.
* Documents of one shingle set form one class; a class is compared once, whatever its size.
* Lists of up to SHORT_LIST documents are merged into pairs with the number of lists that they share.
  Sets of a and b elements that share T elements share at least T - max(T_a, T_b) + 1 of their short
  lists, T_a and T_b being the least overlaps that a and b ask of any partner; pairs that reach this
  are verified on whole texts.
* A longer list is a group under a label, the least document on it; lists of one label are one group. A group is searched
  in windows of neighbouring set sizes, as sets of which one is over 4/3 of the other can't link, and windows of
  many documents in pairs of parts. A task searches some windows or one pair of parts by DivideSkip in memory, and
  returns rows in proportion to its documents, not pairs. A pair that shares several labels counts under
  the least, and a window whose documents all have the same lesser label first isn't searched.

Every step reads the shared folder or the input again, so a lost executor repeats only its tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.llm.batches import slices, summed
from lectern.llm.shared import Scratch, connected_components, durable, scratch
from lectern.llm.shingles import prefix_length, required_overlap, shingle_sets

PERCENT = 75
SKETCH_BITS = 20
SKETCH_SLICES = 64
SHORT_LIST = 32
#: A part of a window holds up to so many documents and shingles in expectation; windows that aren't split share tasks
#: of TASK_DOCS documents.
PART_DOCS, PART_SHINGLES, TASK_DOCS = 1024, 1_500_000, 512
#: Ratio of the set sizes of a band, a little over 4/3: sets that can link are in one band or in neighbouring ones.
BAND = 1.34
#: DivideSkip puts aside T / (SKIP * log2 of its longest list + 1) lists, and merges them too where PROBE steps for
#: each probe would be more than the lists' elements.
SKIP, PROBE = 0.05, 12
#: More buckets than a document has short lists, as a rule, so that what a bucket tells of a document, a label or a
#: pair for several lists at once, doesn't depend on the table's size.
POSTINGS_A_BUCKET, FEWEST_BUCKETS = 250_000, 256
MOST_TASKS = 100_000  # further buckets are merged one after the other by the same tasks
BLOOM_SIZE = 8_388_593  # a prime; bits of the filter that keeps texts nobody asks for out of a shuffle


def _texts(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    return shingle_sets(batch.column("text").to_pylist())


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    width = 1 << SKETCH_BITS
    counts, shingles, held, size = np.zeros(width, np.int64), 0, [], 0
    for batch in slices(batches):
        for h in _texts(batch):
            shingles += len(h)
            held.append((h & np.uint64(width - 1)).astype(np.int64))
            size += len(h)
            if size >= 1 << 20:
                counts += np.bincount(np.concatenate(held), minlength=width)
                held, size = [], 0
    if held:
        counts += np.bincount(np.concatenate(held), minlength=width)
    if shingles:
        kind = np.uint16 if counts.max() < 1 << 16 else np.int64
        parts = np.split(counts.astype(kind), SKETCH_SLICES)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(range(SKETCH_SLICES), pa.int32()),
                pa.array([kind().itemsize] * SKETCH_SLICES, pa.int32()),
                pa.array([p.tobytes() for p in parts], pa.binary()),
                pa.array([shingles] + [0] * (SKETCH_SLICES - 1), pa.int64()),
                pa.array([TaskContext.get().partitionId()] * SKETCH_SLICES, pa.int32()),
            ],
            ["part", "width", "counts", "shingles", "lot"],
        )


def _add_sketches(table: pa.Table) -> pa.Table:
    total = 0
    for w, raw in zip(table.column("width").to_pylist(), table.column("counts").to_pylist(), strict=True):
        total = total + np.frombuffer(raw, np.uint16 if w == 2 else np.int64).astype(np.int64)
    return pa.table(
        {
            "part": table.column("part").slice(0, 1),
            "width": pa.array([8], pa.int32()),
            "counts": pa.array([total.tobytes()], pa.binary()),
            "shingles": pa.array([sum(table.column("shingles").to_pylist())], pa.int64()),
            "lot": table.column("lot").slice(0, 1),
        }
    )


def _shingle_ranks(docs: DataFrame) -> tuple[np.ndarray, int]:
    """For each sketch cell a 16-bit rank that grows with its count over all documents; the count of all."""
    parts = docs.select("text").mapInArrow(_sketch, "part int, width int, counts binary, shingles long, lot int")
    rows = summed(parts, ["part"], _add_sketches).collect()  # SKETCH_SLICES rows of 128 KB, whatever the input
    counts = np.zeros(1 << SKETCH_BITS, np.int64)
    for r in rows:
        part = np.frombuffer(r["counts"], np.int64)
        counts[r["part"] * len(part) : (r["part"] + 1) * len(part)] = part
    return np.minimum(np.log2(1.0 + counts) * 1024, 65535).astype(np.uint16), sum(r["shingles"] for r in rows)


def _rarest(h: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """The shingles whose lists the search merges: by rank, equal ranks by hash."""
    rank = ranks[(h & np.uint64(len(ranks) - 1)).astype(np.int64)]
    return h[np.argsort(rank, kind="stable")[: prefix_length(len(h), PERCENT)]]


_INDEX = pa.schema(
    [
        ("kind", pa.string()),
        ("doc_id", pa.int64()),
        ("n", pa.int64()),
        ("set_key", pa.binary()),
        ("bucket", pa.int32()),
        ("ids", pa.binary()),
        ("sizes", pa.binary()),
        ("lengths", pa.binary()),
        ("hashes", pa.binary()),
    ]
)
_INDEX_DDL = "kind string, doc_id long, n long, set_key binary, bucket int, ids binary, sizes binary, lengths binary, hashes binary"


def _indexer(ranks, buckets: int):
    """Rows of kind 'doc' (one for each row read) and 'postings' (rarest shingles packed by bucket)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        rank = ranks.value
        for batch in slices(batches):
            ids, ns, keys, post = batch.column("doc_id").to_pylist(), [], [], []
            for i, h in zip(ids, _texts(batch), strict=True):
                key = hashlib.blake2b(h.tobytes(), digest_size=16).digest() if len(h) else None
                ns.append(len(h))
                keys.append(key)
                if key is not None and i is not None and key not in seen:
                    seen.add(key)
                    post.append((i, len(h), _rarest(h, rank)))
            m = len(ids)
            none = pa.nulls(m, pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(["doc"] * m), pa.array(ids, pa.int64()), pa.array(ns, pa.int64()), pa.array(keys, pa.binary()), pa.nulls(m, pa.int32()), none, none, none, none],
                schema=_INDEX,
            )
            if post:
                yield _packed(post, buckets)

    return run


def _packed(post: list[tuple[int, int, np.ndarray]], buckets: int) -> pa.RecordBatch:
    h = np.concatenate([p for _, _, p in post])
    doc = np.repeat(np.arange(len(post)), [len(p) for _, _, p in post])
    bucket = ((h >> np.uint64(20)) % np.uint64(buckets)).astype(np.int32)
    order = np.argsort(bucket, kind="stable")  # within a bucket still by document
    h, doc, bucket = h[order], doc[order], bucket[order]
    ids, sizes = np.array([i for i, _, _ in post], np.int64), np.array([n for _, n, _ in post], np.int64)
    edge = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1], [True])))
    rows = []
    for a, b in zip(edge[:-1], edge[1:], strict=True):
        d, count = np.unique(doc[a:b], return_counts=True)
        rows.append((int(bucket[a]), ids[d].tobytes(), sizes[d].tobytes(), count.astype(np.int32).tobytes(), h[a:b].tobytes()))
    m = len(rows)
    return pa.RecordBatch.from_arrays(
        [pa.array(["postings"] * m), pa.nulls(m, pa.int64()), pa.nulls(m, pa.int64()), pa.nulls(m, pa.binary()), pa.array([r[0] for r in rows], pa.int32())]
        + [pa.array([r[k] for r in rows], pa.binary()) for k in range(1, 5)],
        schema=_INDEX,
    )


def _merge_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The buckets of a task, whose rows come one bucket after the other."""
    held, now = [], None
    for batch in batches:
        bucket = batch.column("bucket").to_numpy()
        edge = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1], [True])))
        for a, b in zip(edge[:-1], edge[1:], strict=True):
            if held and bucket[a] != now:
                yield from _merge_bucket(pa.Table.from_batches(held)).to_batches()
                held = []
            now = bucket[a]
            held.append(batch.slice(a, b - a))
    if held:
        yield from _merge_bucket(pa.Table.from_batches(held)).to_batches()


def _merge_bucket(table: pa.Table) -> pa.Table:
    """Inverted lists of one bucket: pairs on short lists and how many they share; star: a long list's label and each member."""
    ids, sizes, hashes = [], [], []
    for i, s, c, h in zip(*(table.column(k).to_pylist() for k in ("ids", "sizes", "lengths", "hashes")), strict=True):
        count = np.frombuffer(c, np.int32)
        ids.append(np.repeat(np.frombuffer(i, np.int64), count))
        sizes.append(np.repeat(np.frombuffer(s, np.int64), count))
        hashes.append(np.frombuffer(h, np.uint64))
    ids, sizes, hashes = np.concatenate(ids), np.concatenate(sizes), np.concatenate(hashes)
    order = np.lexsort((ids, sizes, hashes))
    ids, sizes, hashes = ids[order], sizes[order], hashes[order]
    edge = np.flatnonzero(np.concatenate(([True], hashes[1:] != hashes[:-1], [True])))
    length = np.diff(edge)
    left, right, kind = [], [], []
    for m in np.unique(length[(length > 1) & (length <= SHORT_LIST)]):
        at = edge[:-1][length == m]  # all lists of m documents at once
        for gap in range(1, m):
            first = (at[:, None] + np.arange(m - gap)).ravel()
            near = 100 * sizes[first] >= PERCENT * sizes[first + gap]
            left.append(ids[first[near]])
            right.append(ids[first[near] + gap])
            kind.append(np.zeros(int(near.sum()), bool))
    for a, m in zip(edge[:-1][length > SHORT_LIST], length[length > SHORT_LIST], strict=True):
        left.append(np.full(m, ids[a : a + m].min()))
        right.append(ids[a : a + m])
        kind.append(np.ones(m, bool))
    if not left:
        return pa.table({"star": pa.array([], pa.bool_()), "a": pa.array([], pa.int64()), "b": pa.array([], pa.int64()), "shared": pa.array([], pa.int64())})
    a, b, star = np.concatenate(left), np.concatenate(right), np.concatenate(kind)
    low, high = np.minimum(a, b), np.maximum(a, b)  # a label is the least already
    order = np.lexsort((high, low, star))
    low, high, star = low[order], high[order], star[order]
    new = np.concatenate(([True], (low[1:] != low[:-1]) | (high[1:] != high[:-1]) | (star[1:] != star[:-1])))
    shared = np.diff(np.concatenate((np.flatnonzero(new), [len(new)])))
    return pa.table({"star": star[new], "a": low[new], "b": high[new], "shared": shared})


def _with_texts(requests: DataFrame, docs: DataFrame) -> DataFrame:
    """requests with the text of doc_id. Documents that none asks for stay out of the shuffle, a few apart.

    They are told by a Bloom bitmap of fixed size (1 MB), the only thing that is broadcast.
    """
    at = requests.select(F.pmod("doc_id", F.lit(BLOOM_SIZE)).alias("at"))
    found = at.groupBy(F.expr("at div 32").alias("w")).agg(F.expr("bit_or(shiftleft(1L, cast(at % 32 as int)))").alias("bits")).toArrow()
    bits = np.zeros(BLOOM_SIZE // 32 + 1, np.int64)
    bits[found.column("w").to_numpy()] = found.column("bits").to_numpy()
    sent = docs.sparkSession.sparkContext.broadcast(bits.astype(np.uint32))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(batch.column("doc_id").is_valid())
            pos = batch.column("doc_id").to_numpy(zero_copy_only=False).astype(np.int64) % BLOOM_SIZE
            hit = (sent.value[pos // 32] >> (pos % 32).astype(np.uint32)) & 1
            yield batch.filter(pa.array(hit.astype(bool)))

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, text string").join(requests, "doc_id")


def overlap_by_probe(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted sets: the smaller one's elements are searched in the larger."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0
    at = np.searchsorted(b, a)
    at[at == len(b)] = len(b) - 1
    return int((b[at] == a).sum())


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by hub, the hub's own texts first. Their distinct sets are held; partners are probed as they pass."""
    hub, own = None, {}
    for batch in slices(batches):
        a, b = [], []
        for h, i, role, s in zip(*(batch.column(k).to_pylist() for k in ("hub", "doc_id", "role")), _texts(batch), strict=True):
            if role == 0:
                if h != hub:
                    hub, own = h, {}
                own[s.tobytes()] = s
            elif h == hub and any(overlap_by_probe(o, s) >= required_overlap(len(o), len(s), PERCENT) for o in own.values()):
                a.append(h)
                b.append(i)
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def local_roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of n nodes the smallest node that the edges a-b reach."""
    root = np.arange(n)
    while True:
        low = root.copy()
        np.minimum.at(low, a, root[b])
        np.minimum.at(low, b, root[a])
        low = low[low]
        if (low == root).all():
            return root
        root = low


def divide_skip(sets: list[np.ndarray], side: np.ndarray | None = None, idle: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """All linked pairs (i, j) among sets; with side, only pairs of which one is on each side; with idle, none of two idle sets.

    Queries go by size; a query of n looks among sets that come after it and have up to 4/3 n elements, where
    T = required_overlap(n, n) or more are shared. Of its inverted lists the L longest are put aside, the
    others merged, counting each set's occurrences; those of T - L or more remain, and the L lists are probed
    for them by binary search, or merged too where that is less work.
    """
    size = np.array([len(s) for s in sets], np.int64)
    order = np.argsort(size, kind="stable")
    size, n_sets = size[order], len(order)
    flat = np.concatenate([sets[i] for i in order]) if n_sets else np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(n_sets), size)
    by = np.argsort(flat, kind="stable")  # within a list by size
    listed, edge = owner[by], np.flatnonzero(np.concatenate(([True], flat[by][1:] != flat[by][:-1], [True])))
    number = np.repeat(np.arange(len(edge) - 1), np.diff(edge))
    entry = number * n_sets + listed  # ascending: a list's number and a set on it
    place = np.empty(len(flat), np.int64)
    place[by] = np.arange(len(flat))
    start = np.concatenate(([0], np.cumsum(size)))
    limit = np.searchsorted(PERCENT * size, 100 * size, "right")
    found_a, found_b = [], []

    def counted(begin: np.ndarray, end: np.ndarray, q: int, stop: int) -> np.ndarray:
        """How often each set after q and before stop stands on the lists' ranges."""
        length = end - begin
        at = np.repeat(end - np.cumsum(length), length) + np.arange(int(length.sum()))
        held = listed[at] - (q + 1)
        return np.bincount(held[held < stop - q - 1], minlength=stop - q - 1)

    for q in range(n_sets):
        n, stop = int(size[q]), int(limit[q])
        if not n or stop <= q + 1:
            continue
        mine = place[start[q] : start[q + 1]]
        lists = number[mine]
        begin, end = mine + 1, edge[lists + 1]  # sets before q have looked for it
        length = end - begin
        t = required_overlap(n, n, PERCENT)
        if np.count_nonzero(length) < t:
            continue
        rank = np.argsort(length, kind="stable")
        put_aside = min(t - 1, int(t / (SKIP * np.log2(max(2, int(length.max()))) + 1)))
        short, long = rank[: n - put_aside], rank[n - put_aside :]
        count = counted(begin[short], end[short], q, stop)
        near = np.flatnonzero(count >= t - put_aside)
        if side is not None:
            near = near[side[order[q]] != side[order[near + q + 1]]]
        if idle is not None and idle[order[q]]:
            near = near[~idle[order[near + q + 1]]]
        if not len(near):
            continue
        total = count[near]
        if put_aside:
            if len(near) * len(long) * PROBE < int(length[long].sum()):
                probe = (lists[long][:, None] * n_sets + (near + q + 1)[None, :]).ravel()
                at = np.minimum(np.searchsorted(entry, probe), len(entry) - 1)
                total = total + (entry[at] == probe).reshape(len(long), len(near)).sum(axis=0)
            else:
                total = total + counted(begin[long], end[long], q, stop)[near]
        near = near[total >= -(-PERCENT * (n + size[near + q + 1]) // (100 + PERCENT))]
        found_a.append(np.full(len(near), order[q]))
        found_b.append(order[near + q + 1])
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *found_a]), np.concatenate([none, *found_b])


def _search_task(table: pa.Table) -> pa.Table:
    """Links within the windows of a task, or between two parts of one: a row for each linked document and window."""
    table = table.group_by([c for c in table.column_names if c != "task"]).aggregate([]).sort_by([("label", "ascending"), ("win", "ascending"), ("doc_id", "ascending")])
    sets = list(shingle_sets(table.column("text").to_pylist()))
    size = np.array([len(s) for s in sets])
    label, win, ids, copies, home, part, least, most = (table.column(c).to_numpy() for c in ("label", "win", "doc_id", "copies", "home", "part", "least", "most"))
    low, before = np.array(table.column("low").to_pylist(), bool), table.column("before").to_pylist()
    i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
    edge = np.flatnonzero(np.concatenate(([True], (label[1:] != label[:-1]) | (win[1:] != win[:-1]), [True])))
    out = []
    for start, stop in zip(edge[:-1], edge[1:], strict=True):
        # of several texts of one doc_id those of the window's sizes
        own = start + np.flatnonzero((size[start:stop] >= least[start:stop]) & (size[start:stop] <= most[start:stop]))
        a, b = divide_skip([sets[k] for k in own], None if i == j else part[own] == i, low[own])
        a, b = own[a], own[b]
        first = home[a] == label[start]
        for k in np.flatnonzero(home[a] != home[b]):
            first[k] = set(before[a[k]].split(",")).isdisjoint(before[b[k]].split(",")) or not before[a[k]]
        a, b = a[first] - start, b[first] - start
        links = np.zeros(stop - start, np.int64)
        np.add.at(links, a, copies[start + b])
        np.add.at(links, b, copies[start + a])
        root = local_roots(stop - start, a, b)
        keep = np.flatnonzero(links)
        out.append((ids[start + keep], ids[start + root[keep]], links[keep]))
    columns = [np.concatenate([o[c] for o in out]) for c in range(3)]
    return pa.table({"doc_id": columns[0], "root": columns[1], "links": columns[2]})


def jaccard_join(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id, n_links) for every row of docs (columns doc_id and text are used).

    component_id is the smallest doc_id reachable by links, n_links the number of other documents linked
    directly. A null or empty text has no shingle and links with nothing. doc_id names a document:
    repeated rows count once and each get the document's values, rows of one doc_id with different
    texts link with what any of the texts links with. A null doc_id links with nothing and has a null
    component. Of no rows, no rows come.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    with scratch(spark) as place:
        ranks, shingles = _shingle_ranks(docs)
        buckets = max(FEWEST_BUCKETS, -(-shingles // (4 * POSTINGS_A_BUCKET)))
        tasks = min(buckets, MOST_TASKS, max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-shingles // (4 * POSTINGS_A_BUCKET))))
        index = place.table(docs.mapInArrow(_indexer(spark.sparkContext.broadcast(ranks), buckets), _INDEX_DDL), "index")
        known = index.filter("kind = 'doc'").select("doc_id", "n", "set_key")
        member = known.filter("set_key is not null and doc_id is not null").distinct()
        classes = member.groupBy("set_key").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies"), F.max("n").alias("n"))
        classes = place.table(classes, "classes")
        member = place.table(member.join(classes.select("set_key", "rep"), "set_key").select("doc_id", "rep", "set_key", "n"), "member")
        postings = index.filter("kind = 'postings'").select("bucket", "ids", "sizes", "lengths", "hashes")
        postings = postings.repartitionById(tasks, F.col("bucket") % tasks).sortWithinPartitions("bucket")
        merged = place.table(postings.mapInArrow(_merge_buckets, "star boolean, a long, b long, shared long"), "merged")
        rep = member.select("doc_id", "rep", "n").groupBy("doc_id", "rep").agg(F.max("n").alias("n"))
        short = (
            merged.filter("not star").groupBy("a", "b").agg(F.sum("shared").alias("shared"))
            .join(rep.withColumnsRenamed({"doc_id": "a", "rep": "ra", "n": "na"}), "a")
            .join(rep.withColumnsRenamed({"doc_id": "b", "rep": "rb", "n": "nb"}), "b")
            .filter("ra <> rb")
            .groupBy(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b"))
            .agg(F.sum("shared").alias("shared"), F.min(F.expr(f"({PERCENT} * (na + nb) + {99 + PERCENT}) div {100 + PERCENT} - ({PERCENT} * greatest(na, nb) + 99) div 100 + 1")).alias("least"))
            .filter("shared >= least")
        )
        short = place.table(short.select("a", "b"), "short")
        to_rep = rep.select("doc_id", "rep")
        stars = merged.filter("star").select("a", "b").distinct().join(to_rep.withColumnsRenamed({"doc_id": "a", "rep": "label"}), "a").join(to_rep.withColumnsRenamed({"doc_id": "b", "rep": "id"}), "b")
        stars = place.table(stars.select("label", "id").union(stars.select("label", "label")).distinct(), "stars")
        sizes = classes.groupBy("rep").agg(F.sum("copies").alias("copies"))
        linked = place.table(_verified(_short_list_pairs(short, stars, place), docs).distinct(), "linked")
        labels = place.table(stars.groupBy("id").agg(F.sort_array(F.collect_set("label")).alias("labels")), "labels")  # one for each of its short lists at most
        windows = place.table(_windows(labels, classes, sizes), "windows")
        dense = place.table(_window_links(windows, _window_parts(windows, place), labels, docs), "dense")
        weight = sizes.select(F.col("rep").alias("other"), "copies")
        both = linked.select(F.col("a").alias("doc_id"), F.col("b").alias("other")).union(linked.select("b", "a"))
        links = both.join(weight, "other").select("doc_id", F.col("copies").alias("links")).union(dense.select("doc_id", "links"))
        links = links.groupBy("doc_id").agg(F.sum("links").alias("links"))
        edges = linked.select(F.col("a").alias("u"), F.col("b").alias("v")).union(dense.select("doc_id", "root")).union(member.select("doc_id", "rep"))
        component = connected_components(edges, place)
        per_class = classes.select("set_key", "rep", "copies").join(links.withColumnRenamed("doc_id", "rep"), "rep", "left").select("set_key", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
        per_doc = member.join(per_class, "set_key").groupBy("doc_id").agg(F.max("n_links").alias("n_links"))
        out = known.select("doc_id", F.col("n").alias("n_shingles")).join(per_doc, "doc_id", "left").join(component.withColumnRenamed("id", "doc_id"), "doc_id", "left")
        return durable(out.select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links")))


def _windows(labels: DataFrame, classes: DataFrame, sizes: DataFrame) -> DataFrame:
    """A row for each document, label and window: that of its own band, and the next, where it is `low`.

    home is the document's least label, at the label's place among its labels. least and most are the least and
    the largest of its sets' sizes in the band; a document of texts in several bands has rows for each.
    """
    band = F.floor(F.log("n") / F.log(F.lit(BAND))).alias("band")
    bands = classes.groupBy(F.col("rep").alias("id"), band).agg(F.min("n").alias("least"), F.max("n").alias("most"))
    rows = labels.join(bands, "id").join(sizes.withColumnRenamed("rep", "id"), "id")
    rows = rows.select("id", "copies", "least", "most", "band", F.col("labels")[0].alias("home"), F.posexplode("labels").alias("at", "label"))
    rows = rows.withColumn("low", F.explode(F.array(F.lit(False), F.lit(True))))
    return rows.withColumn("win", F.col("band") + F.col("low").cast("long")).drop("band")


def _window_parts(windows: DataFrame, place: Scratch) -> DataFrame:
    """(label, win, parts, task) of the windows to search; task is null for those that are split."""
    found = windows.groupBy("label", "win").agg(F.count("*").alias("docs"), F.sum("most").alias("shingles"), F.count_if(~F.col("low")).alias("own"), F.min("home").alias("h"), F.max("home").alias("g"))
    found = found.filter("own > 0 and docs > 1 and (h = label or h < g)")
    parts = F.ceil(F.greatest(F.col("docs") / PART_DOCS, F.col("shingles") / PART_SHINGLES))
    found = place.table(found.select("label", "win", "docs", parts.cast("int").alias("parts")), "sizes")
    tasks = (found.filter("parts = 1").agg(F.sum("docs")).first()[0] or 0) // TASK_DOCS + 1
    return found.select("label", "win", "parts", F.when(F.col("parts") == 1, F.concat(F.lit("some/"), F.pmod(F.xxhash64("label", "win"), F.lit(tasks)))).alias("task"))


def _window_links(windows: DataFrame, parts: DataFrame, labels: DataFrame, docs: DataFrame) -> DataFrame:
    """DivideSkip over each window, in pairs of parts where it is split."""
    part, other = F.col("part"), F.col("other")
    before = F.concat_ws(",", F.slice("labels", F.lit(1), F.col("at")).cast("array<string>"))
    rows = windows.join(parts, ["label", "win"]).join(labels, "id").withColumn("before", before).drop("labels", "at")
    rows = rows.withColumn("part", F.pmod(F.xxhash64("id"), "parts").cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    rows = rows.withColumn("i", F.least(part, other)).withColumn("j", F.greatest(part, other)).drop("other", "parts")
    rows = rows.withColumn("task", F.coalesce("task", F.concat_ws("/", "label", "win", "i", "j"))).withColumnRenamed("id", "doc_id")
    return _with_texts(rows, docs).groupBy("task").applyInArrow(_search_task, "doc_id long, root long, links long")


def _short_list_pairs(short: DataFrame, stars: DataFrame, place: Scratch) -> DataFrame:
    """Candidates of short lists, without those that share a label, which a window's search compares."""
    both = short.join(stars.withColumnRenamed("id", "a"), "a").join(stars.withColumnRenamed("id", "b"), ["b", "label"])
    return place.table(short.join(both.select("a", "b").distinct(), ["a", "b"], "left_anti"), "pairs")


def _verified(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    asked = pairs.select(F.col("a").alias("hub"), F.col("b").alias("doc_id"), F.lit(1).alias("role"))
    asked = asked.union(pairs.select("a", F.col("a").alias("b"), F.lit(0)).distinct())
    return _with_texts(asked, docs).select("hub", "doc_id", "text", "role").repartition("hub").sortWithinPartitions("hub", "role", "doc_id").mapInArrow(_verify, "a long, b long")
