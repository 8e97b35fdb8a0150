"""Embedding near-dedup by a subspace pigeonhole join.

Unit vectors of cosine c or more are within squared distance 2 - 2c. A fixed random rotation spreads a
vector's length evenly over its coordinates, which are split into blocks of BLOCK_DIMS; a block's budget
is its share of the squared distance, in proportion to its dimensions. By the pigeonhole principle a
linked pair keeps to the budget in one block at least, so the union of the blocks' range joins misses none.

1. The search works on rotated coordinates in whole STEPs, a byte each. What rounding can move a block by is added
   to its reach, so that no pair is lost, and whether a pair keeps within a block's reach is told in whole numbers,
   the same by every task. A range join deals vectors to grid cells over the first coordinates of the block, as wide
   as the reach, and compares a cell with itself and with those vectors of neighbour cells that lie near enough.
2. A pair is judged in the first block that holds it, if its whole rounded distance allows a link. Of each
   task only the vectors of such pairs go on; joined with their whole coordinates, they are compared there
   in double precision. So counts are exact without a list of pairs, and whole vectors go nowhere else.

Cells of more than CELL_ROWS rows are split, and each pair of parts is a task of its own.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.llm.jaccard_join import local_roots
from lectern.llm.shared import connected_components, durable, scratch

COSINE = 0.95
BLOCK_DIMS = 8
STEP = 1 / 127
CELL_ROWS = 40_000
SLACK = 1e-9  # for rounding in the rotation, far below any budget
TILE = 512

_TASK = ["dims", "block", "cell", "i", "j"]


@functools.cache
def _rotation(dims: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(dims).standard_normal((dims, dims)))
    return q * np.sign(np.diag(r))


def _blocks(dims: int) -> list[tuple[int, int]]:
    return [(a, min(a + BLOCK_DIMS, dims)) for a in range(0, dims, BLOCK_DIMS)]


def _reach(part: int, dims: int, cosine: float) -> int:
    """The largest squared distance, in steps, of rounded coordinates of `part` of `dims` dimensions that a link allows."""
    true = np.sqrt((2 - 2 * cosine) * part / dims + SLACK)
    return int((true / STEP + np.sqrt(part)) ** 2 + 1e-6)


def _vectors(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(positions, vectors in double precision) of the embeddings of each length."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    start = np.concatenate(([0], np.cumsum(column.value_lengths().to_numpy(zero_copy_only=False))))
    length = np.diff(start)
    for d in np.unique(length):
        at = np.flatnonzero(length == d)
        yield at, flat[(start[at][:, None] + np.arange(d)).ravel()].reshape(len(at), d)


def _unit(x: np.ndarray) -> np.ndarray:
    """Vectors at length 1, whatever their length was."""
    x = x / np.abs(x).max(axis=1)[:, None]
    return x / np.linalg.norm(x, axis=1)[:, None]


def _rounded(x: np.ndarray) -> np.ndarray:
    """Rotated unit vectors in steps."""
    return np.rint((_unit(x) @ _rotation(x.shape[1])) / STEP).astype(np.int8)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = np.empty(batch.num_rows, object)
        for at, x in _vectors(batch.column("embedding")):
            for k, v in zip(at, x + 0.0, strict=True):  # of the two zeros one
                out[k] = hashlib.blake2b(v.tobytes(), digest_size=16).digest()
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.binary())], [*batch.schema.names, "digest"])


def _cells(q: np.ndarray, grid: int, cosine: float) -> Iterator[tuple[int, np.ndarray, np.ndarray, bool]]:
    """(block, rows, cells, probe): each vector's own cell, and those later neighbour cells that it reaches into."""
    for k, (a, b) in enumerate(_blocks(q.shape[1])):
        most = _reach(b - a, q.shape[1], cosine)
        width, g = int(np.sqrt(most)) + 1, min(grid, b - a)
        head = q[:, a : a + g].astype(np.int64)
        home = head // width
        for move in itertools.product((-1, 0, 1), repeat=g):
            if move < (0,) * g:
                continue
            step = np.array(move)
            gap = np.where(step > 0, (home + 1) * width - head, np.where(step < 0, head - home * width + 1, 0))
            near = np.flatnonzero((gap**2).sum(axis=1) <= most)
            if len(near):
                yield k, near, (home[near] + step).astype(np.int16), any(move)


def _counter(cosine: float, grid: int):
    """How many vectors of a batch come to each cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, x in _vectors(batch.column("embedding")):
                for k, near, cell, probe in _cells(_rounded(x), grid, cosine):
                    name, rows = np.unique(cell, axis=0, return_counts=True)
                    n = len(name)
                    columns = [pa.array(np.full(n, x.shape[1], np.int32)), pa.array(np.full(n, k, np.int32)), pa.array([c.tobytes() for c in name], pa.binary()), pa.array(np.where(probe, 0, rows)), pa.array(np.where(probe, rows, 0))]
                    yield pa.RecordBatch.from_arrays(columns, ["dims", "block", "cell", "home", "probe"])

    return run


def _dealer(cosine: float, grid: int, split):
    """Vectors packed by task. Parts of a split cell: its own vectors first, then those that reach into it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("rep").to_numpy()
            lot = ((ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)).astype(np.int64)
            for at, x in _vectors(batch.column("embedding")):
                q, d = _rounded(x), x.shape[1]
                for k, near, cell, probe in _cells(q, grid, cosine):
                    order = np.lexsort(cell.T)
                    near, cell = near[order], cell[order]
                    edge = np.flatnonzero(np.concatenate(([True], (cell[1:] != cell[:-1]).any(axis=1), [True])))
                    rows = []
                    for a, b in zip(edge[:-1], edge[1:], strict=True):
                        name, some = cell[a].tobytes(), near[a:b]
                        own, other = split.value.get((d, k, name), (1, 0))
                        if own == 0:
                            continue  # a cell without vectors of its own
                        part = lot[at[some]] % (other if probe and other else own)
                        for p in np.unique(part).tolist():
                            mine = some[part == p]
                            packed = (ids[at[mine]].tobytes(), q[mine].tobytes())
                            if not other:  # one task for the whole cell
                                rows.append((name, 0, 0, probe, *packed))
                            elif probe:
                                rows += [(name, i, own + p, True, *packed) for i in range(own)]
                            else:
                                rows += [(name, min(o, p), max(o, p), o < p, *packed) for o in range(own)]
                                rows += [(name, p, own + j, False, *packed) for j in range(other)]
                    n = len(rows)
                    columns = [pa.array(np.full(n, d, np.int32)), pa.array(np.full(n, k, np.int32))]
                    columns += [pa.array([r[c] for r in rows], t) for c, t in enumerate((pa.binary(), pa.int32(), pa.int32(), pa.bool_(), pa.binary(), pa.binary()))]
                    yield pa.RecordBatch.from_arrays(columns, [*_TASK, "second", "ids", "raw"])

    return run


def _near(q: np.ndarray, first: int, inner: bool, k: int, cosine: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs, in portions, that block k holds first and whose whole distance allows a link: of the first vectors
    with the others, and, if inner, among themselves."""
    n, d = q.shape
    blocks = _blocks(d)
    most, whole = [_reach(b - a, d, cosine) for a, b in blocks], _reach(d, d, cosine)
    y = q[:, slice(*blocks[k])].astype(np.float32)
    square = (y * y).sum(axis=1)  # whole numbers below 2**24, as are the distances
    # the others go by their second coordinate, of which a tile needs a window
    by = min(1, y.shape[1] - 1)
    order = np.concatenate([np.argsort(y[:first, by], kind="stable"), first + np.argsort(y[first:, by], kind="stable")])
    y, square = y[order], square[order]
    far = int(np.sqrt(most[k])) + 1
    for top in range(0, first, TILE):
        end = min(first, top + TILE)
        low, high = y[top, by] - far, y[end - 1, by] + far
        for begin, stop in ([(0, first)] if inner else []) + [(first, n)]:
            left, right = begin + np.searchsorted(y[begin:stop, by], [low, high + 1])
            left = max(left, top) if begin == 0 else left
            for a in range(left, right, 8 * TILE):
                b = min(right, a + 8 * TILE)
                p, r = np.nonzero(square[top:end, None] + square[None, a:b] - 2 * (y[top:end] @ y[a:b].T) <= most[k])
                p, r = p + top, r + a
                p, r = order[p[p < r]], order[r[p < r]]
                for s in range(0, len(p), 1 << 16):
                    u, v = p[s : s + (1 << 16)], r[s : s + (1 << 16)]
                    apart = (q[u].astype(np.int32) - q[v]) ** 2
                    ok = apart.sum(axis=1) <= whole
                    u, v, apart = u[ok], v[ok], apart[ok]
                    held = np.zeros(len(u), bool)
                    for (x, z), m in zip(blocks[:k], most, strict=False):
                        held |= apart[:, x:z].sum(axis=1) <= m
                    if not held.all():
                        yield u[~held], v[~held]


def _searcher(cosine: float):
    """The vectors of a task that are in a pair which may link."""

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        d, k, cell, i, j = (s.as_py() for s in key)
        table = table.sort_by([("second", "ascending")])
        second = np.array(table.column("second").to_pylist(), bool)
        sizes = np.array([len(r) // 8 for r in table.column("ids").to_pylist()])
        ids = np.frombuffer(b"".join(table.column("ids").to_pylist()), np.int64)
        q = np.frombuffer(b"".join(table.column("raw").to_pylist()), np.int8).reshape(-1, d)
        hit = np.zeros(len(ids), bool)
        for a, b in _near(q, int(sizes[~second].sum()), i == j, k, cosine):
            hit[a] = hit[b] = True
        n = int(hit.sum())
        second = np.repeat(second, sizes)[hit]
        columns = [pa.array([v] * n, t) for v, t in ((d, pa.int32()), (k, pa.int32()), (cell, pa.binary()), (i, pa.int32()), (j, pa.int32()))]
        return pa.Table.from_arrays([*columns, pa.array(second), pa.array(ids[hit])], names=[*_TASK, "second", "rep"])

    return run


def _judge(cosine: float):
    """Links of a task among what its search left, told by whole vectors: a row for each linked one."""

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        d, k, _, i, j = (s.as_py() for s in key)
        table = table.sort_by([("second", "ascending"), ("rep", "ascending")]).combine_chunks()
        ids, copies = table.column("rep").to_numpy(), table.column("copies").to_numpy()
        n, first = len(ids), int((~np.array(table.column("second").to_pylist(), bool)).sum())
        x = np.array(table.column("embedding").combine_chunks().flatten().to_numpy(zero_copy_only=False), np.float64).reshape(n, d)
        unit = _unit(x)
        links, root = np.zeros(n, np.int64), np.arange(n)
        for a, b in _near(_rounded(x), first, i == j, k, cosine):
            true = np.einsum("ij,ij->i", unit[a], unit[b]) >= cosine
            a, b = a[true], b[true]
            np.add.at(links, a, copies[b])
            np.add.at(links, b, copies[a])
            open_ = root[a] != root[b]
            if open_.any():
                root = local_roots(n, np.concatenate([np.arange(n), a[open_]]), np.concatenate([root, b[open_]]))
        keep = links > 0
        return pa.table({"vec_id": ids[keep], "root": ids[root][keep], "links": links[keep]})

    return run


def _usable(e: Column) -> Column:
    good = F.forall(e, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return e.isNotNull() & (F.size(e) > 0) & good & F.exists(e, lambda v: v != 0)


def embedding_dedup(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of vectors (vec_id and embedding are used).

    A vector that is null, empty, all zero or holds a null or non-finite component links with nothing,
    and neither does a row without vec_id; vectors of different lengths don't link. Rows of equal
    vectors are linked copies, also rows repeated under one vec_id. Components other than floats are
    taken as doubles. Of no rows, no rows come.
    """
    spark = vectors.sparkSession
    kind = "array<float>" if "float" in vectors.schema["embedding"].dataType.simpleString() else "array<double>"
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(kind).alias("embedding"))
    good = F.coalesce(_usable(F.col("embedding")) & F.col("vec_id").isNotNull(), F.lit(False))
    with scratch(spark) as place:
        known = rows.filter(good).mapInArrow(_digests, f"vec_id long, embedding {kind}, digest binary")
        classes = known.groupBy("digest").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"), F.any_value("embedding").alias("embedding"))
        classes = place.table(classes, "classes")
        member = place.table(known.drop("embedding").join(classes.drop("embedding"), "digest"), "member")
        n = classes.count()
        grid = 1 if n < 200_000 else 2 if n < 2_000_000 else 3 if n < 20_000_000 else 4
        counts = classes.select("embedding").mapInArrow(_counter(cosine, grid), "dims int, block int, cell binary, home long, probe long")
        counts = counts.groupBy("dims", "block", "cell").agg(F.sum("home").alias("home"), F.sum("probe").alias("probe"))
        half = CELL_ROWS / 2
        parts = counts.filter((F.col("home") + F.col("probe") > CELL_ROWS) | (F.col("home") == 0)).select(
            "dims", "block", "cell", F.when(F.col("home") == 0, 0).otherwise(F.ceil(F.col("home") / half)).cast("int").alias("own"), F.greatest(F.lit(1), F.ceil(F.col("probe") / half)).cast("int").alias("other")
        )
        # cells that are split hold more than CELL_ROWS rows each, and empty ones border on others
        split = spark.sparkContext.broadcast({(r["dims"], r["block"], bytes(r["cell"])): (r["own"], r["other"]) for r in parts.collect()})
        dealt = classes.select("rep", "embedding").mapInArrow(_dealer(cosine, grid, split), "dims int, block int, cell binary, i int, j int, second boolean, ids binary, raw binary")
        near = place.table(dealt.groupBy(*_TASK).applyInArrow(_searcher(cosine), "dims int, block int, cell binary, i int, j int, second boolean, rep long"), "near")
        judged = near.join(classes.drop("digest"), "rep").groupBy(*_TASK).applyInArrow(_judge(cosine), "vec_id long, root long, links long")
        found = place.table(judged, "found")
        links = found.groupBy(F.col("vec_id").alias("rep")).agg(F.sum("links").alias("links"))
        per_class = classes.select("digest", "rep", "copies").join(links, "rep", "left").select("digest", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
        edges = found.select(F.col("vec_id").alias("u"), F.col("root").alias("v")).union(member.select("vec_id", "rep"))
        component = connected_components(edges, place)
        told = member.select("vec_id", "digest").join(per_class, "digest").select(F.col("vec_id").alias("id"), "n_links").unionByName(rows.filter(~good).select(F.col("vec_id").alias("id"), F.lit(0).cast("long").alias("n_links")))
        out = told.join(component.select("id", "component"), "id", "left").select(F.col("id").alias("vec_id"), "n_links", F.coalesce("component", "id").alias("component_id"))
        return durable(out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))))
