"""Vector code compression by dual-tree Lloyd.

Components become integers, vectors are cut into parts, and every part position has a
codebook that Lloyd's rounds improve: each part goes to its nearest entry, each entry
becomes the floored mean of its parts.  The nearest entries are found from two trees.  A
block of vectors holds a tree over its parts for every position (median cuts along the
widest component; boxes, sums and counts at every node), the entries have one as well.
Both are descended together: for a node of parts, a node of entries and a reference
entry, the least possible excess of a part's squared distance to the entries over that to
the reference is a sum over components, each at an end of the box; where it is positive,
no part of the node can be nearest to, or tie with, any of the entries, and the pair goes.  A
node left with one entry is assigned whole, by its cached sum and count; leaves with
several compute integer distances to those.  All values are integers (held in doubles
only where every sum stays below 2^53), so codes, ties and codebooks are exactly those of
the plain form.

The blocks are written once; a round is one pass over them that shuffles a sum for each
entry's component and task, and only the codebooks come back to the driver.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import small
from .common import written

LEAF = 64  # parts in a leaf, at most
BLOCK_VALUES = 1 << 19  # components in a block, about
ENTRY_STEPS = 2  # levels of the entries' tree for one of the parts'


# --- trees ------------------------------------------------------------------------------------

def bounds(n: int, level: int) -> np.ndarray:
    """Borders of the ``2^level`` nodes of a level over ``n`` points; those of a deeper level refine them."""
    return (np.arange((1 << level) + 1) * n) >> level


def depth_of(n: int, leaf: int) -> int:
    return max(0, math.ceil(math.log2(max(1, n) / leaf)))


def tree_order(points: np.ndarray, leaf: int) -> np.ndarray:
    """The points' order in a tree that halves each node along its widest component."""
    n = len(points)
    order = np.arange(n)
    if points.shape[1] == 0:
        return order
    for level in range(depth_of(n, leaf)):
        edges = bounds(n, level)
        held = points[order]
        spread = np.maximum.reduceat(held, edges[:-1]) - np.minimum.reduceat(held, edges[:-1])
        node = np.repeat(np.arange(len(edges) - 1), np.diff(edges))
        order = order[np.lexsort((held[np.arange(n), spread.argmax(axis=1)[node]], node))]
    return order


class Tree:
    """Boxes, sums and counts of every node over points that stand in tree order."""

    def __init__(self, points: np.ndarray, leaf: int):
        n, depth = len(points), depth_of(len(points), leaf)
        self.points, self.depth = points, depth
        starts = bounds(n, depth)[:-1]
        low, high = np.minimum.reduceat(points, starts), np.maximum.reduceat(points, starts)
        total = np.add.reduceat(points, starts)
        self.low, self.high, self.total = [low], [high], [total]
        for _ in range(depth):  # upwards: two children make a node
            low, high = np.minimum(low[::2], low[1::2]), np.maximum(high[::2], high[1::2])
            total = total[::2] + total[1::2]
            self.low.insert(0, low)
            self.high.insert(0, high)
            self.total.insert(0, total)


@dataclass
class Codebook:
    """The entries of a part position, as given, and a tree over the distinct ones."""

    entries: np.ndarray

    def __post_init__(self):
        distinct, first = np.unique(self.entries, axis=0, return_index=True)
        order = tree_order(distinct, 1)
        self.distinct = len(order)  # columns beyond fill the last level and are never alive in it
        order = np.append(order, np.repeat(order[-1:], (1 << depth_of(len(order), 1)) - len(order)))
        self.index = first[order]  # the smallest index of each distinct entry, in tree order
        self.tree = Tree(distinct[order], 1)
        self.limit = int(np.abs(self.entries).max(initial=0))


def excess(low: np.ndarray, high: np.ndarray, entry_low: np.ndarray, entry_high: np.ndarray, near: np.ndarray) -> np.ndarray:
    """The least of ``|x - e|^2 - |x - near|^2`` over a box of ``x`` and a box of ``e``, row by row.

    A component's share is linear in ``x`` for each ``e``, so its least lies at an end of the box.
    """
    ends = []
    for x in (low, high):
        gap = np.maximum(np.maximum(entry_low - x, x - entry_high), 0)
        ends.append(gap * gap - (x - near) ** 2)
    return np.minimum(*ends).sum(axis=1)


def products(x: np.ndarray, e: np.ndarray, limit: int) -> np.ndarray:
    """``x @ e.T`` of integers up to ``limit``: in doubles where that is exact."""
    if x.shape[1] * limit * limit < 1 << 52:
        return (x.astype(np.float64) @ e.T.astype(np.float64)).astype(np.int64)
    return x @ e.T


def nearest(tree: Tree, book: Codebook) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """The entry of each point (in tree order), and the nodes assigned whole as ``(level, node, entry)``."""
    n = len(tree.points)
    entries, index = book.tree.points, book.index
    limit = max(book.limit, int(np.abs(tree.points).max(initial=0)))
    square = (entries * entries).sum(axis=1)
    by_index = np.argsort(index)
    which, whole = np.empty(n, np.int64), []
    nodes, alive, e_level = np.zeros(1, np.int64), np.ones((1, 1), bool), 0
    for level in range(tree.depth + 1):
        low, high = tree.low[level][nodes], tree.high[level][nodes]
        near = entries[(square[None, :] - products(low + high, entries, 2 * limit)).argmin(axis=1)]
        while True:
            p, e = np.nonzero(alive)
            for at in range(0, len(p), 1 << 15):
                pp, ee = p[at:at + (1 << 15)], e[at:at + (1 << 15)]
                far = excess(low[pp], high[pp], book.tree.low[e_level][ee], book.tree.high[e_level][ee], near[pp]) > 0
                alive[pp[far], ee[far]] = False
            if e_level == book.tree.depth or (level < tree.depth and e_level >= ENTRY_STEPS * (level + 1)):
                break
            alive = np.repeat(alive, 2, axis=1)
            e_level += 1
            if e_level == book.tree.depth:
                alive[:, book.distinct:] = False
        edges = bounds(n, level)
        if e_level == book.tree.depth:
            single = alive.sum(axis=1) == 1
            for node, entry in zip(nodes[single].tolist(), index[alive[single].argmax(axis=1)].tolist()):
                which[edges[node]:edges[node + 1]] = entry
                whole.append((level, node, entry))
            nodes, alive = nodes[~single], alive[~single]
        if level == tree.depth or not len(nodes):
            break
        nodes = (2 * nodes[:, None] + np.arange(2)).ravel()
        alive = np.repeat(alive, 2, axis=0)
    edges = bounds(n, tree.depth)
    for node, line in zip(nodes.tolist(), alive):  # uncertain leaves
        rows = slice(edges[node], edges[node + 1])
        left = by_index[line[by_index]]  # ties go to the first, the smallest index
        distance = square[left][None, :] - 2 * products(tree.points[rows], entries[left], limit)
        which[rows] = index[left[distance.argmin(axis=1)]]
    return which, whole


def entry_sums(tree: Tree, book: Codebook) -> tuple[np.ndarray, np.ndarray]:
    """Sums and counts of the points of each entry: cached ones of whole nodes, the rest point by point."""
    which, whole = nearest(tree, book)
    total, count = np.zeros_like(book.entries), np.zeros(len(book.entries), np.int64)
    rest = np.ones(len(which), bool)
    for level, node, entry in whole:
        edges = bounds(len(which), level)
        total[entry] += tree.total[level][node]
        count[entry] += edges[node + 1] - edges[node]
        rest[edges[node]:edges[node + 1]] = False
    np.add.at(total, which[rest], tree.points[rest])
    return total, count + np.bincount(which[rest], minlength=len(count))


# --- blocks -----------------------------------------------------------------------------------

def integers(vectors: pa.ListArray, width: int, scale: int) -> np.ndarray:
    """Rows of floored scaled components; absent ones at the end are 0."""
    lengths = np.diff(vectors.offsets.to_numpy())
    values = np.floor(np.float64(scale) * vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
    limit = math.isqrt((1 << 62) // max(1, width)) // 2  # so that an error fits into a long
    values = np.clip(values, -limit, limit).astype(np.int64)
    if (lengths == width).all():
        return values.reshape(len(lengths), width)
    out = np.zeros((len(lengths), width), np.int64)
    out[np.arange(width)[None, :] < lengths[:, None]] = values
    return out


def ready(embedding: Column) -> Column:
    """Vectors without nulls and non-finite components."""
    return embedding.isNotNull() & ~F.exists(embedding, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))


def blocks_of(rows: DataFrame, names: list[str], width: int, parts: int, scale: int) -> DataFrame:
    """One row a block: the kept columns as arrays, the integer components, and each part position's tree order."""
    schema = T.StructType([T.StructField(c, T.ArrayType(rows.schema[c].dataType)) for c in names]
                          + [T.StructField("points", T.BinaryType()), T.StructField("orders", T.BinaryType())])
    w = width // parts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            count = max(1, -(-batch.num_rows * max(1, width) // BLOCK_VALUES))
            for i in range(count):
                a, b = batch.num_rows * i // count, batch.num_rows * (i + 1) // count
                if a == b:
                    continue
                held = batch.slice(a, b - a)
                points = integers(held.column("vector"), width, scale)
                orders = np.stack([tree_order(points[:, j * w:(j + 1) * w], LEAF) for j in range(parts)])
                kept = [pa.ListArray.from_arrays(pa.array([0, b - a], pa.int32()), pa.concat_arrays([held.column(c)])) for c in names]
                yield pa.RecordBatch.from_arrays(
                    [*kept, pa.array([points.astype("<i8" if np.abs(points).max(initial=0) >= 1 << 15 else "<i2").tobytes()], pa.binary()),
                     pa.array([orders.astype("<i4").tobytes()], pa.binary())], names=schema.names)

    return rows.select(*names, "vector").mapInArrow(run, schema)


def block_points(batch: pa.RecordBatch, row: int, width: int, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """The integer components and the orders (a row a part position) of a block."""
    orders = np.frombuffer(batch.column("orders")[row].as_buffer(), "<i4").reshape(parts, -1)
    raw = batch.column("points")[row].as_buffer()
    n = orders.shape[1]
    kind = "<i8" if width and len(raw) == 8 * n * width else "<i2"
    return np.frombuffer(raw, kind).reshape(n, width).astype(np.int64), orders


@dataclass
class Compressed:
    """``rows``: the kept columns with ``code`` and ``error``; ``codebooks``: the entries of each part position."""

    rows: DataFrame
    codebooks: list[np.ndarray]

    def digest(self) -> str:
        """SHA-256 of all components by part, entry and position."""
        said = ",".join(str(x) for book in self.codebooks for x in book.ravel().tolist())
        return hashlib.sha256(said.encode()).hexdigest()


def compress(vectors: DataFrame, keep: list[str], parts: int = 4, entries: int = 256, rounds: int = 4,
             scale: int = 1024) -> Compressed:
    """Codes of ``(vec_id, embedding)`` rows after ``rounds`` of Lloyd from the ``entries`` smallest ids.

    ``keep`` names the columns that the result carries, beside ``code`` (two hex digits a
    part) and ``error`` (squared distances summed over the parts); others are ignored, and
    those named ``code`` or ``error`` give way.  Rows whose vector is null or holds null or
    non-finite components are dropped.  A component ``x`` is ``floor(scale * x)``, within a
    bound (2^27 at 64 components) beyond which a long could not hold an error.  Vectors
    shorter than the longest, or a length that the parts do not divide, are read as ending
    in zeros.  Ids that repeat stand in the order of their vectors, null ids last; fewer
    rows than ``entries`` make a smaller codebook; equal entries: the first is used.
    Repeated rows get equal codes; vectors of any length are read whole.  An empty table gives an empty result and empty codebooks.
    """
    if not 1 <= entries <= 256:
        raise ValueError("1 to 256 entries fit two hex digits")
    spark = vectors.sparkSession
    names = [c for c in keep if c.lower() not in ("code", "error")]
    rows = vectors.where(ready(F.col("embedding"))).select(
        *names, F.col("vec_id").alias("__id"), F.col("embedding").cast("array<double>").alias("vector"))
    longest = rows.agg(F.max(F.size("vector"))).first()[0]
    out = T.StructType([vectors.schema[c] for c in names] + [T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])
    if longest is None:
        return Compressed(spark.createDataFrame([], out), [np.zeros((0, 0), np.int64)] * parts)
    width = -(-longest // parts) * parts
    w = width // parts
    first = rows.orderBy(F.col("__id").asc_nulls_last(), "vector").limit(entries).select("vector").toArrow()
    start = integers(pa.concat_arrays(first.column("vector").chunks), width, scale)
    books = [start[:, j * w:(j + 1) * w].copy() for j in range(parts)]
    blocks = written(blocks_of(rows, names, width, parts, scale), "code-blocks")
    size = len(start)

    def summed(held) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total, count = np.zeros((parts, size, w), np.int64), np.zeros((parts, size), np.int64)
            known = [Codebook(b) for b in held.value]
            for batch in batches:
                for i in range(batch.num_rows):
                    points, orders = block_points(batch, i, width, parts)
                    for j, book in enumerate(known):
                        t, c = entry_sums(Tree(points[orders[j], j * w:(j + 1) * w], LEAF), book)
                        total[j] += t
                        count[j] += c
            flat = np.concatenate([total, count[..., None]], axis=2).ravel()
            used = np.flatnonzero(flat)
            yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(flat[used], pa.int64())], names=["cell", "s"])

        return blocks.select("points", "orders").mapInArrow(run, "cell long, s long").groupBy("cell").agg(F.sum("s").alias("s"))

    for _ in range(rounds):
        held = spark.sparkContext.broadcast(books)
        got = summed(held).toArrow()  # parts x entries x (components of a part + 1) rows at most
        flat = np.zeros(parts * size * (w + 1), np.int64)
        flat[got.column("cell").to_numpy()] = got.column("s").to_numpy()
        held.unpersist()
        flat = flat.reshape(parts, size, w + 1)
        books = [np.where(f[:, -1:] > 0, f[:, :-1] // np.maximum(f[:, -1:], 1), b) for f, b in zip(flat, books)]

    held = spark.sparkContext.broadcast(books)

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = [Codebook(b) for b in held.value]
        for batch in batches:
            for i in range(batch.num_rows):
                points, orders = block_points(batch, i, width, parts)
                code, error = np.empty((len(points), parts), np.uint8), np.zeros(len(points), np.int64)
                for j, book in enumerate(known):
                    own = points[orders[j], j * w:(j + 1) * w]
                    which, _ = nearest(Tree(own, LEAF), book)
                    code[orders[j], j] = which
                    error[orders[j]] += ((own - book.entries[which]) ** 2).sum(axis=1)
                said = code.tobytes().hex()
                texts = [said[k:k + 2 * parts] for k in range(0, len(said), 2 * parts)]
                kept = [batch.column(c)[i].values for c in names]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(texts, pa.string()), pa.array(error, pa.int64())], names=out.names)

    return Compressed(blocks.mapInArrow(coded, out), books)


def with_label_error(found: Compressed, label: str = "label") -> DataFrame:
    """``found.rows`` (written) with ``label_error``: the errors of all rows of the same label, nulls together."""
    rows = written(found.rows, "codes")
    sums = rows.groupBy(F.col(label).alias("__label")).agg(F.sum("error").alias("label_error"))
    return rows.join(small(sums), F.col(label).eqNullSafe(F.col("__label"))).drop("__label")
