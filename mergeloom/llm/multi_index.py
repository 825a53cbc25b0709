"""Nearest neighbours by largest inner product from an inverted multi-index.

Both halves of a vector are quantised on their own, so ``K`` centroids a half make ``K^2``
cells.  A query scores the centroids of each half; cells are visited by the sum of the two
scores, best first, with a heap that holds one frontier cell a first-half centroid, until
enough entries are covered.  The entries of the visited cells are reranked by the inner
product of the original vectors in double precision.

How many entries are enough is a share of all rows, learned from a bounded sample: the
share at which a traversal of the sample covers ``recall`` of its true neighbours.  (The
``k`` nearest of ``n`` rows are about the ``k s / n`` nearest of a sample of ``s``.)

Every row is indexed.  Rows are dealt to blocks: first-half centroids in runs of about
``block`` entries, larger ones split by a hash, so a cell of any size stays whole but never
meets one task; the queries of a block are dealt by a hash likewise.  A query goes to a
block once, with the number of second-half centroids it visits for each first-half one.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import written
from .vector_codes import ready

SAMPLE = 16_384  # rows that the centroids and the share are learned from (twice as many at most)
TRIALS = 512  # of them, queries of the calibration
MAX_CENTROIDS = 1024  # of a half
PER_CELL = 16  # entries of a cell, as long as the centroids' bound allows
QUERY_BLOCK = 2048
AT_ONCE = 256  # queries scored at once in a task


def with_fields(df: DataFrame, **kinds: T.DataType) -> T.StructType:
    """The schema of ``df`` with these columns after its own."""
    return T.StructType([*df.schema.fields, *[T.StructField(name, kind) for name, kind in kinds.items()]])


# --- plain parts -------------------------------------------------------------------------------

def matrix(vectors: pa.Array, width: int) -> np.ndarray:
    """Rows in double precision; absent components at the end are 0."""
    lengths = np.diff(vectors.offsets.to_numpy())
    values = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if (lengths == width).all():
        return values.reshape(len(lengths), width)
    out = np.zeros((len(lengths), width))
    out[np.arange(width)[None, :] < lengths[:, None]] = values
    return out


def closest(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """The centroid at the least distance from each row."""
    return ((centroids * centroids).sum(axis=1)[None, :] - 2 * (x @ centroids.T)).argmin(axis=1)


def centroids_of(x: np.ndarray, k: int, rounds: int = 8, seed: int = 42) -> np.ndarray:
    """Lloyd's centroids of the sample's rows; unused ones stay where they began."""
    start = np.unique(x, axis=0)
    held = start[np.random.default_rng(seed).permutation(len(start))[:k]]
    for _ in range(rounds):
        own = closest(x, held)
        total = np.zeros_like(held)
        np.add.at(total, own, x)
        count = np.bincount(own, minlength=len(held))[:, None]
        held = np.where(count > 0, total / np.maximum(count, 1), held)
    return held


def second_orders(queries: np.ndarray, centroids: np.ndarray, h: int) -> np.ndarray:
    """The second half's centroids, best first, for each query: the same in the traversal and in the blocks."""
    return np.argsort(-np.stack([centroids @ q[h:] for q in queries]), axis=1, kind="stable")


def visit(first: np.ndarray, second: np.ndarray, counts: list[list[int]], want: float) -> tuple[np.ndarray, np.ndarray]:
    """``(order of the first half, for each of it how many of the second half's best)`` covering ``want`` entries.

    ``first`` and ``second`` are the scores of the halves' centroids; cells leave the heap
    by the sum of both, best first.
    """
    o1, o2 = np.argsort(-first, kind="stable"), np.argsort(-second, kind="stable")
    s1, s2, i1, i2 = first[o1].tolist(), second[o2].tolist(), o1.tolist(), o2.tolist()
    taken = [0] * len(s1)
    heap, got, pop, push = [(-s1[0] - s2[0], 0, 0)], 0, heapq.heappop, heapq.heappush
    while heap and got < want:
        _, a, b = pop(heap)
        got += counts[i1[a]][i2[b]]
        taken[a] = b + 1
        if b + 1 < len(s2):
            push(heap, (-s1[a] - s2[b + 1], a, b + 1))
        if b == 0 and a + 1 < len(s1):
            push(heap, (-s1[a + 1] - s2[0], a + 1, 0))
    return o1, np.array(taken)


def share_for(x: np.ndarray, books: list[np.ndarray], near: int, recall: float) -> float:
    """The share of the sample's entries whose traversal covers ``recall`` of the trials' nearest rows."""
    h = books[0].shape[1]
    cell = closest(x[:, :h], books[0]) * len(books[1]) + closest(x[:, h:], books[1])
    counts = np.bincount(cell, minlength=len(books[0]) * len(books[1]))
    need = []
    for q in range(min(TRIALS, len(x))):
        scores = x @ x[q]
        scores[q] = -np.inf
        best = np.argsort(-scores, kind="stable")[:min(near, len(x) - 1)]
        sums = ((books[0] @ x[q, :h])[:, None] + (books[1] @ x[q, h:])[None, :]).ravel()
        # entries of better cells, and of the cell itself
        order = np.argsort(-sums, kind="stable")
        covered = np.empty(len(order))
        covered[order] = np.cumsum(counts[order])
        need.append(covered[cell[best]] / len(x))
    need = np.concatenate(need) if need else np.ones(1)
    return float(np.quantile(need, recall, method="higher")) if len(need) else 1.0


def best_of(x: np.ndarray, ids: np.ndarray, scores: np.ndarray, q: np.ndarray, k: int, slack: float) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` best rows of one query by the exact product, ties by id: all rows that rounding could place there are tried."""
    found = np.flatnonzero(scores > -np.inf)
    if len(found) > k:
        least = np.partition(scores[found], len(found) - k)[len(found) - k]
        found = found[scores[found] >= least - slack]
    exact = (x[found] * q).sum(axis=1)
    order = np.lexsort((ids[found], -exact))[:k]
    return found[order], exact[order]


# --- the index -----------------------------------------------------------------------------------

@dataclass
class MultiIndex:
    """``table``: ``row, vec_id, v, i, j`` of every indexed row; ``books``: both halves' centroids."""

    table: DataFrame
    books: list[np.ndarray]
    counts: np.ndarray
    share: float
    width: int


def build(vectors: DataFrame, k: int = 20, recall: float = 0.95, per_cell: int = PER_CELL) -> MultiIndex | None:
    """Index ``(vec_id, embedding)`` rows for searches of ``k``; None where no row can take part.

    Rows whose vector is null, empty or zero or holds null or non-finite components take no
    part; shorter vectors are read as ending in zeros.  Ids may be null or repeat (each row
    is an entry), extra columns are ignored.  Centroids and the share come from a drawn
    sample of about ``SAMPLE`` rows; every row is indexed and counted.
    """
    spark = vectors.sparkSession
    rows = vectors.where(ready(F.col("embedding")) & F.exists("embedding", lambda x: x != 0)).select("vec_id", F.col("embedding").alias("v"))
    n, width = rows.agg(F.count("*"), F.max(F.size("v"))).first()
    if not n:
        return None
    drawn = rows.where(F.rand(42) < min(1.0, SAMPLE / n)).select("v").limit(2 * SAMPLE) if n > SAMPLE else rows.select("v")
    drawn = drawn.toArrow().column("v").chunks
    x = matrix(pa.concat_arrays(drawn), width) if drawn else np.ones((1, width))
    x = x[np.random.default_rng(7).permutation(len(x))]
    h = width // 2
    size = max(1, min(MAX_CENTROIDS, round(math.sqrt(n / per_cell)), len(x)))
    books = [centroids_of(x[:, :h], size), centroids_of(x[:, h:], size)]
    share = share_for(x, books, max(1, math.ceil(k * len(x) / n)), recall)
    held = spark.sparkContext.broadcast(books)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second = held.value
        for batch in batches:
            m = matrix(batch.column("v"), width)
            cells = [closest(m[:, :h], first), closest(m[:, h:], second)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *[pa.array(c, pa.int32()) for c in cells]], names=[*batch.schema.names, "i", "j"])

    spread = rows.mapInArrow(placed, with_fields(rows, i=T.IntegerType(), j=T.IntegerType()))
    table = written(spread.withColumn("row", F.monotonically_increasing_id()), "multi-index")
    counts = np.zeros((len(books[0]), len(books[1])), np.int64)
    for r in table.groupBy("i", "j").count().collect():  # MAX_CENTROIDS squared at most
        counts[r.i, r.j] = r["count"]
    return MultiIndex(table, books, counts, share, width)


def search(index: MultiIndex, queries: DataFrame, k: int = 20) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` best entries found for each row of ``queries``, which are rows of ``index.table``.

    A query's own row is no candidate (other rows of its id are).  Nearest first, ties by
    the smaller id, null ids last; all candidates are returned where there are fewer than ``k``.
    Repeated rows are queries and entries of their own; no query gives an empty result.
    """
    spark = queries.sparkSession
    books, counts, width = index.books, index.counts, index.width
    n, h, firsts, size = int(counts.sum()), index.width // 2, len(books[0]), len(books[1])
    want = max(math.ceil(index.share * n), k + 1)
    block = max(64, min((1 << 22) // max(1, width), max(1024, n // 24)))

    # runs of first-half centroids with about ``block`` entries; a larger one is split
    slabs, runs, splits, held = counts.sum(axis=1), [], [], 0
    for c in slabs.tolist():
        if not splits or held + c > block:
            splits.append(1)
            held = 0
        held += c
        runs.append(len(splits) - 1)
        splits[-1] = max(1, math.ceil(held / block))
    known = spark.sparkContext.broadcast((books, counts, np.array(runs)))
    asked_schema = with_fields(queries.select("row", "vec_id", "v"), run=T.IntegerType(), slabs=T.ArrayType(T.IntegerType()),
                               takes=T.ArrayType(T.IntegerType()))

    def probes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (first, second), counted, run_of = known.value
        cells = counted.tolist()
        for batch in batches:
            m = matrix(batch.column("v"), width)
            source, run, slab, take = [], [], [], []
            for at, q in enumerate(m):
                order, taken = visit(first @ q[:h], second @ q[h:], cells, want)
                order, taken = order[taken > 0], taken[taken > 0]
                for g in np.unique(run_of[order]).tolist():
                    own = run_of[order] == g
                    source.append(at)
                    run.append(g)
                    slab.append(order[own].tolist())
                    take.append(taken[own].tolist())
            kept = pa.Table.from_batches([batch]).take(pa.array(source, pa.int32())).combine_chunks()
            yield from pa.table([*kept.columns, pa.array(run, pa.int32()), pa.array(slab, pa.list_(pa.int32())),
                                 pa.array(take, pa.list_(pa.int32()))], names=asked_schema.names).to_batches()

    asked = written(queries.select("row", "vec_id", "v").mapInArrow(probes, asked_schema), "multi-index-probes")
    met = {r.run: math.ceil(r["count"] / QUERY_BLOCK) for r in asked.groupBy("run").count().collect()}  # MAX_CENTROIDS rows at most
    slab_rows = spark.createDataFrame([(i, g, splits[g], met[g]) for i, g in enumerate(runs) if g in met], "i int, run int, parts int, shares int")
    run_rows = spark.createDataFrame([(g, splits[g], s) for g, s in met.items()], "run int, parts int, shares int")
    part = F.pmod(F.xxhash64("row"), F.col("parts")).cast("int")
    share = F.pmod(F.xxhash64("row", F.lit(7)), F.col("shares")).cast("int")
    entries = index.table.join(F.broadcast(slab_rows), "i").select(
        "run", part.alias("part"), F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("share"), "row", "vec_id", "v", "i", "j")
    asking = asked.join(F.broadcast(run_rows), "run").select(
        "run", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), share.alias("share"), "row", "vec_id", "v", "slabs", "takes")
    last = np.iinfo(np.int64).max

    def rerank(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return pa.table({"row": pa.array([], pa.int64()), "query_id": pa.array([], pa.int64()), "best": pa.array([], pa.list_(pa.struct([("far", pa.float64()), ("vec_id", pa.int64())])))})
        cell = left.column("i").to_numpy() * size + left.column("j").to_numpy()
        order = np.argsort(cell, kind="stable")
        cell = cell[order]
        x = matrix(pa.concat_arrays(left.column("v").chunks), width)[order]
        row = left.column("row").to_numpy()[order]
        vec = left.column("vec_id").take(pa.array(order)).combine_chunks()
        ids = vec.fill_null(last).to_numpy()
        edges = np.append(np.flatnonzero(np.append(True, cell[1:] != cell[:-1])), len(cell))
        norm = np.sqrt((x * x).sum(axis=1).max())
        second, found = known.value[0][1], []
        qs = matrix(pa.concat_arrays(right.column("v").chunks), width)
        asked_row = right.column("row").to_numpy()
        slabs, takes = right.column("slabs").to_pylist(), right.column("takes").to_pylist()
        for at in range(0, len(qs), AT_ONCE):
            part = qs[at:at + AT_ONCE]
            place = np.empty((len(part), size), np.int64)  # of each second-half centroid in the query's order
            np.put_along_axis(place, second_orders(part, second, h), np.arange(size)[None, :], axis=1)
            depth = np.zeros((len(part), firsts), np.int64)
            for r in range(len(part)):
                depth[r, slabs[at + r]] = takes[at + r]
            scores = np.full((len(part), len(x)), -np.inf)
            for a, b in zip(edges[:-1], edges[1:]):
                i, j = divmod(int(cell[a]), size)
                rows = np.flatnonzero(place[:, j] < depth[:, i])
                if len(rows):
                    scores[rows, a:b] = part[rows] @ x[a:b].T
            scores[asked_row[at:at + AT_ONCE][:, None] == row[None, :]] = -np.inf
            for r in range(len(part)):
                found.append(best_of(x, ids, scores[r], part[r], k, 1e-12 * norm * float(np.sqrt(part[r] @ part[r]))))
        sizes = np.cumsum([0] + [len(f[0]) for f in found])
        flat = pa.StructArray.from_arrays([pa.array(np.concatenate([-f[1] for f in found])),
                                           vec.take(pa.array(np.concatenate([f[0] for f in found])))], names=["far", "vec_id"])
        return pa.table([right.column("row"), right.column("vec_id"), pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), flat)],
                        names=["row", "query_id", "best"])

    key = ["run", "part", "share"]
    found = asking.groupBy(*key).cogroup(entries.groupBy(*key)).applyInArrow(
        lambda queried, held: rerank(held, queried), "row long, query_id long, best array<struct<far: double, vec_id: long>>")
    merged = found.groupBy("row").agg(F.first("query_id").alias("query_id"), F.flatten(F.collect_list("best")).alias("best"))
    nearest = F.slice(F.array_sort(F.transform("best", lambda s: F.struct(s["far"], s["vec_id"].isNull().alias("unnamed"), s["vec_id"]))), 1, k)
    return merged.select("query_id", F.posexplode(nearest).alias("at", "s")).select(
        "query_id", (F.col("at") + 1).alias("rank"), F.col("s.vec_id").alias("vec_id"), (-F.col("s.far")).alias("score"))
