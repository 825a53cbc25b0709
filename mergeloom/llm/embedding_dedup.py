"""Embedding near-duplicates by collision-counting projections.

Unit vectors with cosine ``c`` lie ``d = sqrt(2 - 2c)`` apart, and the distance of their
projections on a Gaussian direction is normal with deviation ``d``.  Each of ``m``
one-dimensional projections of a block is sorted; a query's window is the run of ranks
within ``width`` of its own projection; the windows in which a pair collides are counted.
For a pair at the threshold that count is binomial, so the least count to pass is the
largest one that loses such a pair with probability ``miss`` at most (closer pairs
collide more often).  Pairs that pass are verified by their cosine in double precision.

Vectors are compared only with equal label and length.  Vectors that are equal once
scaled are folded first.  Each group is cut into blocks along its first projection, and
by a hash where that one ties; two blocks meet only if their ranges come within ``d`` of
each other, which no link can exceed.  A task holds two
blocks and returns, for each vector, its number of links and the smallest member of its
local component: links are never emitted as pairs, however dense a group is.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut
from .components import connected_components

QUERIES_AT_ONCE = 128


def least_count(m: int, cosine: float, width: float, miss: float) -> int:
    """The largest count that a pair at ``cosine`` falls short of with probability ``miss`` at most."""
    d = math.sqrt(max(1e-12, 2 - 2 * cosine))
    p = math.erf(width / d / math.sqrt(2))
    below, k = 0.0, 0
    while k <= m:
        below += math.comb(m, k) * p ** k * (1 - p) ** (m - k)
        if below > miss:
            return k
        k += 1
    return m


def collisions(a: np.ndarray, b: np.ndarray, width: float) -> np.ndarray:
    """Counts, for queries ``a`` against ``b`` (rows: projections), of windows in which they collide."""
    m, n = b.shape
    kind = np.uint16 if n < 1 << 16 else np.uint32
    counts = np.zeros((a.shape[1], n), np.uint8 if m < 256 else np.uint16)
    for j in range(m):
        order = np.argsort(b[j], kind="stable")
        rank = np.empty(n, kind)
        rank[order] = np.arange(n, dtype=kind)
        line = b[j][order]
        low = np.searchsorted(line, a[j] - width, "left")
        size = np.searchsorted(line, a[j] + width, "right") - low
        counts += (rank[None, :] - low.astype(kind)[:, None]) < size.astype(kind)[:, None]
    return counts


def block_links(a: np.ndarray, b: np.ndarray, weight_a: np.ndarray, weight_b: np.ndarray, same: bool,
                directions: np.ndarray, cosine: float, width: float, need: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links between two blocks of unit vectors: weighted counts for each side and local roots (a's rows first)."""
    pa, pb = directions @ a.T, directions @ b.T
    root = np.arange(len(a) + (0 if same else len(b)))
    shift = 0 if same else len(a)
    count_a, count_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
    for at in range(0, len(a), QUERIES_AT_ONCE):
        part = slice(at, min(len(a), at + QUERIES_AT_ONCE))
        passed = collisions(pa[:, part], pb, width) >= need
        if same:
            passed[np.arange(part.stop - at), np.arange(at, part.stop)] = False
        rows = np.flatnonzero(passed.any(axis=1))
        if not len(rows):
            continue
        linked = passed[rows] & (a[part][rows] @ b.T >= cosine)
        count_a[at + rows] += linked @ weight_b
        if not same:
            count_b += weight_a[at + rows] @ linked
        for r, line in zip(rows.tolist(), linked):
            met = np.flatnonzero(line)
            if len(met):
                roots = np.unique(np.append(root[met + shift], root[at + r]))
                if len(roots) > 1:
                    root[np.isin(root, roots)] = roots[0]
    return count_a, count_b, root


def blocks_of(reps: DataFrame, block: int, seed: int) -> DataFrame:
    """``node, g, label, v, copies, p, block``: the vectors dealt to blocks of about ``block`` within their group ``g``.

    A group is cut at equal shares of its first projection; a range that still holds more
    than ``block`` and a quarter, as where projections tie, is dealt to blocks by a hash.
    """
    # blocks along the first projection, a unit direction, so that d bounds its differences
    lead = F.expr(f"aggregate(transform(sequence(1, size(v)), i -> "
                  f"v[i - 1] * cos(i * {seed % 97 + 1} * 0.7548776662)), 0D, (s, x) -> s + x)")
    norm = F.expr("sqrt(aggregate(v, 0D, (s, x) -> s + x * x))")
    unit = F.expr(f"sqrt(aggregate(sequence(1, size(v)), 0D, (s, i) -> s + power(cos(i * {seed % 97 + 1} * 0.7548776662), 2)))")
    placed = cut(reps.select("node", "g", "label", "v", "copies", (lead / norm / unit).alias("p")))
    groups = placed.groupBy("g").agg(F.count("*").alias("n"), F.percentile_approx(
        "p", F.array(*[F.lit(i / 1024) for i in range(1, 1024)]), F.lit(10_000)).alias("q"))
    # every group: cuts at equal shares, about ``block`` vectors apart and 1/1024 of the group at least
    groups = groups.withColumn("parts", F.greatest(F.lit(1), F.ceil(F.col("n") / block))).withColumn(
        "ranges", F.least("parts", F.lit(1024))).withColumn(
        "cuts", F.expr("filter(transform(q, (x, i) -> struct(floor((i + 1) * ranges / 1024) > floor(i * ranges / 1024) as c, x)), "
                       "s -> s.c).x"))
    cuts = cut(groups.select("g", "cuts"))
    placed = cut(placed.join(cuts, "g").withColumn("range", F.expr("size(filter(cuts, x -> x < p))")).drop("cuts"))
    crowded = cut(placed.groupBy("g", "range").agg(F.count("*").alias("n")).where(F.col("n") > 1.25 * block)
                  .select("g", "range", F.ceil(F.col("n") / block).alias("sub")))
    sub = F.coalesce("sub", F.lit(1))
    placed = placed.join(crowded, ["g", "range"], "left").withColumn(
        "block", F.col("range").cast("long") * (1 << 32) + F.pmod(F.xxhash64("node"), sub)).drop("sub", "range")
    return cut(placed)


def near_duplicates(vectors: DataFrame, cosine: float = 0.93, projections: int = 64, miss: float = 1e-7,
                    block: int = 2048, seed: int = 42) -> DataFrame:
    """One row per vector: ``vec_id, n_links, component_id, kept`` for ``(vec_id, embedding, label)``.

    ``n_links`` counts the other rows linked directly; ``component_id`` is the smallest
    ``vec_id`` reachable, the row's own included; ``kept`` tells whether they are equal.
    Rows with a null label, or with a null, empty or zero vector or one holding nulls or
    non-finite values, link with nothing and are their own component.  Vectors of
    different lengths never link.  Repeated rows link with each other; null ids are
    passed over in the minimum; an empty table gives an empty result; extra columns are
    not carried; vectors of any length are compared whole.
    """
    sound = (F.col("label").isNotNull() & F.col("embedding").isNotNull()
             & ~F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
             & F.exists("embedding", lambda x: x != 0))
    # scaled by the largest component, so that squares neither overflow nor vanish, and multiples that
    # scale to the same values (they have one unit vector) are folded like copies
    scaled = F.zip_with("embedding", F.array_repeat(F.array_max(F.transform("embedding", F.abs)), F.size("embedding")), lambda x, m: x / m)
    tagged = vectors.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("embedding")).withColumn(
        "sound", F.coalesce(sound, F.lit(False))).withColumn("v", F.when(F.col("sound"), scaled)).withColumns({
            "k1": F.when(F.col("sound"), F.xxhash64(F.lit(1), "label", "v")),
            "k2": F.when(F.col("sound"), F.xxhash64(F.lit(2), "label", "v"))})
    reps = (tagged.where("sound").groupBy("k1", "k2")
            .agg(F.first("label").cast("string").alias("label"), F.first("v").alias("v"),
                 F.count("*").alias("copies"), F.min("vec_id").alias("least"))
            .withColumn("g", F.xxhash64("label", F.size("v"))))
    reps = cut(reps.withColumn("node", F.monotonically_increasing_id()))
    d = math.sqrt(2 - 2 * cosine)
    width = 2 * d
    need = least_count(projections, cosine, width, miss)
    placed = blocks_of(reps, block, seed)
    edges = placed.groupBy("g", "block").agg(F.min("p").alias("low"), F.max("p").alias("high"))
    a = edges.select("g", F.col("block").alias("x"), F.col("low").alias("xl"), F.col("high").alias("xh"))
    b = edges.select("g", F.col("block").alias("y"), F.col("low").alias("yl"), F.col("high").alias("yh"))
    meets = cut(a.join(b, "g").where(f"x <= y and yl <= xh + {d * 1.000001} and xl <= yh + {d * 1.000001}")
                .select("g", "x", "y"))
    left = placed.join(meets.withColumn("block", F.col("x")), ["g", "block"]).select(
        "g", "x", "y", F.lit(0).alias("side"), "node", "v", "copies")
    right = placed.join(meets.where("x < y").withColumn("block", F.col("y")), ["g", "block"]).select(
        "g", "x", "y", F.lit(1).alias("side"), "node", "v", "copies")

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["side", "node"])
        first, second = pdf[pdf.side == 0], pdf[pdf.side == 1]
        same = len(second) == 0
        if same:
            second = first
        va, vb = np.array(first.v.tolist(), np.float64), np.array(second.v.tolist(), np.float64)
        va /= np.linalg.norm(va, axis=1, keepdims=True)
        vb /= np.linalg.norm(vb, axis=1, keepdims=True)
        directions = np.random.default_rng(seed).standard_normal((projections, va.shape[1]))
        na, nb, root = block_links(va, vb, first.copies.to_numpy(), second.copies.to_numpy(), same,
                                   directions, cosine, width, need)
        node = first.node.to_numpy() if same else np.concatenate([first.node.to_numpy(), second.node.to_numpy()])
        n = na if same else np.concatenate([na, nb])
        return pd.DataFrame({"node": node, "n": n, "root": node[root]})[lambda x: x.n > 0]

    found = cut(left.unionByName(right).groupBy("g", "x", "y").applyInPandas(compare, "node long, n long, root long"))
    roots = connected_components(found.select(F.col("node").alias("u"), F.col("root").alias("v")))
    linked = reps.select("k1", "k2", "node", "copies", "least").join(
        found.groupBy("node").agg(F.sum("n").alias("n")), "node", "left").join(roots, "node", "left").withColumn(
        "root", F.coalesce("root", "node"))
    least = linked.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = linked.join(least, "root").select(
        "k1", "k2", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id")
    out = tagged.select("vec_id", "sound", "k1", "k2")
    joined = out.where("sound").join(classes, ["k1", "k2"]).select("vec_id", "n_links", "component_id")
    alone = out.where("not sound").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return joined.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
