"""SimHash near-duplicates with covering locality-sensitive hashing.

Fingerprints: ASCII letters lower-cased, words are runs without ASCII white space, and
the XXH64 hashes of all word shingles vote on each of 64 bits.  Links: structured bit
masks.  Every bit position carries a non-zero vector of ``radius + 1`` binary digits;
table ``v`` keeps the bits whose vector has an odd product with ``v``.  Two fingerprints
that differ in ``radius`` bits or fewer have differing positions whose vectors span at
most ``radius`` dimensions, so some non-zero ``v`` is orthogonal to all of them: its
table drops every differing bit and the pair meets there.  No link can be missed.

Buckets of at most ``pair_limit`` distinct fingerprints are compared in pairs.  Larger
ones take an exact linear way: each member names all values within half the radius of
itself, and members that name the same value are within the radius of one another, so a
link to the smallest of them keeps the components.  Exact copies are folded into one
fingerprint first, so a hot group never becomes pairs.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import add_columns, cut, cuts_before, guarded, text_chunks, written
from .components import connected_components

BITS = 64
CHARS_AT_ONCE = 1 << 20  # of one text, whose words are held at a time


def _votes(words: list[bytes], k: int, seed: int) -> tuple[np.ndarray, int]:
    """Votes for each bit of all runs of ``k`` words, and the number of runs."""
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.empty_like(ends)
    starts[0], starts[1:] = 0, ends[:-1] + 1
    n, digest = len(words) - k + 1, xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(line[a:b], seed) for a, b in zip(starts[:n].tolist(), ends[k - 1:].tolist())),
                         np.uint64, n)
    bits = np.unpackbits(hashes.view(np.uint8).reshape(n, 8), axis=1, bitorder="little")
    return bits.sum(axis=0, dtype=np.int64), n


def fingerprint(text: str | None, shingle: int = 3, seed: int = 42) -> int:
    """The 64-bit fingerprint of one text, unsigned; null and wordless texts give zero.

    Long texts are read in pieces; the last words of a piece begin the shingles of the next.
    """
    votes, total, words = np.zeros(BITS, np.int64), 0, []
    for a, b in cuts_before(text or "", CHARS_AT_ONCE, "[ \t-\r]"):
        words += text[a:b].encode("utf-8").lower().split()
        if len(words) >= shingle:
            got, n = _votes(words, shingle, seed)
            votes, total, words = votes + got, total + n, words[len(words) - shingle + 1:]
    if not total:
        if not words:
            return 0
        votes, total = _votes(words, len(words), seed)
    return int(np.packbits(votes * 2 > total, bitorder="little").view(np.uint64)[0])


def with_fingerprints(docs: DataFrame, shingle: int = 3, seed: int = 42, text: str = "text",
                      keep: list[str] | None = None) -> DataFrame:
    """Append ``fp`` (the fingerprint as a signed long) to every row; narrow."""

    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        out = np.empty(batch.num_rows, np.uint64)
        for first, texts in text_chunks(batch, text):
            for i, t in enumerate(texts, first):
                out[i] = fingerprint(t, shingle, seed)
        return [pa.array(out.view(np.int64))]

    return add_columns(docs, run, T.StructType([T.StructField("fp", T.LongType())]), keep)


def covering_masks(radius: int) -> list[int]:
    """The ``2^(radius+1) - 1`` bit masks (signed 64-bit values) of the covering tables."""
    n = (1 << (radius + 1)) - 1
    order = sorted(range(BITS), key=lambda i: xxhash.xxh64_intdigest(str(i), 7))
    vector = {bit: 1 + place % n for place, bit in enumerate(order)}
    masks = []
    for v in range(1, n + 1):
        mask = sum(1 << i for i in range(BITS) if bin(vector[i] & v).count("1") % 2)
        masks.append(mask - (1 << 64) if mask >> 63 else mask)
    return masks


def flips(most: int) -> list[int]:
    """All 64-bit values with at most ``most`` bits set, as signed longs."""
    out = [sum(1 << i for i in c) for k in range(most + 1) for c in combinations(range(BITS), k)]
    return [x - (1 << 64) if x >> 63 else x for x in out]


def hamming_links(fps: DataFrame, radius: int = 2, pair_limit: int = 64) -> DataFrame:
    """Links ``(u, v)`` between distinct fingerprints whose components are those of the radius graph.

    ``fps`` has one row per fingerprint, column ``fp``, cut from its lineage.  Each link
    joins fingerprints that differ in ``radius`` bits or fewer, or that both do from a
    chain of such; buckets over ``pair_limit`` give links to their smallest members only.
    """
    tables = F.array(*[F.struct(F.lit(i).alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("k"))
                       for i, m in enumerate(covering_masks(radius))])
    keyed = fps.select("fp", F.explode(tables).alias("b")).select("fp", "b.t", "b.k")
    shared = keyed.groupBy("t", "k").agg(F.count("*").alias("n")).where("n > 1")
    meets = cut(keyed.join(shared, ["t", "k"]))
    few = meets.where(F.col("n") <= pair_limit).select("t", "k", "fp")
    a, b = few.withColumnRenamed("fp", "u"), few.withColumnRenamed("fp", "v")
    pairs = a.join(b, ["t", "k"]).where((F.col("u") > F.col("v"))
                                        & (F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= radius)).select("u", "v")
    hot = meets.where(F.col("n") > pair_limit).select("fp").distinct()
    near, far = radius // 2, radius - radius // 2
    sides = [("a", near)] if near == far else [("a", near), ("b", far)]
    named = None
    for side, most in sides:
        part = hot.select("fp", F.explode(F.array(*[F.lit(x) for x in flips(most)])).alias("x")).select(
            "fp", F.col("fp").bitwiseXOR(F.col("x")).alias("y"), F.lit(side).alias("side"))
        named = part if named is None else named.unionByName(part)
    stars = (named.groupBy("y").agg(F.min("fp").alias("v"), F.count("*").alias("n"),
                                    F.count_distinct("side").alias("sides") if len(sides) > 1 else F.lit(1).alias("sides"))
             .where((F.col("n") > 1) & (F.col("sides") == len(sides))))
    linear = named.join(stars.select("y", "v"), "y").select(F.col("fp").alias("u"), "v").where("u <> v")
    return pairs.unionByName(linear)


def simhash_groups(thin: DataFrame, radius: int = 2, pair_limit: int = 64) -> DataFrame:
    """``(fp, component_id)`` for every fingerprint of ``thin`` (columns ``doc_id``, ``fp``).

    ``component_id`` is the smallest ``doc_id`` reachable over links; null ids are passed
    over, and a group with no other id gets null.
    """
    fps = cut(thin.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = connected_components(hamming_links(fps, radius, pair_limit))
    linked = fps.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp"))
    least = linked.groupBy("root").agg(F.min("least").alias("component_id"))
    return linked.join(least, "root").select("fp", "component_id")


def simhash_components(docs: DataFrame, shingle: int = 3, radius: int = 2, seed: int = 42) -> DataFrame:
    """One row per document: ``doc_id``, ``fp`` and ``component_id``.

    Null, empty and wordless texts have fingerprint zero and link like any other;
    repeated rows get equal results; an empty table gives an empty result; texts of
    any length are read whole, in pieces.  Other columns of ``docs`` are not carried.
    """
    thin = cut(with_fingerprints(docs.select("doc_id", "text"), shingle, seed, keep=["doc_id"]))
    return thin.join(simhash_groups(thin, radius), "fp", "left").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, shingle: int = 3, radius: int = 2, seed: int = 42) -> DataFrame:
    """The documents with one row of each near-duplicate group, all columns as they came.

    The row with the smallest ``doc_id`` stays (a null id after all others); of repeated
    rows with that id, one.  Texts are fingerprinted once, into a written table.
    """
    return guarded(docs, ["fp", "__row"], lambda rows: _keep_one(rows, shingle, radius, seed))


def _keep_one(docs: DataFrame, shingle: int, radius: int, seed: int) -> DataFrame:
    marked = with_fingerprints(docs.withColumn("__row", F.monotonically_increasing_id()), shingle, seed)
    table = written(marked, "simhash")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", F.col("__row").alias("row")))
    fps = cut(table.groupBy("fp").agg(first.alias("first")))
    roots = connected_components(hamming_links(fps.select("fp"), radius))
    linked = fps.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp"))
    kept = linked.groupBy("root").agg(F.min("first").alias("first")).select(F.col("first.row").alias("__row"))
    return table.join(kept, "__row", "left_semi")
