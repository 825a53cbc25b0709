"""Filter interaction audit by decision diagrams.

Each document has a failure mask, one bit a filter.  A part's masks with their counts
make a decision diagram: one level a filter, an edge for passing and one for failing,
equal subdiagrams held once, and every node weighted by the counts below it.  The node
reached by passing the first ``i`` filters holds what is kept after them, and the weight
behind its failing edge is what the next filter removes, so the all-pass path of an order
gives that order's steps.  Every other order is reached by swapping two adjacent levels,
which touches the nodes of those two levels only and leaves all weights above as they are.

Documents are reduced to counts by (part, mask) in DataFrame jobs; a part has one row of
at most ``2^filters`` counts, whatever its share of the documents, and its diagram is
built in the task that holds that row.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import let, written

BLANKS = r"[\x20\x09-\x0D]+"
MEASURES = ["good", "toxic"]  # of documents lost, beside their number
MAX_FILTERS = 8  # orders are all listed: 8! of them at most


# --- the diagram ------------------------------------------------------------------------------

class Node:
    """``weight``: the counts below; ``kept`` and ``failed``: the nodes behind the two edges."""

    __slots__ = ("weight", "kept", "failed")

    def __init__(self, weight: tuple, kept: "Node | None" = None, failed: "Node | None" = None):
        self.weight, self.kept, self.failed = weight, kept or self, failed or self


class Diagram:
    """A diagram over masks of ``k`` filters, top level first in ``order``; ``swap`` exchanges two levels."""

    def __init__(self, counts: dict[int, tuple], k: int, width: int):
        self.order = list(range(k))
        self.nothing = Node((0,) * width)  # stands for every subdiagram without documents
        leaves: dict[tuple, Node] = {}
        below = {m: leaves.setdefault(tuple(w), Node(tuple(w))) for m, w in counts.items() if any(w)}
        self.levels: list[dict] = [{} for _ in range(k)]
        for level in reversed(range(k)):  # a mask's low bits are the filters of the levels above
            low = (1 << level) - 1
            prefixes = {m & low for m in below}
            below = {m: self.node(level, below.get(m, self.nothing), below.get(m | 1 << level, self.nothing))
                     for m in prefixes}
        self.root = below.get(0, self.nothing)

    def node(self, level: int, kept: Node, failed: Node) -> Node:
        """The node of ``level`` with these edges, made once."""
        if kept is self.nothing and failed is self.nothing:
            return self.nothing
        key = (id(kept), id(failed))
        found = self.levels[level].get(key)
        if found is None:
            weight = tuple(x + y for x, y in zip(kept.weight, failed.weight))
            found = self.levels[level][key] = Node(weight, kept, failed)
        return found

    def swap(self, level: int) -> None:
        """Exchange ``level`` and the one below it; nodes of ``level`` keep their weights and places."""
        upper = list(self.levels[level].values())
        self.levels[level], self.levels[level + 1] = {}, {}
        for n in upper:
            a, b = n.kept, n.failed
            n.kept, n.failed = (self.node(level + 1, a.kept, b.kept), self.node(level + 1, a.failed, b.failed))
            self.levels[level][id(n.kept), id(n.failed)] = n
        self.order[level], self.order[level + 1] = self.order[level + 1], self.order[level]

    def steps(self) -> Iterator[tuple[int, tuple, tuple]]:
        """``(filter, kept, removed)`` along the all-pass path."""
        at = self.root
        for f in self.order:
            yield f, at.kept.weight, at.failed.weight
            at = at.kept


def adjacent_swaps(k: int) -> list[int]:
    """Upper positions of the ``k! - 1`` neighbour swaps that lead through every order of ``k`` things.

    The last thing sweeps from end to end; between two sweeps the others make their next swap.
    """
    if k < 2:
        return []
    out, down = [], True
    inner = adjacent_swaps(k - 1)
    for i in range(len(inner) + 1):
        out += reversed(range(k - 1)) if down else range(k - 1)
        if i < len(inner):
            out.append(inner[i] + down)  # a thing swept to the front shifts the others by one
        down = not down
    return out


def audit_part(counts: dict[int, tuple], k: int, width: int) -> list[tuple]:
    """``(order, step, filter, kept, removed, redundant, unique, lost measures, shapley)`` of all orders and steps.

    A filter put first removes all it fails; put last, it removes what fails it alone.
    """
    diagram = Diagram(counts, k, width)
    paths = [(list(diagram.order), list(diagram.steps()))]
    for level in adjacent_swaps(k):
        diagram.swap(level)
        paths.append((list(diagram.order), list(diagram.steps())))
    fails, unique, shapley = [0] * k, [0] * k, [0] * k
    for order, steps in paths:
        fails[order[0]], unique[order[-1]] = steps[0][2][0], steps[-1][2][0]
        for f, _, removed in steps:
            shapley[f] += removed[0]
    return [(order, i + 1, f, kept[0], removed[0], fails[f] - removed[0], unique[f], removed[1:], shapley[f])
            for order, steps in paths for i, (f, kept, removed) in enumerate(steps)]


def audit(cells: DataFrame, filters: str, measures: list[str] = MEASURES) -> DataFrame:
    """All orders of ``filters`` (one letter each) applied to each part, a row a step.

    ``cells`` holds ``part, mask, n`` and the ``measures``, summed by part and mask (bit
    ``i`` set: the ``i``-th filter fails); masks absent count nothing.  Returns ``part,
    filter_order, step, filter, kept, removed, redundant, unique_fails``, ``<measure>_lost``
    and ``shapley``.  An empty table gives an empty result; a null part stays a part of its own.
    """
    k = len(filters)
    if not 1 <= k <= MAX_FILTERS:
        raise ValueError(f"1 to {MAX_FILTERS} filters, all orders of which are listed")
    parts = cells.groupBy("part").agg(F.collect_list(F.struct("mask", "n", *measures)).alias("cells"))
    lost = [f"{m}_lost" for m in measures]
    schema = T.StructType([parts.schema["part"], T.StructField("filter_order", T.StringType()),
                           T.StructField("step", T.IntegerType()), T.StructField("filter", T.StringType()),
                           *[T.StructField(c, T.LongType()) for c in ("kept", "removed", "redundant", "unique_fails", *lost, "shapley")]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                held = batch.column(1)[i].as_py()
                rows = audit_part({c["mask"]: (c["n"], *[c[m] for m in measures]) for c in held}, k, 1 + len(measures))
                order, step, which, kept, removed, redundant, unique, losses, shapley = zip(*rows)
                part = batch.column(0).take(pa.array([i] * len(rows), pa.int32()))
                longs = [kept, removed, redundant, unique, *zip(*losses), shapley] if measures else [kept, removed, redundant, unique, shapley]
                yield pa.RecordBatch.from_arrays(
                    [part, pa.array(["".join(filters[f] for f in o) for o in order]), pa.array(step, pa.int32()),
                     pa.array([filters[f] for f in which]), *[pa.array(x, pa.int64()) for x in longs]], names=schema.names)

    return parts.select("part", "cells").mapInArrow(run, schema)


# --- the five filters ---------------------------------------------------------------------------

def text_failures(text: Column) -> Column:
    """Bits 0 to 3 of a non-null text: under 50 words, repeated words, capitals, marks."""
    def judged(words: Column) -> Column:
        n, distinct = F.size(words).cast("long"), F.size(F.array_distinct(words)).cast("long")
        return F.when(n < 50, 1).otherwise(0) + F.when(distinct * 100 < n * 65, 2).otherwise(0)

    capitals = F.length(text) - F.length(F.regexp_replace(text, "[A-Z]+", ""))
    words = F.filter(F.split(text, BLANKS), lambda w: w != "")
    return (let(words, judged) + F.when(capitals.cast("long") * 100 > F.length(text).cast("long") * 5, 4).otherwise(0)
            + F.when(text.rlike("[#$%&*|]"), 8).otherwise(0)).cast("int")


COPY = 16  # bit 4: the text of a smaller doc_id


def failure_cells(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, mask, n, good, toxic``: documents by part (``source``; null: empty) and failure mask.

    Filters A to E are bits 0 to 4 (``text_failures`` and ``COPY``); ``good`` and ``toxic``
    count documents that some row of ``labels`` gives quality 1 or toxic 1.  A null text
    counts as empty.  Repeated rows are documents of their own, none a copy of the other;
    a null ``doc_id`` neither is a copy nor has any.  Texts of any length are read whole,
    texts are told apart by SHA-256.  Empty tables give an empty result; further columns
    of either table are ignored.

    Copies are folded before they meet: documents of one text, part and label are one row
    with their number and smallest id, and only those rows are joined with the smallest id
    of the text, so a text that a third of the documents share makes no hot key.
    """
    text = F.coalesce("text", F.lit(""))
    thin = written(docs.select("doc_id", F.coalesce("source", F.lit("")).alias("part"),
                               F.unhex(F.sha2(text.cast("binary"), 256)).alias("key"),
                               text_failures(text).alias("mask")), "audit-masks")
    known = labels.groupBy("doc_id").agg(F.max((F.col("quality") == 1).cast("int")).alias("good"),
                                         F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    named = ["key", "part", "mask", "good", "toxic"]
    ids = (thin.join(known, "doc_id", "left").fillna(0, ["good", "toxic"])
           .groupBy("doc_id", *named).agg(F.count("*").alias("n")))
    cells = written(ids.groupBy(*named).agg(
        F.sum("n").alias("n"), F.coalesce(F.sum(F.when(F.col("doc_id").isNull(), F.col("n"))), F.lit(0)).alias("unnamed"),
        F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n"))).alias("first")), "audit-cells")
    least = cells.groupBy("key").agg(F.min("first.doc_id").alias("least"))
    firsts = F.when(F.col("first.doc_id") == F.col("least"), F.col("first.n")).otherwise(0) + F.col("unnamed")
    counted = cells.join(least, "key").select(*named, F.col("n"), firsts.alias("once"))
    sums = counted.groupBy("part", "mask").agg(*[
        F.sum(amount * w).alias(f"{name}_{i}") for i, amount in enumerate((F.col("once"), F.col("n") - F.col("once")))
        for name, w in (("n", F.lit(1)), ("good", F.col("good")), ("toxic", F.col("toxic")))])
    split = F.explode(F.array(*[F.struct((F.col("mask") + bit).alias("mask"), *[F.col(f"{c}_{i}").alias(c) for c in ("n", *MEASURES)])
                                for i, bit in enumerate((0, COPY))])).alias("s")
    return sums.select("part", split).select("part", "s.*")


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The five filters of ``failure_cells`` in all 120 orders, a row a part, order and step (see ``audit``)."""
    return audit(failure_cells(docs, labels), "ABCDE")
