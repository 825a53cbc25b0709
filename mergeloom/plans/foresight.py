"""Long batches of merges for the trainer: foreseen on a sample of words, then checked over all of them.

The driver holds the most frequent words (a bounded number) and trains on them ahead: it
starts from the exact counts of the pair table's head and carries each on in proportion
to what the sample shows.  That gives the merges which probably come next, hundreds
where the sample holds most of the corpus.

One job then replays the foreseen merges over every word that holds one of their pairs
and sums, for each merge, the changes it makes to pair counts (the trainer over ``blocks``
of words, here one word a row).  From those the driver
knows the exact counts before every single merge, as far as they reach the head's
smallest count, and accepts the merges up to the first that was not the best pair at its
turn.  What is accepted is exactly the sequence of one merge at a time, however wrong the
sample is: the first merge is always right, since the head is exact.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.symbols import apply_merges_data, merge_pattern, string_array

Pair = tuple[str, str]


def split_symbols(syms: str) -> list[str]:
    return syms[1:-1].split("><")


def join_pair(symbols: list[str], left: str, right: str) -> list[str]:
    """``symbols`` with the pair joined, from the left, not overlapping."""
    out, i, n = [], 0, len(symbols)
    while i < n:
        if symbols[i] == left and i + 1 < n and symbols[i + 1] == right:
            out.append(left + right)
            i += 2
        else:
            out.append(symbols[i])
            i += 1
    return out


def first_difference(a: list[str], b: list[str]) -> int:
    return next(i for i, (x, y) in enumerate(zip(a, b)) if x != y)


@dataclass
class Merged:
    """What a merge did to the sample: the change of each pair's count, and what it takes to undo it."""

    pair: Pair
    change: dict[Pair, int]
    met: set[int]                       # the places of the pair before
    before: list[tuple[int, list[str]]]  # the words as they were


class WordPairs:
    """Weighted words whose pairs are counted and looked up as merges are applied and taken back.

    ``count`` is exact.  ``places`` holds every word that has a pair, and may hold words that
    have lost it since; these are passed over.
    """

    def __init__(self, words: Iterable[tuple[list[str], int]]):
        self.words, self.freqs = [], []
        self.count: dict[Pair, int] = defaultdict(int)
        self.places: dict[Pair, set[int]] = defaultdict(set)
        for at, (symbols, freq) in enumerate(words):
            self.words.append(symbols)
            self.freqs.append(freq)
            for pair in zip(symbols, symbols[1:]):
                self.count[pair] += freq
                self.places[pair].add(at)

    def merge(self, left: str, right: str) -> Merged:
        """Join the pair in every word; only the pairs beside a joined place are counted anew."""
        done = Merged((left, right), defaultdict(int), self.places.pop((left, right), set()), [])
        change = done.change
        for at in done.met:
            old, freq = self.words[at], self.freqs[at]
            new = join_pair(old, left, right)
            if len(new) == len(old):
                continue
            done.before.append((at, old))
            self.words[at] = new
            i = first_difference(old, new)
            once = len(new) + 1 == len(old)
            was, now = old[max(0, i - 1):i + 3 if once else None], new[max(0, i - 1):i + 2 if once else None]
            for pair in zip(was, was[1:]):
                change[pair] -= freq
            for pair in zip(now, now[1:]):
                change[pair] += freq
                self.places[pair].add(at)
        done.change = {pair: n for pair, n in change.items() if n}
        for pair, n in done.change.items():
            self.count[pair] += n
        return done

    def undo(self, done: Merged) -> None:
        """Take the last merge back."""
        for at, symbols in done.before:
            self.words[at] = symbols
        for pair, n in done.change.items():
            self.count[pair] -= n
        self.places[done.pair] |= done.met


def better(count: float, pair: Pair) -> tuple:
    """Merge order: the larger is merged first."""
    return (count, *pair)


class Foresight:
    """The sample of words, kept at the state of the accepted merges."""

    def __init__(self, words: Iterable[tuple[str, int]]):
        self.sample = WordPairs((split_symbols(s), f) for s, f in words)
        self.undone: list[Merged] = []

    def foresee(self, head: list[tuple[str, str, int]], floor: int, most: int) -> list[Pair]:
        """Up to ``most`` merges from the head's exact counts; at the first pair that may lie at ``floor`` it ends.

        The sample is left as if all of them were accepted; ``settle`` takes the rest back.
        """
        count = self.sample.count
        expected: dict[Pair, float] = {(l, r): float(n) for l, r, n in head}
        scale = {p: n / count[p] if count.get(p) else 0.0 for p, n in expected.items()}
        out: list[Pair] = []
        self.undone = []
        while len(out) < most and expected:
            pair = max(expected, key=lambda p: better(expected[p], p))
            if out and expected[pair] <= max(floor, 0):
                break
            own = scale.get(pair, 0.0)
            out.append(pair)
            done = self.sample.merge(*pair)
            self.undone.append(done)
            joined = pair[0] + pair[1]
            for p, d in done.change.items():
                if p in scale:
                    expected[p] = expected[p] + d * (scale[p] or own)
                elif joined in p:  # a pair that this merge makes, as frequent as the merge is
                    scale[p], expected[p] = own, d * own
            expected.pop(pair, None)
        return out

    def settle(self, accepted: int) -> None:
        """Take the foreseen merges behind the first ``accepted`` back."""
        for done in reversed(self.undone[accepted:]):
            self.sample.undo(done)
        self.undone = []


# --- over all words -------------------------------------------------------------------------------

def first_met(merges: list[Pair], known: set[str]) -> list[Pair]:
    """The merges that a word can meet first: the others need a symbol that one of the batch makes."""
    out, made = [], set()
    for l, r in merges:
        if l not in made and r not in made:
            out.append((l, r))
        if l + r not in known:
            made.add(l + r)
    return out


def holds_any(merges: list[Pair], known: set[str]):
    """Whether a word is touched by a batch of merges (``known``: the symbols before it)."""
    return F.exists(string_array([merge_pattern(l, r)[0] for l, r in first_met(merges, known)]), lambda p: F.contains(F.col("syms"), p))


def most_frequent(work: DataFrame, most: int) -> list[tuple[str, int]]:
    """``(syms, freq)`` of the ``most`` most frequent words, which ones at the least frequency being open."""
    left, least = most, 1
    for r in work.groupBy("freq").count().orderBy(F.desc("freq")).toLocalIterator():  # distinct frequencies: few
        least = r.freq
        if r["count"] >= left:
            break
        left -= r["count"]
    else:
        left = 0
    rows = work.where(F.col("freq") > least if left else F.col("freq") >= least).select("syms", "freq").collect()  # ``most`` at most
    return [tuple(r) for r in rows + (work.where(F.col("freq") == least).select("syms", "freq").limit(left).collect() if left else [])]


def replay(words: list[list[str]], freqs: list[int], merges: list[Pair]) -> Iterator[tuple[int, str, str, int]]:
    """``(step, l, r, change)`` of pair counts as the merges go over some words, which are rewritten in place.

    Words are looked up by the pairs of the merges, which are noted as they come up.
    """
    wanted = set(merges)
    places: dict[Pair, list[int]] = defaultdict(list)
    for at, symbols in enumerate(words):
        for pair in zip(symbols, symbols[1:]):
            if pair in wanted:
                places[pair].append(at)
    for step, (left, right) in enumerate(merges):
        joined, change = left + right, defaultdict(int)
        for at in dict.fromkeys(places.pop((left, right), ())):
            old, freq = words[at], freqs[at]
            new = words[at] = join_pair(old, left, right)
            if len(new) == len(old):
                continue  # another merge has taken the pair apart
            for pair in zip(old, old[1:]):
                change[pair] -= freq
            for pair in zip(new, new[1:]):
                change[pair] += freq
                if pair in wanted and joined in pair:
                    places[pair].append(at)
        yield from ((step, l, r, d) for (l, r), d in change.items() if d)


def replayed(work: DataFrame, merges: list[Pair], known: set[str]) -> DataFrame:
    """``step, l, r, n``: the summed change of each pair count by each merge, from the words that the batch touches.

    Clustered by the pair, as the counts are; a task sums over its words before the shuffle.
    """
    steps = list(merges)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = list(map(split_symbols, batch.column("syms").to_pylist()))
            rows = list(replay(words, batch.column("freq").to_pylist(), steps))
            step, left, right, n = zip(*rows) if rows else ([], [], [], [])
            yield pa.RecordBatch.from_arrays([pa.array(step, pa.int32()), pa.array(left, pa.string()), pa.array(right, pa.string()),
                                              pa.array(n, pa.int64())], names=["step", "l", "r", "n"])

    hits = work.where(holds_any(merges, known)).select("syms", "freq")
    found = hits.mapInArrow(run, "step int, l string, r string, n long").repartition("l", "r")
    return found.groupBy("l", "r", "step").agg(F.sum("n").alias("n"))


def touched_above(pairs: DataFrame, changes: DataFrame, floor: int) -> list[tuple[str, str, int, list[tuple[int, int]]]]:
    """Pairs that the batch touches and that exceed ``floor`` before, between or after its merges.

    ``(l, r, count before, changes by step)``; the floor is the head's smallest count, so
    there are about as many as the head has rows, and the pairs that the batch makes.
    """
    series = changes.groupBy("l", "r").agg(F.sort_array(F.collect_list(F.struct("step", "n"))).alias("steps"))  # one entry a merge at most
    sums = F.aggregate("steps", F.struct(F.coalesce("n0", F.lit(0)).cast("long").alias("c"), F.coalesce("n0", F.lit(0)).cast("long").alias("m")),
                       lambda s, x: F.struct((s["c"] + x["n"]).alias("c"), F.greatest(s["m"], s["c"] + x["n"]).alias("m")), lambda s: s["m"])
    held = series.join(pairs.select("l", "r", F.col("n").alias("n0")), ["l", "r"], "left")
    return [(x.l, x.r, int(x.n0 or 0), [(s.step, s.n) for s in x.steps]) for x in held.where(sums > floor).collect()]


def accepted_prefix(head: list[tuple[str, str, int]], touched: list[tuple], merges: list[Pair], floor: int) -> list[tuple[str, str, int]]:
    """The foreseen merges that were the best pair at their turn, with their counts then."""
    exact = {(l, r): n for l, r, n in head}
    exact.update({(l, r): n0 for l, r, n0, _ in touched})
    by_step: dict[int, list[tuple[Pair, int]]] = defaultdict(list)
    for l, r, _, steps in touched:
        for step, d in steps:
            by_step[step].append(((l, r), d))
    out = []
    for i, pair in enumerate(merges):
        best = max(exact, key=lambda p: better(exact[p], p))
        if best != pair or exact[best] <= max(floor, 0):
            break
        out.append((*pair, exact[best]))
        for p, d in by_step[i]:
            exact[p] += d
    return out or [tuple(head[0])]  # the head's first is the best pair, also where the head holds ties only


def counts_with(pairs: DataFrame, changes: DataFrame, accepted: int) -> DataFrame:
    """Pair counts after the first ``accepted`` merges; the counts stay where they are, clustered by the pair."""
    delta = changes.where(F.col("step") < accepted).groupBy("l", "r").agg(F.sum("n").alias("n"))
    return pairs.unionByName(delta).groupBy("l", "r").agg(F.sum("n").alias("n")).filter(F.col("n") > 0)


def words_with(work: DataFrame, merges: list[Pair], known: set[str]) -> DataFrame:
    """Working words after ``merges``: only those that hold one of the pairs are rewritten."""
    new = F.when(holds_any(merges, known), apply_merges_data(F.col("syms"), merges)).otherwise(F.col("syms"))
    return work.select(new.alias("syms"), "freq").filter(F.instr("syms", "><") > 0)
