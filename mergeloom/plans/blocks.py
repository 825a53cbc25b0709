"""Working words of the trainer in blocks: one row holds some ten thousand words as arrays of symbol numbers.

Spark deals out the blocks, sums what they give and shuffles the sums; inside a task a
merge goes over a whole block in a few array operations, so merges that touch most words
cost about as little as the others.  ``foresight.replayed`` and ``words_with`` are the same
steps with one word a row.

In a block the words stand one after the other, with ``BORDER`` before the first and behind
each; the order of the words is of no account.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .foresight import Pair, first_met

BORDER = -1
BLOCK_SYMBOLS = 1 << 18    # of the words of a block, one word at least
BLOCKS_PER_TASK = 32
SUMS_AT_ONCE = 1 << 20     # changes that a task holds before it adds them up
SCHEMA = "syms binary, freqs binary"


class Symbols:
    """Numbers of the symbols (hex); symbols that are spelled alike are one."""

    def __init__(self, names: Iterable[str]):
        self.names = list(dict.fromkeys(names))
        self.number = {name: i for i, name in enumerate(self.names)}

    def with_merges(self, merges: Iterable[Pair]) -> Symbols:
        return Symbols([*self.names, *(l + r for l, r in merges)])

    def numbered(self, merges: Iterable[Pair]) -> list[tuple[int, int, int]]:
        return [(self.number[l], self.number[r], self.number[l + r]) for l, r in merges]


# --- inside a task ----------------------------------------------------------------------

def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for batch in batches:
        for syms, freqs in zip(batch.column(0), batch.column(1)):
            yield np.frombuffer(syms.as_py(), np.int32), np.frombuffer(freqs.as_py(), np.int64)


def block_row(syms: np.ndarray, freqs: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([syms.astype(np.int32, copy=False).tobytes()], pa.binary()),
                                       pa.array([freqs.astype(np.int64, copy=False).tobytes()], pa.binary())], names=["syms", "freqs"])


def word_sizes(s: np.ndarray) -> np.ndarray:
    """Symbols of each word, and one for the border behind it."""
    return np.diff(np.flatnonzero(s == BORDER))


def touched_words(s: np.ndarray, merges: list[tuple[int, int, int]], n: int) -> np.ndarray:
    """For each word, whether it holds one of the pairs; ``n`` symbols are numbered."""
    lead, follow = np.zeros(n + 1, bool), np.zeros(n + 1, bool)  # a border reads the last entry
    lead[[l for l, _, _ in merges]], follow[[r for _, r, _ in merges]] = True, True
    at = np.flatnonzero(lead[s[:-1]] & follow[s[1:]])
    at = at[np.isin(s[at].astype(np.int64) * n + s[at + 1], np.array([l * n + r for l, r, _ in merges], np.int64))]
    borders = np.flatnonzero(s == BORDER)
    hit = np.zeros(len(borders) - 1, bool)
    hit[np.searchsorted(borders, at) - 1] = True
    return hit


def picked(s: np.ndarray, freqs: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The block of the marked words."""
    return np.append(np.int32(BORDER), s[1:][np.repeat(words, word_sizes(s))]), freqs[words]


def places(s: np.ndarray, left: int, right: int) -> np.ndarray:
    """Where the pair is joined: from the left of each word, not overlapping."""
    at = np.flatnonzero((s[:-1] == left) & (s[1:] == right))
    if left == right and len(at) > 1:
        begins = np.append(True, np.diff(at) != 1)
        at = at[(at - at[begins][np.cumsum(begins) - 1]) % 2 == 0]
    return at


def joined(s: np.ndarray, at: np.ndarray, made: int) -> tuple[np.ndarray, np.ndarray]:
    """``s`` with the symbols at ``at`` and behind them replaced by one, and which entries of ``s`` stay."""
    stay = np.ones(len(s), bool)
    stay[at + 1] = False
    s = s.copy()
    s[at] = made
    return s[stay], stay


def summed(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums (whole numbers) by key; sums of zero go."""
    if not len(keys):
        return keys, values
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    sums = np.add.reduceat(values[order], first)
    return keys[first][sums != 0], sums[sums != 0]


def pairs_at(s: np.ndarray, weight: np.ndarray, at: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Number (left times ``n`` plus right) and weight of the pairs that begin at ``at``."""
    left, right = s[at], s[at + 1]
    inside = (left != BORDER) & (right != BORDER)
    return left[inside].astype(np.int64) * n + right[inside], weight[at][inside]


def weights(s: np.ndarray, freqs: np.ndarray) -> np.ndarray:
    """The frequency of each entry's word."""
    return np.append(np.int64(0), np.repeat(freqs, word_sizes(s)))


def replay(s: np.ndarray, weight: np.ndarray, merges: list[tuple[int, int, int]], n: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(step, pairs, changes)``: what each merge that joins something does to the pair counts of a block."""
    for step, (left, right, made) in enumerate(merges):
        at = places(s, left, right)
        if not len(at):
            continue
        old = pairs_at(s, weight, np.unique(np.concatenate([at - 1, at, at + 1])), n)  # the pairs that a joined place takes part in
        s, stay = joined(s, at, made)
        weight = weight[stay]
        at = at - np.arange(len(at))
        new = pairs_at(s, weight, np.unique(np.concatenate([at - 1, at])), n)
        yield step, *summed(np.concatenate([old[0], new[0]]), np.concatenate([-old[1], new[1]]))


# --- over all blocks ----------------------------------------------------------------------

def packed(work: DataFrame, symbols: Symbols) -> DataFrame:
    """Blocks of the words ``(syms, freq)``; a symbol without a number raises."""
    known = pa.array(symbols.names, pa.string())

    def block(sizes: list[np.ndarray], ids: list[np.ndarray], freqs: list[np.ndarray]) -> pa.RecordBatch:
        ends = np.cumsum(np.concatenate(sizes).astype(np.int64) + 1)
        s = np.full(int(ends[-1]) + 1, BORDER, np.int32)
        inner = np.ones(len(s), bool)
        inner[0], inner[ends] = False, False
        s[inner] = np.concatenate(ids)
        return block_row(s, np.concatenate(freqs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes, ids, freqs = [], [], []
        for batch in batches:
            if not batch.num_rows:
                continue
            parts = pc.split_pattern(pc.utf8_slice_codeunits(batch.column("syms"), 1, -1), "><")
            found = pc.index_in(parts.flatten(), value_set=known)
            if found.null_count:
                raise ValueError("a word holds a symbol that the model does not have")
            sizes.append(np.asarray(pc.list_value_length(parts)))
            ids.append(np.asarray(found))
            freqs.append(np.asarray(batch.column("freq")))
            if sum(map(len, ids)) >= BLOCK_SYMBOLS:
                yield block(sizes, ids, freqs)
                sizes, ids, freqs = [], [], []
        if sizes:
            yield block(sizes, ids, freqs)

    return work.select("syms", "freq").mapInArrow(run, SCHEMA)


def unpacked(blocks: DataFrame, symbols: Symbols) -> DataFrame:
    """The words ``(syms, freq)`` of the blocks."""
    spelled = pa.array([f"<{name}>" for name in symbols.names], pa.string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for s, freqs in rows_of(batches):
            ends = np.append(0, np.cumsum(word_sizes(s) - 1)).astype(np.int32)
            words = pa.ListArray.from_arrays(pa.array(ends), spelled.take(pa.array(s[s != BORDER])))
            yield pa.RecordBatch.from_arrays([pc.binary_join(words, ""), pa.array(freqs)], names=["syms", "freq"])

    return blocks.mapInArrow(run, "syms string, freq long")


def block_pair_counts(blocks: DataFrame, symbols: Symbols) -> DataFrame:
    """``l, r, n``: the weighted pair counts of all words, clustered by the pair."""
    n, names = len(symbols.names), pa.array(symbols.names, pa.string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for s, freqs in rows_of(batches):
            codes, sums = summed(*pairs_at(s, weights(s, freqs), np.arange(len(s) - 1), n))
            yield pa.RecordBatch.from_arrays([names.take(pa.array(codes // n)), names.take(pa.array(codes % n)), pa.array(sums)],
                                             names=["l", "r", "n"])

    return blocks.mapInArrow(run, "l string, r string, n long").groupBy("l", "r").agg(F.sum("n").alias("n"))


def block_changes(blocks: DataFrame, merges: list[Pair], symbols: Symbols, known: set[str]) -> DataFrame:
    """``step, l, r, n``: the summed change of each pair count by each merge, clustered by the pair.

    ``symbols`` numbers what the merges make too.  A task sums over its blocks before the shuffle.
    """
    n, names = len(symbols.names), pa.array(symbols.names, pa.string())
    steps, first = symbols.numbered(merges), symbols.numbered(first_met(merges, known))

    def total(keys: list[np.ndarray], sums: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        return summed(np.concatenate([np.zeros(0, np.int64), *keys]), np.concatenate([np.zeros(0, np.int64), *sums]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, sums, size, least = [], [], 0, SUMS_AT_ONCE
        for s, freqs in rows_of(batches):
            hit = touched_words(s, first, n)
            if not hit.any():
                continue
            s, freqs = picked(s, freqs, hit)
            for step, codes, changes in replay(s, weights(s, freqs), steps, n):
                keys.append(codes + step * n * n)
                sums.append(changes)
                size += len(codes)
            if size >= least:
                keys, sums = ([x] for x in total(keys, sums))
                size = len(keys[0])
                least = max(SUMS_AT_ONCE, 2 * size)
        found, change = total(keys, sums)
        step, code = np.divmod(found, n * n)
        yield pa.RecordBatch.from_arrays([pa.array(step.astype(np.int32)), names.take(pa.array(code // n)), names.take(pa.array(code % n)),
                                          pa.array(change)], names=["step", "l", "r", "n"])

    found = blocks.mapInArrow(run, "step int, l string, r string, n long").repartition("l", "r")
    return found.groupBy("l", "r", "step").agg(F.sum("n").alias("n"))


def blocks_with(blocks: DataFrame, merges: list[Pair], symbols: Symbols, known: set[str]) -> DataFrame:
    """The blocks after ``merges``: only words that hold one of the pairs are rewritten; those of one symbol go."""
    n = len(symbols.names)
    steps, first = symbols.numbered(merges), symbols.numbered(first_met(merges, known))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for s, freqs in rows_of(batches):
            hit = touched_words(s, first, n)
            rest, rest_freqs = picked(s, freqs, ~hit)
            new, new_freqs = picked(s, freqs, hit)
            for left, right, made in steps:
                at = places(new, left, right)
                if len(at):
                    new, _ = joined(new, at, made)
            new, new_freqs = picked(new, new_freqs, word_sizes(new) > 2)
            if len(rest_freqs) + len(new_freqs):
                yield block_row(np.concatenate([rest, new[1:]]), np.concatenate([rest_freqs, new_freqs]))

    return blocks.mapInArrow(run, SCHEMA)
