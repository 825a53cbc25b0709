"""Rank encoding (I2) of many words at once, in arrays.

The words of one length are the rows of a matrix of token ids; a second matrix holds the
rank of every adjacent pair.  A step takes the longest words: each merges one pair and so
becomes one of the words that are one symbol shorter, where it meets the words that had
that length from the start.  A word without a ranked pair is finished.  Only the two pairs
that a merge creates are looked up, by binary search in the sorted pairs.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np

UNRANKED = np.iinfo(np.int32).max
BLOCK_BYTES = 1 << 18  # of words that advance together


class PairTable:
    """Ranked pairs as arrays: keys ``left << 32 | right`` in order, and the id that each rank makes."""

    def __init__(self, ranks: Mapping[tuple[bytes, bytes], int], ids: Mapping[bytes, int]):
        keys = np.array([ids[l] << 32 | ids[r] for l, r in ranks], np.int64)
        rank = np.array(list(ranks.values()), np.int32)
        order = np.argsort(keys)
        # a last key above all others, so that every search ends at a key
        self.keys = np.append(keys[order], np.iinfo(np.int64).max)
        self.rank = np.append(rank[order], np.int32(UNRANKED))
        self.made = np.zeros(int(rank.max(initial=-1)) + 1, np.int32)
        self.made[rank] = np.array([ids[l + r] for l, r in ranks], np.int32)
        self.byte_ids = np.array([ids.get(bytes([b]), -1) for b in range(256)], np.int32)
        left, right = np.divmod(np.arange(1 << 16), 256)
        self.byte_ranks = self.ranks_of(self.byte_ids[left], self.byte_ids[right]).reshape(256, 256)

    def ranks_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair of ids, ``UNRANKED`` where it has none."""
        want = left.astype(np.int64) << 32 | right
        at = np.searchsorted(self.keys, want)
        return np.where(self.keys[at] == want, self.rank[at], np.int32(UNRANKED))


def bpe_rank_words(words: Sequence[bytes], table: PairTable) -> list[list[int]]:
    """Ids of each word: the lowest-ranked pair goes first, all its places from the left.

    Equal to the heap of one word at a time.  Empty words have no ids; a byte that is no
    token raises ``KeyError``.
    """
    out: list[list[int]] = [[] for _ in words]
    size = np.fromiter(map(len, words), np.int64, len(words))
    order = np.argsort(-size, kind="stable")
    ends = np.cumsum(size[order])
    a = 0
    while a < len(order):  # blocks hold words of similar lengths, one word at least
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + BLOCK_BYTES, side="right")))
        _encode_block(words, order[a:b], size[order[a:b]], table, out)
        a = b
    return out


def _encode_block(words: Sequence[bytes], rows: np.ndarray, size: np.ndarray, table: PairTable,
                  out: list[list[int]]) -> None:
    """Encode the words numbered ``rows``, the longest first, into ``out``."""
    raw = np.frombuffer(b"".join([words[i] for i in rows.tolist()]), np.uint8)
    if len(raw) == 0:
        return
    if (table.byte_ids[raw] < 0).any():
        raise KeyError(bytes(raw[table.byte_ids[raw] < 0][:1]))
    length = int(size[0])
    ids, rank = np.zeros((0, length), np.int32), np.zeros((0, length - 1), np.int32)
    row, last = np.zeros(0, np.int64), np.zeros(0, np.int32)  # word of a row, rank that it merged last
    taken = at = 0
    while length and (len(row) or taken < len(rows)):
        n = int(np.searchsorted(-size, -length, side="right")) - taken
        if n:  # words of this length from the start
            fresh = raw[at:at + n * length].reshape(n, length)
            ids = np.concatenate([ids, table.byte_ids[fresh]])
            rank = np.concatenate([rank, table.byte_ranks[fresh[:, :-1], fresh[:, 1:]]])
            row = np.concatenate([row, rows[taken:taken + n]])
            last = np.concatenate([last, np.full(n, -1, np.int32)])
            taken, at = taken + n, at + n * length
        if length == 1:
            _finish(row, ids, out)
            return
        place = rank.argmin(1)
        best = rank[np.arange(len(row)), place]
        stuck = best == UNRANKED
        if stuck.any():
            _finish(row[stuck], ids[stuck], out)
            go = ~stuck
            ids, rank, row, last, place, best = ids[go], rank[go], row[go], last[go], place[go], best[go]
        # a merge may create a pair of a lower rank; the places left of the pair before go first
        early = np.flatnonzero(best < last)
        if len(early):
            left_over = rank[early] == last[early, None]
            early, left_over = early[left_over.any(1)], left_over[left_over.any(1)]
            place[early], best[early] = left_over.argmax(1), last[early]
        made, last = table.made[best], best
        line, col = np.arange(len(row)), np.arange(length - 1)
        before = col <= place[:, None]
        ids = np.where(before, ids[:, :-1], ids[:, 1:])
        ids[line, place] = made
        rank = np.where(before[:, :-1], rank[:, :-1], rank[:, 1:])
        x = np.flatnonzero(place > 0)
        rank[x, place[x] - 1] = table.ranks_of(ids[x, place[x] - 1], made[x])
        x = np.flatnonzero(place < length - 2)
        rank[x, place[x]] = table.ranks_of(made[x], ids[x, place[x] + 1])
        length -= 1


def _finish(row: np.ndarray, ids: np.ndarray, out: list[list[int]]) -> None:
    for i, found in zip(row.tolist(), ids.tolist()):
        out[i] = found
