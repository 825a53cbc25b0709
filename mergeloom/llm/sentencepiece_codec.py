"""SentencePiece encoding and decoding by batched Viterbi over numpy arrays.

The distinct words of a batch are laid out in one code point array.  Substring hashes
(differences of a running polynomial) of every start and length probe the sorted keys of
the pieces, behind a bit table that turns most probes away.  Words of equal length then
advance together: at each end position one vectorised maximum over the piece lengths
stores score and backpointer for all of them.  Ids are read back along the pointers.

Text without blanks makes long words.  They are cut, exactly, between characters that no
piece holds side by side.  A stretch that is still long is dealt to windows of equal
length, which advance together, once for each of the few places at which a path can enter
them; the entries are then chosen window by window.

A piece score is the model file's own; the best segmentation is the one with the largest
sum (ties: the longer last piece).  Characters without a piece become byte pieces, or the
unknown piece where the model has none, at the usual penalty below the lowest score.
"""

from __future__ import annotations

import re
import struct
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import add_columns, cuts_before, spans_of, text_chunks

# --- fixed values of the model file format ---------------------------------------------
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
BLANK = "▁"
UNKNOWN_PENALTY = 10.0
HASH_BASE = np.uint64(0x9E3779B97F4A7C15)
WORD_AT_ONCE = 1 << 16
IDS_AT_ONCE = 1 << 18
NO_CHAR = 0x1FFFFF    # fills words up to their batch's length; no piece holds it
BATCH_LENGTHS = (32, 48, 64, 96, 128)  # of words above 24 characters
LONG_WORD = 128       # characters from which a word is cut, and of a window
STRETCH_AT_ONCE = 1 << 16  # characters of a stretch whose windows advance together
CHUNK_BYTES = 1 << 22  # text whose words are encoded together


def _fields(data: bytes):
    """``(number, value)`` of the top-level fields of a protocol buffer message."""
    at = 0

    def varint():
        nonlocal at
        shift = out = 0
        while True:
            byte = data[at]
            at += 1
            out |= (byte & 0x7F) << shift
            shift += 7
            if byte < 0x80:
                return out

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
        elif kind == 2:
            n = varint()
            yield key >> 3, data[at:at + n]
            at += n
        else:
            n = 4 if kind == 5 else 8
            yield key >> 3, data[at:at + n]
            at += n


@dataclass
class PieceModel:
    """Pieces of a model file, ready for probing."""
    pieces: list[str]
    scores: np.ndarray
    types: np.ndarray
    dummy_prefix: bool = True
    squeeze_blanks: bool = False
    keys: np.ndarray = field(init=False)
    key_ids: np.ndarray = field(init=False)
    bits: np.ndarray = field(init=False)
    pairs: np.ndarray = field(init=False)
    longest: int = field(init=False)
    byte_ids: np.ndarray = field(init=False)
    unknown_id: int = field(init=False)
    unknown_score: float = field(init=False)

    def __post_init__(self):
        plain = [i for i, t in enumerate(self.types) if t in (NORMAL, USER_DEFINED) and self.pieces[i]]
        for i in plain:
            if BLANK in self.pieces[i].lstrip(BLANK):
                raise ValueError(f"piece {self.pieces[i]!r} holds a blank behind a character: words can't be cut there")
        self.longest = max((len(self.pieces[i]) for i in plain), default=1)
        hashes = np.array([int(hash_text(self.pieces[i])) for i in plain], np.uint64)
        order = np.argsort(hashes, kind="stable")
        self.keys, self.key_ids = hashes[order], np.array(plain, np.int32)[order]
        if len(np.unique(self.keys)) != len(self.keys):
            raise ValueError("two pieces share a key; choose another hash base")
        self.bits = np.zeros(1 << 20, bool)
        self.bits[self.keys >> np.uint64(44)] = True
        self.pairs = np.array(sorted({ord(a) << 21 | ord(b) for i in plain for a, b in zip(self.pieces[i], self.pieces[i][1:])}), np.int64)
        top = max((self.scores[i] for i in plain), default=0.0)
        low = min((self.scores[i] for i in plain if self.types[i] == NORMAL), default=0.0)
        self.scores = np.array(self.scores, np.float64)
        for i in plain:
            if self.types[i] == USER_DEFINED:
                self.scores[i] = len(self.pieces[i]) * top - 0.1
        self.unknown_score = low - UNKNOWN_PENALTY
        self.unknown_id = next((i for i, t in enumerate(self.types) if t == UNKNOWN), 0)
        self.byte_ids = np.full(256, -1, np.int32)
        for i, t in enumerate(self.types):
            if t == BYTE:
                self.byte_ids[int(self.pieces[i][3:5], 16)] = i


def read_model(path: str) -> PieceModel:
    """A SentencePiece model file, read on the driver (its size is the vocabulary's)."""
    pieces, scores, types, norm = [], [], [], {}
    with open(path, "rb") as f:
        for number, value in _fields(f.read()):
            if number == 1:
                got = dict(_fields(value))
                pieces.append(got.get(1, b"").decode("utf-8"))
                scores.append(struct.unpack("<f", got[2])[0] if 2 in got else 0.0)
                types.append(got.get(3, NORMAL))
            elif number == 3:
                norm = dict(_fields(value))
    if norm.get(2):
        raise ValueError("models with a character map are not supported: the text has to stay as it is")
    return PieceModel(pieces, np.array(scores), np.array(types), bool(norm.get(3, 1)), bool(norm.get(4, 1)))


_POWERS = np.ones(1, np.uint64)


def _powers(n: int) -> np.ndarray:
    global _POWERS
    if len(_POWERS) < n:
        steps = np.full(max(n, 4096), HASH_BASE, np.uint64)
        steps[0] = 1
        _POWERS = np.multiply.accumulate(steps)
    return _POWERS


def _finish(h: np.ndarray) -> np.ndarray:
    return (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)


def hash_text(s: str) -> np.uint64:
    h = 0
    for c in s:
        h = (h * int(HASH_BASE) + ord(c) + 1) & 0xFFFFFFFFFFFFFFFF
    return _finish(np.array([h], np.uint64))[0]


def prefix_hashes(codes: np.ndarray) -> np.ndarray:
    """For ``c`` columns of code points, words in rows: polynomial hashes of all prefixes, column 0 empty."""
    n, length = codes.shape
    out = np.zeros((length + 1, n), np.uint64)
    for i in range(length):
        out[i + 1] = out[i] * HASH_BASE + codes[:, i] + np.uint64(1)
    return out


def segment(codes: np.ndarray, model: PieceModel) -> tuple[np.ndarray, np.ndarray]:
    """Best segmentations of equal-length words (one a row of ``codes``).

    Returns backpointers ``length`` of the last piece and its ``id`` (-1: a character
    without a piece) for every end position, as arrays of shape (word length + 1, words).
    """
    n, length = codes.shape
    pre, up = prefix_hashes(codes), _powers(model.longest + 1)
    best = np.full((length + 1, n), -np.inf)
    best[0] = 0
    step, piece = np.zeros((length + 1, n), np.int32), np.full((length + 1, n), -1, np.int32)
    shift = np.uint64(44)
    for end in range(1, length + 1):
        best[end] = best[end - 1] + model.unknown_score
        step[end] = 1
        for size in range(1, min(model.longest, end) + 1):
            key = _finish(pre[end] - pre[end - size] * up[size])
            may = np.flatnonzero(model.bits[key >> shift])
            if not len(may):
                continue
            place = np.minimum(np.searchsorted(model.keys, key[may]), len(model.keys) - 1)
            hit = model.keys[place] == key[may]
            may, ids = may[hit], model.key_ids[place[hit]]
            if not len(may):
                continue
            score = best[end - size, may] + model.scores[ids]
            better = (score > best[end, may]) | ((piece[end, may] < 0) if size == 1 else (score == best[end, may]))
            may = may[better]
            best[end, may], step[end, may], piece[end, may] = score[better], size, ids[better]
    return step, piece


def _probe(key: np.ndarray, model: PieceModel) -> np.ndarray:
    """Piece ids of substring hashes, -1 where there is none."""
    ids = np.full(len(key), -1, np.int32)
    may = np.flatnonzero(model.bits[key >> np.uint64(44)])
    place = np.minimum(np.searchsorted(model.keys, key[may]), len(model.keys) - 1)
    hit = model.keys[place] == key[may]
    ids[may[hit]] = model.key_ids[place[hit]]
    return ids


def merge(codes: np.ndarray, model: PieceModel) -> tuple[np.ndarray, np.ndarray]:
    """Segmentations by merging, as models of the BPE kind define them, in the form of ``segment``.

    In each step every word of the batch joins its best pair of neighbours (the highest
    score, from the left); only the pairs beside it are probed again.
    """
    n, length = codes.shape
    pre, up = prefix_hashes(codes), _powers(length + 1)
    words = np.arange(n)
    stop = np.tile(np.arange(1, length + 1), (n, 1))   # end of the symbol that starts here
    back = np.tile(np.arange(-1, length - 1), (n, 1))  # start of the symbol before it
    best = np.full((n, length), -np.inf)               # score of joining it with the next one

    def rate(rows: np.ndarray, at: np.ndarray) -> None:
        mid = stop[rows, at]
        best[rows, at] = -np.inf
        has = mid < length
        rows, at, mid = rows[has], at[has], mid[has]
        end = stop[rows, mid]
        ids = _probe(_finish(pre[end, rows] - pre[at, rows] * up[end - at]), model)
        best[rows, at] = np.where(ids >= 0, model.scores[ids], -np.inf)

    for i in range(length - 1):
        rate(words, np.full(n, i))
    rows = words
    while len(rows):
        at = best[rows].argmax(axis=1)
        live = best[rows, at] > -np.inf
        rows, at = rows[live], at[live]
        mid = stop[rows, at]
        end = stop[rows, mid]
        stop[rows, at] = end
        best[rows, mid] = -np.inf
        more = end < length
        back[rows[more], end[more]] = at[more]
        rate(rows, at)
        first = back[rows, at]
        rate(rows[first >= 0], first[first >= 0])
    step, piece = np.zeros((length + 1, n), np.int32), np.full((length + 1, n), -1, np.int32)
    at, rows = np.zeros(n, np.int64), words
    while len(rows):
        end = stop[rows, at[rows]]
        step[end, rows] = end - at[rows]
        piece[end, rows] = _probe(_finish(pre[end, rows] - pre[at[rows], rows] * up[end - at[rows]]), model)
        at[rows] = end
        rows = rows[end < length]
    return step, piece


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def stretches(word: str, model: PieceModel) -> list[str]:
    """A word cut wherever no piece holds both neighbours: no segmentation has a piece across such a place."""
    codes = code_points(word).astype(np.int64)
    key = codes[:-1] << 21 | codes[1:]
    place = np.minimum(np.searchsorted(model.pairs, key), max(0, len(model.pairs) - 1))
    apart = model.pairs[place] != key if len(model.pairs) else np.ones(len(key), bool)
    edges = [0, *(np.flatnonzero(apart) + 1).tolist(), len(word)]
    return [word[x:y] for x, y in zip(edges[:-1], edges[1:])]


def stretch_hits(codes: np.ndarray, model: PieceModel) -> tuple[np.ndarray, np.ndarray]:
    """Score and id of the piece of each size that ends at each place; single characters always have a score."""
    n, m = len(codes), model.longest
    score, ids = np.full((n + 1, m), -np.inf), np.full((n + 1, m), -1, np.int32)
    score[1:, 0] = model.unknown_score
    h = np.zeros(n, np.uint64)
    for size in range(1, min(m, n) + 1):
        h = h[:n - size + 1] * HASH_BASE + codes[size - 1:] + np.uint64(1)
        found = _probe(_finish(h), model)
        start = np.flatnonzero(found >= 0)
        score[start + size, size - 1], ids[start + size, size - 1] = model.scores[found[start]], found[start]
    return score, ids


def advance(score: np.ndarray, windows: int, width: int, exits: bool) -> tuple[np.ndarray, np.ndarray]:
    """Windows of equal width side by side, from each of their entries.

    A path enters a window at its first piece border, one of the first ``m`` places.
    ``best[w, j, e]`` is the largest sum from entry ``j`` of window ``w`` to place ``e`` and
    ``step`` the size of the last piece on that way; places behind the window, with
    ``exits``, are reached from inside it only.
    """
    m = score.shape[1]
    best = np.full((windows, m, width + m), -np.inf)
    best[:, np.arange(m), np.arange(m)] = 0
    step = np.zeros(best.shape, np.int32)
    base = np.arange(windows) * width
    for e in range(1, width + (m if exits else 1)):
        least, most = max(1, e - width + 1), min(m, e)  # sizes; the longest stands first
        ways = best[:, :, e - most:e - least + 1] + score[base + e, least - 1:most][:, None, ::-1]
        at = ways.argmax(axis=2)
        sums = np.take_along_axis(ways, at[:, :, None], axis=2)[:, :, 0]
        met = sums > -np.inf
        best[:, :, e][met] = sums[met]
        step[:, :, e][met] = (most - at)[met]
    return best, step


def segment_stretch(codes: np.ndarray, model: PieceModel) -> np.ndarray:
    """Ids of one long word, as ``segment`` finds them; -3 less its code point for a character without a piece."""
    n, m = len(codes), model.longest
    width = max(LONG_WORD, m)
    windows = max(0, n // width - 1)  # the rest, one to two widths, comes last
    step, piece = np.zeros(n + 1, np.int32), np.full(n + 1, -1, np.int32)
    enter = np.append(0.0, np.full(m - 1, -np.inf))          # sums at the entries of the window that comes next,
    enter_step, enter_id = np.zeros(m, np.int32), np.full(m, -1, np.int32)  # and the pieces that end there
    at = 0
    while at < n:
        count = min(windows - at // width, max(1, STRETCH_AT_ONCE // width)) if at // width < windows else 1
        last = at // width >= windows
        own = n - at if last else width
        score, ids = stretch_hits(codes[at:at + count * own + (0 if last else m - 1)], model)
        best, steps = advance(score, count, own, not last)
        first_step, first_id = enter_step, enter_id
        entered = np.empty((count, m))
        for w in range(count):
            entered[w], steps[w, np.arange(m), np.arange(m)] = enter, enter_step
            if not last:
                sums = enter[:, None] + best[w, :, own:own + m]
                enter = sums.max(axis=0)
                enter_step = np.where(sums == enter, steps[w, :, own:own + m], 0).max(axis=0)
                place = (w + 1) * own + np.arange(m)
                enter_id = np.where(enter_step > 0, ids[np.minimum(place, len(ids) - 1), enter_step - 1], -1)
        sums = entered[:, :, None] + best
        chosen = np.where(sums == sums.max(axis=1, keepdims=True), steps, 0).max(axis=1)[:, :own + last]
        places = (np.arange(count)[:, None] * own + np.arange(own + last)).ravel()
        flat = chosen.ravel()
        found = np.where(flat > 0, ids[places, flat - 1], -1)
        over = np.flatnonzero(flat[:m] > places[:m])             # pieces that began before this part
        found[over] = np.where(flat[over] > 0, first_id[over], -1)
        step[at + places], piece[at + places] = flat, found
        at += count * own
    out, end, sizes, pieces = [], n, step.tolist(), piece.tolist()
    while end > 0:
        out.append(pieces[end] if pieces[end] >= 0 else -3 - int(codes[end - 1]))
        end -= sizes[end]
    return np.array(out[::-1], np.int64)


def encode_words(words: list[str], model: PieceModel, mode: str = "viterbi") -> list[np.ndarray]:
    """Ids of each word (blanks already marked)."""
    cut = {i: stretches(w, model) for i, w in enumerate(words) if len(w) > LONG_WORD}
    if not cut:
        return _encode_units(words, model, mode)
    whole = iter(_encode_units([w for i, w in enumerate(words) if i not in cut], model, mode))
    index: dict[str, int] = {}
    places = {i: [index.setdefault(x, len(index)) for x in parts] for i, parts in cut.items()}
    coded = _encode_units(list(index), model, mode, raw=True)
    return [_spelled(np.concatenate([coded[k] for k in places[i]]), model) if i in places else next(whole) for i in range(len(words))]


def _spelled(ids: np.ndarray, model: PieceModel) -> np.ndarray:
    return _spell_bare(ids, model) if (ids < -2).any() else ids.astype(np.int32)


def _encode_units(words: list[str], model: PieceModel, mode: str, raw: bool = False) -> list[np.ndarray]:
    """Ids of words or stretches, those of equal length together; ``raw``: characters without a piece stay marked.

    Words above 24 characters are filled up to a few lengths; what is found behind a word's end is not read.
    """
    out: list = [None] * len(words)
    by_length: dict[int, list[int]] = {}
    for i, w in enumerate(words):
        n = len(w)
        by_length.setdefault(n if n <= 24 or n > LONG_WORD else next(x for x in BATCH_LENGTHS if x >= n), []).append(i)
    for length, rows in by_length.items():
        if length == 0:
            for i in rows:
                out[i] = np.zeros(0, np.int32)
            continue
        if length > LONG_WORD and mode != "merge":
            for i in rows:
                ids = segment_stretch(code_points(words[i]).astype(np.uint64), model)
                out[i] = ids if raw else _spelled(ids, model)
            continue
        for at in range(0, len(rows), max(1, WORD_AT_ONCE * 8 // length)):
            part = rows[at:at + max(1, WORD_AT_ONCE * 8 // length)]
            sizes = np.array([len(words[i]) for i in part])
            codes = np.full((len(part), length), NO_CHAR, np.uint64)
            codes[np.arange(length)[None, :] < sizes[:, None]] = code_points("".join([words[i] for i in part]))
            step, piece = (merge if mode == "merge" else segment)(codes, model)
            _read_back(step, piece, codes, sizes, part, out, model, raw)
    return out


def _read_back(step, piece, codes, sizes, part, out, model, raw: bool = False) -> None:
    n, length = codes.shape
    ids = np.full((n, length), -2, np.int64)  # written from the back
    pos, slot, rows = sizes.copy(), np.full(n, length - 1), np.arange(n)
    while len(rows):
        end = pos[rows]
        got = piece[end, rows].astype(np.int64)
        bare = got < 0
        got[bare] = -3 - codes[rows[bare], end[bare] - 1].astype(np.int64)
        ids[rows, slot[rows]] = got
        slot[rows] -= 1
        pos[rows] -= step[end, rows]
        rows = rows[pos[rows] > 0]
    has_bare = (ids < -2).any(axis=1)
    for r in range(n):
        own = ids[r, slot[r] + 1:]
        out[part[r]] = own if raw else _spell_bare(own, model) if has_bare[r] else own.astype(np.int32)


def _spell_bare(ids: np.ndarray, model: PieceModel) -> np.ndarray:
    out: list[int] = []
    for x in ids.tolist():
        if x > -3:
            out.append(x)
            continue
        own = [int(model.byte_ids[b]) for b in chr(-3 - x).encode("utf-8", "surrogatepass")]
        if min(own) >= 0:
            out += own
        elif not (out and out[-1] == model.unknown_id):
            out.append(model.unknown_id)
    return np.array(out, np.int32)


WORDS = re.compile(f"{BLANK}*[^{BLANK}]+|{BLANK}+")


def marked(text: str, model: PieceModel) -> str:
    """The text as the model reads it: blanks marked, a leading one if the model asks for it."""
    if model.squeeze_blanks:
        text = re.sub(" +", " ", text).strip(" ")
    if not text:
        return ""
    return (BLANK if model.dummy_prefix else "") + text.replace(" ", BLANK)


def encode_texts(texts: list, model: PieceModel, mode: str = "viterbi") -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts, one after the other, and the number of ids of each (null: none).

    Texts are read in parts that end before a blank, as many together as ``CHUNK_BYTES`` holds.
    """
    counts = np.zeros(len(texts), np.int64)
    out, held, owners, size = [], [], [], 0
    for i, t in enumerate(texts):
        said = marked(t, model) if t else ""
        for a, b in cuts_before(said, CHUNK_BYTES, f"(?<!{BLANK}){BLANK}"):
            if held and size + b - a > CHUNK_BYTES:
                out.append(_encode_parts(held, owners, counts, model, mode))
                held, owners, size = [], [], 0
            held.append(said[a:b])
            owners.append(i)
            size += b - a
    if held:
        out.append(_encode_parts(held, owners, counts, model, mode))
    return np.concatenate([np.zeros(0, np.int32), *out]), counts


def _encode_parts(parts: list[str], owners: list[int], counts: np.ndarray, model: PieceModel, mode: str) -> np.ndarray:
    """Ids of marked parts; the numbers of ids are added to those of their owners in ``counts``."""
    index: dict[str, int] = {}
    seen: list[int] = []
    per_part = []
    for part in parts:
        own = WORDS.findall(part)
        per_part.append(len(own))
        for w in own:
            seen.append(index.setdefault(w, len(index)))
    coded = encode_words(list(index), model, mode)
    sizes = np.fromiter(map(len, coded), np.int64, len(coded))
    flat, starts = np.concatenate(coded), np.cumsum(sizes) - sizes
    word = np.array(seen, np.int64)
    n = sizes[word]
    ends = np.cumsum(n)
    upto = np.concatenate([[0], ends])[np.cumsum(per_part)]
    np.add.at(counts, owners, np.diff(upto, prepend=0))
    return flat[np.repeat(starts[word] - (ends - n), n) + np.arange(int(ends[-1]))]


class Speller:
    """Piece bytes laid out for gathering."""

    def __init__(self, model: PieceModel):
        raw = []
        for p, t in zip(model.pieces, model.types):
            if t == BYTE:
                raw.append(bytes([int(p[3:5], 16)]))
            elif t == CONTROL:
                raw.append(b"")
            elif t == UNKNOWN:
                raw.append(" ⁇ ".encode())
            else:
                raw.append(p.replace(BLANK, " ").encode())
        self.size = np.fromiter(map(len, raw), np.int64, len(raw))
        self.start = np.cumsum(self.size) - self.size
        self.data = np.frombuffer(b"".join(raw), np.uint8)

    def decode(self, ids: np.ndarray, counts: np.ndarray, dummy_prefix: bool) -> list[str]:
        """Texts of consecutive id runs; bytes that form no character become U+FFFD."""
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.size)):
            raise ValueError("an id lies outside the vocabulary")
        n = self.size[ids]
        ends = np.cumsum(n)
        parts = []
        for at in range(0, len(ids), IDS_AT_ONCE):
            part = slice(at, at + IDS_AT_ONCE)
            own = n[part]
            upto = np.cumsum(own)
            parts.append(self.data[np.repeat(self.start[ids[part]] - (upto - own), own) + np.arange(int(upto[-1]))].tobytes())
        data = b"".join(parts)
        cut = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])].tolist()
        out = []
        for a, b in zip(cut[:-1], cut[1:]):
            if dummy_prefix and data[a:a + 1] == b" ":
                a += 1
            out.append(data[a:b].decode("utf-8", "replace"))
        return out


IDS = T.StructType([T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("n_tokens", T.LongType())])


def _id_arrays(parts: list[np.ndarray], counts: list[np.ndarray], null: list[bool]) -> list[pa.Array]:
    """Arrow columns ``ids`` and ``n_tokens`` of consecutive runs of ids."""
    n = np.concatenate([np.zeros(0, np.int64), *counts])
    offsets = np.concatenate([[0], np.cumsum(n)]).astype(np.int32)
    flat = pa.array(np.concatenate([np.zeros(0, np.int32), *parts]), pa.int32())
    ids = pa.ListArray.from_arrays(pa.array(offsets), flat, mask=pa.array(null, pa.bool_()) if any(null) else None)
    return [ids, pa.array(n, pa.int64())]


def encode(docs: DataFrame, model: PieceModel, text: str = "text", keep: list[str] | None = None,
           mode: str = "viterbi") -> DataFrame:
    """Append ``ids`` (array of int) and ``n_tokens`` to every row; narrow.

    ``mode="merge"`` gives the ids that the library gives for a model of the BPE kind,
    the default those of the best sum of scores.

    Null texts give null ids and 0, empty ones an empty array.  Texts are whole at any
    length; repeated rows get equal ids; clashing columns are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # the vocabulary file's size

    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        parts, counts, null = [], [], []
        for _, texts in text_chunks(batch, text, CHUNK_BYTES):
            ids, n = encode_texts(texts, shared.value, mode)
            parts.append(ids)
            counts.append(n)
            null += [t is None for t in texts]
        return _id_arrays(parts, counts, null)

    return add_columns(docs, run, IDS, keep)


def decode(rows: DataFrame, model: PieceModel, ids: str = "ids", out: str = "decoded",
           keep: list[str] | None = None) -> DataFrame:
    """Append the text of each id array (null stays null); ids outside the vocabulary raise.

    Empty arrays give empty texts; arrays of any length are decoded whole, a bounded number
    of ids at a time; repeated rows get equal texts; an empty table stays empty; a column
    named like ``out`` is replaced.
    """
    shared = rows.sparkSession.sparkContext.broadcast((Speller(model), model.dummy_prefix))

    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        speller, prefix = shared.value
        col = batch.column(ids)
        counts = np.asarray(pc.list_value_length(col).fill_null(0)).astype(np.int64)
        parts = []
        for a, b in spans_of(counts.tolist(), IDS_AT_ONCE):
            part = col.slice(a, b - a)
            texts = speller.decode(np.asarray(part.flatten()), counts[a:b], prefix)
            parts.append(pa.array([None if n else t for t, n in zip(texts, np.asarray(part.is_null()))], pa.string()))
        return [pa.concat_arrays(parts) if parts else pa.array([], pa.string())]

    return add_columns(rows, run, T.StructType([T.StructField(out, T.StringType())]), keep)


def encode_and_check(docs: DataFrame, model: PieceModel, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``encode`` and ``decode`` in one pass: ``ids``, ``n_tokens`` and ``round_trip``, whether the ids spell the text.

    False only where the text itself holds the blank mark U+2581, which reads as a blank;
    null texts have nothing to spell and give true.  Empty texts have no id; texts of any
    length, with or without blanks, are encoded whole; repeated rows get equal results; an
    empty table stays empty; columns named like the new ones are replaced.  With a model of
    the BPE kind the ids are those of the best sum of its scores, not the library's own
    (``encode`` gives these with ``mode="merge"``).
    """
    shared = docs.sparkSession.sparkContext.broadcast((model, Speller(model)))  # the vocabulary file's size

    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        pieces, speller = shared.value
        parts, counts, null, same = [], [], [], []
        for _, texts in text_chunks(batch, text, CHUNK_BYTES):
            ids, n = encode_texts(texts, pieces)
            same += [t is None or t == d for t, d in zip(texts, speller.decode(ids, n, pieces.dummy_prefix))]
            parts.append(ids)
            counts.append(n)
            null += [t is None for t in texts]
        return [*_id_arrays(parts, counts, null), pa.array(same, pa.bool_())]

    return add_columns(docs, run, T.StructType([*IDS.fields, T.StructField("round_trip", T.BooleanType())]), keep)
