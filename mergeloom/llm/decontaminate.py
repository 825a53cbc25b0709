"""Benchmark decontamination with a broadcast hash set of normalised n-grams.

Benchmark items are cut into windows of ``n`` consecutive words (an item with fewer is
one window).  The set of window hashes is broadcast, every document's words are scanned
once in byte arrays, and each window whose hash is in the set is verified word by word
before its words count as hit.  The set's size is checked first: beyond
``broadcast_windows`` the same windows are met in an equi-join on the hash instead.

Words are runs of ASCII letters and digits and of all bytes from 0x80, lower-cased in
ASCII, so the scan needs no decoding.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import add_columns, spans_of, without, written

PIECE = 1 << 20
#: Multiplier of the word hash (odd, so it has an inverse) and of the window hash.
BASE, STEP = 0x9E3779B97F4A7C15 | 1, 0xC2B2AE3D27D4EB4F | 1
_M = (1 << 64) - 1
NORM = np.zeros(256, np.uint8)  # separator: 0; word byte: itself, lower-cased
for _b in range(256):
    if 0x30 <= _b <= 0x39 or 0x61 <= _b <= 0x7A or _b >= 0x80:
        NORM[_b] = _b
    elif 0x41 <= _b <= 0x5A:
        NORM[_b] = _b + 32
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the word multiplier and of its inverse, ``n`` at least."""
    if not _POWERS or len(_POWERS[0]) < n:
        out = []
        for base in (BASE, pow(BASE, -1, 1 << 64)):
            steps = np.full(max(n, PIECE + 4096), base, np.uint64)
            steps[0] = 1
            out.append(np.multiply.accumulate(steps))
        _POWERS[:] = out
    return _POWERS[0], _POWERS[1]


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


@dataclass
class Words:
    start: np.ndarray  # byte offsets in the scanned buffer
    end: np.ndarray
    hash: np.ndarray


def scan_words(data: np.ndarray, breaks: np.ndarray) -> Words:
    """Words of a byte buffer holding several texts; no word crosses an offset in ``breaks``."""
    starts, ends, hashes = [], [], []
    at, n = 0, len(data)
    while at < n:
        to = min(n, at + PIECE)
        while to < n:  # a piece ends behind a separator
            stop = np.flatnonzero(NORM[data[max(at, to - 4096):to]] == 0)
            if len(stop):
                to = max(at, to - 4096) + int(stop[-1]) + 1
                break
            to = min(n, to + PIECE)
        b = NORM[data[at:to]]
        word = np.zeros(len(b) + 2, bool)
        word[1:-1] = b != 0
        first = word[1:-1] & ~word[:-2]
        last = word[1:-1] & ~word[2:]
        cuts = breaks[(breaks > at) & (breaks < to)] - at
        if len(cuts):
            first[cuts] |= word[1:-1][cuts]
            last[cuts - 1] |= word[1:-1][cuts - 1]
        s, e = np.flatnonzero(first), np.flatnonzero(last) + 1
        if len(s):
            up, down = _powers(len(b))
            total = np.zeros(len(b) + 1, np.uint64)
            np.cumsum(b.astype(np.uint64) * up[:len(b)], out=total[1:])
            h = (total[e] - total[s]) * down[s]
            hashes.append(_mix(h ^ ((e - s).astype(np.uint64) << np.uint64(56))))
            starts.append(s + at)
            ends.append(e + at)
        at = to
    if not starts:
        return Words(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64))
    return Words(np.concatenate(starts), np.concatenate(ends), np.concatenate(hashes))


def window_hashes(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of ``k`` word hashes."""
    n = len(hashes) - k + 1
    out = np.zeros(max(0, n), np.uint64)
    for j in range(k if n > 0 else 0):
        out = out * np.uint64(STEP) + hashes[j:j + n]
    return _mix(out)


def text_words(text: str | None) -> list[bytes]:
    """The normalised words of one text."""
    return [w for w in NORM[np.frombuffer((text or "").encode("utf-8"), np.uint8)].tobytes().split(b"\0") if w]


class WindowSet:
    """Benchmark windows by length: sorted hashes, a bit table in front, exact words behind."""

    def __init__(self, items: list[tuple], n: int):
        self.windows: dict[int, dict[int, dict[bytes, set]]] = {}
        for item, text in items:
            words = text_words(text)
            if not words:
                continue
            k = min(n, len(words))
            data = np.frombuffer(b" ".join(words), np.uint8)
            hashes = window_hashes(scan_words(data, np.zeros(0, np.int64)).hash, k).tolist()
            for i, h in enumerate(hashes):
                found = self.windows.setdefault(k, {}).setdefault(h, {})
                found.setdefault(b" ".join(words[i:i + k]), set()).add(item)
        self.sorted = {k: np.sort(np.fromiter(v, np.uint64, len(v))) for k, v in self.windows.items()}
        self.front = {}
        for k, v in self.sorted.items():
            bits = min(26, max(16, int(len(v)).bit_length() + 5))
            table = np.zeros(1 << bits, bool)
            table[v >> np.uint64(64 - bits)] = True
            self.front[k] = (np.uint64(64 - bits), table)

    def hits(self, data: np.ndarray, words: Words, limits: np.ndarray) -> list[tuple[int, int, set]]:
        """Verified ``(first word, length, items)``; ``limits`` holds for each word the end of its text's words."""
        out = []
        for k, keys in self.sorted.items():
            h = window_hashes(words.hash, k)
            if not len(h):
                continue
            shift, table = self.front[k]
            at = np.flatnonzero(table[h >> shift])
            at = at[at + k <= limits[at]]
            place = np.minimum(np.searchsorted(keys, h[at]), len(keys) - 1)
            at = at[keys[place] == h[at]]
            for i in at.tolist():
                said = b" ".join(NORM[data[words.start[j]:words.end[j]]].tobytes() for j in range(i, i + k))
                items = self.windows[k][int(h[i])].get(said)
                if items is not None:
                    out.append((i, k, items))
        return out


RESULT = T.StructType([T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()),
                       T.StructField("item_ids", T.ArrayType(T.StringType())),
                       T.StructField("hit_spans", T.ArrayType(T.StructType([
                           T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])))])


def _scan_batch(col: pa.Array, windows: WindowSet) -> list[tuple]:
    """``(n_words, n_hit, items, spans in code points)`` of each text of an Arrow string column."""
    out = []
    lengths = np.asarray(pc.binary_length(col).fill_null(0))
    for a, b in spans_of(lengths.tolist(), PIECE):
        part = col.slice(a, b - a)
        ends = np.cumsum(lengths[a:b]).astype(np.int64)
        data = np.frombuffer(b"".join(x for x in part.cast(pa.binary()).to_pylist() if x), np.uint8)
        words = scan_words(data, ends[:-1])
        upto = np.searchsorted(words.start, ends)  # words of each text end here
        doc = np.searchsorted(ends, words.start, side="right")
        limits = upto[doc] if len(doc) else doc
        by_doc: dict[int, list] = {}
        for hit in windows.hits(data, words, limits):
            by_doc.setdefault(int(doc[hit[0]]), []).append(hit)
        n_words = np.diff(upto, prepend=0)
        for d in range(b - a):
            if d not in by_doc:
                out.append((int(n_words[d]), 0, [], []))
                continue
            low = int(upto[d - 1]) if d else 0
            mark = np.zeros(int(n_words[d]) + 2, bool)
            items: set = set()
            for i, k, found in by_doc[d]:
                mark[i - low + 1:i - low + k + 1] = True
                items |= found
            edges = np.flatnonzero(mark[1:] != mark[:-1])
            origin = int(ends[d - 1]) if d else 0
            lead = np.concatenate([[0], np.cumsum((data[origin:int(ends[d])] & 0xC0) != 0x80)])
            spans = [{"start": int(lead[words.start[low + s] - origin]), "end": int(lead[words.end[low + e - 1] - origin])}
                     for s, e in zip(edges[0::2].tolist(), edges[1::2].tolist())]
            out.append((int(n_words[d]), int(mark.sum()), sorted(x for x in items if x is not None), spans))
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame, n: int = 10, broadcast_windows: int = 250_000,
                  keep: list[str] | None = None) -> DataFrame:
    """Append ``n_words``, ``n_hit``, ``item_ids`` and ``hit_spans`` (code points, end exclusive) to every row.

    A word is hit if it stands inside any occurrence of a benchmark window.  Null and
    wordless texts, on either side, have no words and no windows; repeated rows get equal
    results; equal item ids are one item, and windows of an item with a null id hit but
    name no item.  An empty benchmark hits nothing.  Clashing columns are replaced.
    A broadcast window takes about 600 bytes in a task, so the default bound is 150 MB.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text")
    bound = items.agg(F.sum(F.greatest(F.lit(1), F.length("text"))), F.count("text")).first()
    if (bound[0] or 0) / 2 > broadcast_windows:  # a window starts at a word, a word takes two characters
        return _decontaminate_joined(docs, items, n, keep)
    rows = [(r["item_id"], r["text"]) for r in items.where("text is not null").collect()]  # size checked above
    windows = spark.sparkContext.broadcast(WindowSet(rows, n))

    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        got = _scan_batch(batch.column("text"), windows.value)
        kind = [pa.int64(), pa.int64(), pa.list_(pa.string()),
                pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))]
        return [pa.array([g[c] for g in got], kind[c])
                for c in range(4)]

    return add_columns(docs, run, RESULT, keep)


WINDOWS_AT_ONCE = 1 << 15  # rows of an Arrow batch of windows
MOST_BITS = 27             # of the filter of benchmark hashes that a task holds (16 MB)


def _pieces(col: pa.Array) -> Iterator[tuple[int, int, np.ndarray, Words, np.ndarray]]:
    """The texts of an Arrow string column in spans of about ``PIECE`` bytes.

    Yields ``(first row, end row, bytes, words, upto)``; ``upto`` holds for each text the end of its words.
    """
    lengths = np.asarray(pc.binary_length(col).fill_null(0))
    for a, b in spans_of(lengths.tolist(), PIECE):
        ends = np.cumsum(lengths[a:b]).astype(np.int64)
        data = np.frombuffer(b"".join(x for x in col.slice(a, b - a).cast(pa.binary()).to_pylist() if x), np.uint8)
        words = scan_words(data, ends[:-1])
        yield a, b, data, words, np.searchsorted(words.start, ends)


def _flat(ids: pa.Array, rows: np.ndarray, k: np.ndarray, at: np.ndarray, low: np.ndarray, h: np.ndarray, data: np.ndarray,
          words: Words) -> Iterator[pa.RecordBatch]:
    """Windows ``(id, k, i, h, w)`` as flat batches: of row ``rows``, ``k`` words from word ``at`` on, its text's first being ``low``."""
    for x in range(0, len(at), WINDOWS_AT_ONCE):
        part = slice(x, x + WINDOWS_AT_ONCE)
        said = [b" ".join(NORM[data[s:e]].tobytes() for s, e in zip(words.start[i:i + n].tolist(), words.end[i:i + n].tolist()))
                for i, n in zip(at[part].tolist(), k[part].tolist())]
        yield pa.RecordBatch.from_arrays(
            [ids.take(pa.array(rows[part])), pa.array(k[part].astype(np.int32)), pa.array((at - low)[part].astype(np.int64)),
             pa.array(h[part].view(np.int64)), pa.array(said, pa.binary())], names=["id", "k", "i", "h", "w"])


def _filter_bits(own: DataFrame) -> tuple[int, np.ndarray]:
    """A bit table of the leading bits of all benchmark hashes, about a sixteenth full or ``MOST_BITS`` wide."""
    n = own.count()
    bits = min(MOST_BITS, max(16, n.bit_length() + 4))
    place = F.shiftrightunsigned("h", 64 - bits)
    cells = (own.select(place.alias("p")).groupBy(F.shiftright("p", 6).alias("cell"))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(p & 63 as int))")).alias("set")).toArrow())  # 2 ** 21 rows at most
    table = np.zeros(1 << (bits - 6), np.uint64)
    table[np.asarray(cells.column("cell"))] = np.asarray(cells.column("set")).view(np.uint64)
    return bits, table


def _survivors(hashes: np.ndarray, bits: int, table: np.ndarray) -> np.ndarray:
    """Indices of the hashes whose bit is set; every benchmark hash has its bit set."""
    place = hashes >> np.uint64(64 - bits)
    return np.flatnonzero((table[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1))


def _decontaminate_joined(docs: DataFrame, items: DataFrame, n: int, keep: list[str] | None) -> DataFrame:
    """The way for benchmarks too large to broadcast: both sides' windows meet in an equi-join.

    Texts are scanned in bounded spans.  A document's window is emitted, with its words,
    only if a bit table of the benchmark's hashes lets it pass; the join on hash and words
    decides.  The table has a fixed size at most: beyond some 10 million windows more
    pass in vain, and none is lost.

    Items are folded before documents meet them: a window stands for the set of its items,
    equal sets are one set, and documents that hit equal sets of windows share one
    signature.  Items are united once a signature, so a window common to a third of all
    items and of all documents costs no product of the two; the items of a document come
    together only in its result.
    """
    def of_items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, words, upto in _pieces(batch.column("text")):
                for d in range(b - a):
                    low, end = int(upto[d - 1]) if d else 0, int(upto[d])
                    if end == low:
                        continue
                    k = min(n, end - low)
                    h = window_hashes(words.hash[low:end], k)
                    at = np.arange(low, low + len(h))
                    yield from _flat(batch.column("item_id"), np.full(len(at), a + d), np.full(len(at), k), at,
                                     np.full(len(at), low), h, data, words)

    kind = "id string, k int, i long, h long, w binary"
    own = written(items.select("item_id", "text").mapInArrow(of_items, kind).select(
        F.col("id").alias("item_id"), "k", "h", "w"), "windows")
    lengths = sorted(r[0] for r in own.select("k").distinct().collect())  # n values at most
    shared = docs.sparkSession.sparkContext.broadcast(_filter_bits(own))  # 2 ** (MOST_BITS - 3) bytes at most
    table = written(without(docs, RESULT.names).withColumn("__row", F.monotonically_increasing_id()), "documents")

    def of_documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, words, upto in _pieces(batch.column("text")):
                for k in lengths:
                    hashes = window_hashes(words.hash, k)
                    at = _survivors(hashes, *shared.value)
                    doc = np.searchsorted(upto, at, side="right")
                    inside = at + k <= upto[doc]  # no window crosses two texts
                    at, doc = at[inside], doc[inside]
                    low = np.concatenate([[0], upto])[doc]
                    yield from _flat(batch.column("__row"), a + doc, np.full(len(at), k), at, low, hashes[at], data, words)

    scanned = table.select("__row", "text").mapInArrow(of_documents, kind.replace("id string", "id long")).withColumnRenamed("id", "__row")
    stands = written(own.groupBy("k", "h", "w").agg(F.sort_array(F.collect_set("item_id")).alias("items"))
                     .withColumn("set", F.sha2(F.to_json("items"), 256)), "window-sets")
    met = written(scanned.join(stands.select("k", "h", "w", "set"), ["k", "h", "w"]).select("__row", "i", "k", "set"), "hits")
    signed = written(met.groupBy("__row").agg(F.sort_array(F.collect_set("set")).alias("sets"))
                     .withColumn("signature", F.sha2(F.concat_ws("", "sets"), 256)), "signatures")
    sets = stands.groupBy("set").agg(F.any_value("items").alias("items"))
    united = (signed.groupBy("signature").agg(F.any_value("sets").alias("sets"))
              .select("signature", F.explode("sets").alias("set")).join(sets, "set")
              .select("signature", F.explode("items").alias("item"))
              .groupBy("signature").agg(F.sort_array(F.collect_set("item")).alias("item_ids")))
    found = signed.select("__row", "signature").join(united, "signature").select("__row", F.col("item_ids").alias("__items"))
    places = met.groupBy("__row").agg(F.collect_list(F.struct("i", "k")).alias("__at"))
    full = table.join(places, "__row", "left").join(found, "__row", "left")

    def finish(batch: pa.RecordBatch) -> list[pa.Array]:
        counts, hit, starts, ends, upto = [], [], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [0]
        for text, at in zip(batch.column("text"), batch.column("__at")):
            data = np.frombuffer((text.as_py() or "").encode("utf-8"), np.uint8)
            words = scan_words(data, np.zeros(0, np.int64))
            edge = np.zeros(len(words.start) + 2, np.int64)
            if at.is_valid:
                first = np.asarray(at.values.field("i")) + 1
                np.add.at(edge, first, 1)
                np.add.at(edge, first + np.asarray(at.values.field("k")), -1)
            mark = np.cumsum(edge) > 0
            edges = np.flatnonzero(mark[1:] != mark[:-1])
            if len(edges):
                lead = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
                starts.append(lead[words.start[edges[0::2]]])
                ends.append(lead[words.end[edges[1::2] - 1]])
            counts.append(len(words.start))
            hit.append(int(mark.sum()))
            upto.append(upto[-1] + len(edges) // 2)
        spans = pa.StructArray.from_arrays([pa.array(np.concatenate(starts), pa.int64()), pa.array(np.concatenate(ends), pa.int64())],
                                           names=["start", "end"])
        return [pa.array(counts, pa.int64()), pa.array(hit, pa.int64()), pa.ListArray.from_arrays(pa.array(upto, pa.int32()), spans)]

    carried = [c for c in table.columns if c != "__row" and (keep is None or c in keep)]
    out = add_columns(full, finish, T.StructType([RESULT["n_words"], RESULT["n_hit"], RESULT["hit_spans"]]), [*carried, "__items"])
    return out.select(*[f"`{c}`" for c in carried], "n_words", "n_hit",
                      F.coalesce("__items", F.array().cast("array<string>")).alias("item_ids"), "hit_spans")


def cut_spans(docs: DataFrame, text: str = "text", spans: str = "hit_spans") -> DataFrame:
    """``docs`` with the marked spans cut out of their texts (one blank stands in for each).

    Null texts and rows without spans stay as they are, so do empty texts; texts of any
    length are cut whole; repeated rows get equal texts; an empty table stays empty; no
    column is added.
    """

    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        out = []
        for t, marks in zip(batch.column(text).to_pylist(), batch.column(spans).to_pylist()):
            if t is not None and marks:
                parts, at = [], 0
                for m in marks:
                    parts.append(t[at:m["start"]])
                    at = m["end"]
                t = " ".join([*parts, t[at:]])
            out.append(t)
        return [pa.array(out, pa.string())]

    order = docs.columns
    return add_columns(docs, run, T.StructType([T.StructField(text, T.StringType())])).select(*[f"`{c}`" for c in order])
