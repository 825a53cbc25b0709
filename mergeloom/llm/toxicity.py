"""Toxicity scores from a lexicon trie met with Levenshtein automata.

The lexicon is learned: words, and word stems, that labelled toxic documents hold far
more often than others.  It is a trie, and the automaton that accepts every string within
one edit (a swap of neighbours is one) of a word, or of a beginning that a stem stands
for, is run as a table: a state is a set of trie nodes with the edits spent on the way,
and its successors are worked out the first time they are needed.  All distinct words of
a batch step through that table together.  Words that a stem covers stay in the trie for
their misspellings; words that clean texts use are no misspellings.

Every hit is weighed by a window of its context: a hit inside quotation marks or beside a
reporting word counts as quoted, one beside an address to the reader as direct.  Words of
both kinds are learned from the contexts of the sample, beside a few that are given.  A
misspelled hit is evidence like an exact one of the same term, a fixed factor weaker.
Evidence, quoted evidence and address are features of a logistic model in which evidence
never counts against toxicity and quoted evidence never for it.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import add_columns, cut, cuts_before, text_chunks

WORD = re.compile(r"[\w@$!*]+")
EDGE = "@$!*_"
STEMS = (4, 5, 6)
FUZZY_FROM = 5        # shorter words have too many neighbours, unless the words of clean texts are known
SHORT_FROM = 4        # letters of a term, and of its misspelling, where they are
CHARS_AT_ONCE = 1 << 21  # text whose words are matched together
MOST_STATES = 1 << 16  # of the automaton that a task keeps from batch to batch
WINDOW = 60           # characters of context on either side
REPORT = set("said says say called calls wrote writes word words term quote quoted quotes dit disait mot sagte "
             "schrieb wort nannte dijo palabra llamó".split())
ADDRESS = set("you your you're youre u tu toi te ton vous du dich dir dein ihr usted tú ti vosotros".split())
OPEN, CLOSE = "\"“„«‘", "\"”“»’"
FEATURES = 8
SIGNS = np.array([1, 1, 1, 1, 1, -1, -1, 1])  # of their weights: quoted evidence speaks for no toxicity
MISSPELLED = 0.9      # of the weight of the exact term
CHANCE = 0.01         # that any feature of the sample stands out by chance
SURE = 0.75           # share of toxic texts among a term's, from which contexts are learned


class Lexicon:
    """Terms with weights, as a trie whose Levenshtein automaton is a table filled on demand.

    By default one insertion, deletion or change in a word of ``FUZZY_FROM`` letters is
    accepted.  ``covered`` (words, and stems ending in ``*``, that ``stems`` answer for when
    spelled right) opens the wide form: those terms, and stems of ``FUZZY_FROM`` letters as
    beginnings, are met with one edit too, a swap of neighbours is one edit, and words of
    ``SHORT_FROM`` letters are open to edits.
    ``plain`` holds words that are never taken for misspellings.
    """

    def __init__(self, words: dict[str, float], stems: dict[str, float], covered: dict[str, float] | None = None,
                 plain: frozenset[str] = frozenset()):
        self.swaps, self.plain = covered is not None, plain
        hidden = covered or {}
        self.weights = [*words.values(), *stems.values(), *hidden.values()]
        self.named = [*words, *(f"{x}*" for x in stems), *hidden]  # stems end in *
        self.next: list[dict[str, int]] = [{}]
        self.word_at: dict[int, int] = {}
        self.stem_at: dict[int, int] = {}
        self.fuzzy_at: dict[int, int] = {}
        self.near_stem_at: dict[int, int] = {}
        least = FUZZY_FROM if covered is None else SHORT_FROM
        for i, term in enumerate([*words, *stems, *hidden]):
            stem = len(words) <= i < len(words) + len(stems) or i >= len(words) + len(stems) and term[-1] == "*"
            if stem and i >= len(words) + len(stems):
                term = term[:-1]
            node = 0
            for ch in term:
                node = self.next[node].setdefault(ch, len(self.next))
                if node == len(self.next):
                    self.next.append({})
            if i < len(words) + len(stems):
                (self.stem_at if stem else self.word_at)[node] = i
            if not stem and len(term) >= least:
                self.fuzzy_at[node] = i
            elif stem and covered is not None and len(term) >= FUZZY_FROM:
                self.near_stem_at[node] = i
        letters = sorted({c for d in self.next for c in d if ord(c) < 0xFFFF})
        self.letter = np.zeros(1 << 16, np.int32)  # 0: in no term; letters beyond the basic plane are taken for such
        for i, c in enumerate(letters):
            self.letter[ord(c)] = i + 1
        self.letters = ["", *letters]
        self._reset()

    def close(self, terms: set[int]) -> None:
        """Accept these terms from now on as they are spelled only."""
        self.fuzzy_at = {n: i for n, i in self.fuzzy_at.items() if i not in terms}
        self.near_stem_at = {n: i for n, i in self.near_stem_at.items() if i not in terms}
        self._reset()

    def _reset(self) -> None:
        self.states: dict[frozenset, int] = {}
        self.sets: list[frozenset] = []
        self.table = np.full((64, len(self.letters)), -1, np.int32)
        self.exact, self.fuzzy, self.stem, self.near = [], [], [], []
        self.arrays: list[np.ndarray] = []
        self._state(frozenset())               # 0: dead
        self.start = self._state(self._close({(0, 0)}))

    def __getstate__(self):
        kept = dict(self.__dict__)
        for name in ("states", "sets", "table", "exact", "fuzzy", "stem", "near", "arrays", "start"):
            kept.pop(name, None)
        return kept

    def __setstate__(self, kept):
        self.__dict__.update(kept)
        self._reset()

    def _close(self, pairs: set) -> frozenset:
        """With left-out characters, and without pairs that a pair with fewer edits makes needless.

        In place of its edits a pair may hold the letter that completes a swap.
        """
        out = set(pairs)
        for node, edits in pairs:
            if edits == 0:
                out.update((c, 1) for c in self.next[node].values())
        return frozenset((n, e) for n, e in out if e == 0 or (n, 0) not in out)

    def _state(self, pairs: frozenset) -> int:
        at = self.states.get(pairs)
        if at is None:
            at = self.states[pairs] = len(self.sets)
            self.sets.append(pairs)
            if at >= len(self.table):
                self.table = np.concatenate([self.table, np.full_like(self.table, -1)])
            self.exact.append(next((self.word_at[n] for n, e in pairs if e == 0 and n in self.word_at), -1))
            self.stem.append(next((self.stem_at[n] for n, e in pairs if e == 0 and n in self.stem_at), -1))
            for found, among in ((self.fuzzy, self.fuzzy_at), (self.near, self.near_stem_at)):
                found.append(max((among[n] for n, e in pairs if e in (0, 1) and n in among),
                                 key=lambda i: self.weights[i], default=-1))
        return at

    def _step(self, state: int, letter: int) -> int:
        ch, out = self.letters[letter], set()
        for node, edits in self.sets[state]:
            if isinstance(edits, str):                                   # the first half of a swap has been read
                if letter and ch == edits:
                    out.add((node, 1))
                continue
            child = self.next[node].get(ch) if letter else None
            if child is not None:
                out.add((child, edits))
            if edits == 0 and letter and self.swaps:
                out.update((self.next[c][ch], first) for first, c in self.next[node].items() if ch in self.next[c])
            if edits == 0:
                out.add((node, 1))                                       # an extra character
                out.update((c, 1) for c in self.next[node].values())     # another character
        return self._state(self._close(out))

    def _accepts(self) -> list[np.ndarray]:
        """Terms accepted in each state: exact word, stem, misspelled word, misspelled stem; -1 for none."""
        if not self.arrays or len(self.arrays[0]) < len(self.sets):
            self.arrays = [np.array(x, np.int32) for x in (self.exact, self.stem, self.fuzzy, self.near)]
        return self.arrays

    def match(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """For each word the kind of its hit (0 none, 1 word, 2 stem, 3 misspelled) and its term."""
        if len(self.sets) > MOST_STATES:
            self._reset()  # states are found again when they are needed
        kind, term = np.zeros(len(words), np.int8), np.full(len(words), -1, np.int32)
        by_length: dict[int, list[int]] = defaultdict(list)
        for i, n in enumerate(map(len, words)):
            by_length[n].append(i)
        limit = max((len(x) for x in self._terms()), default=0) + 1  # no term has more letters, one edit included
        for length, rows in by_length.items():
            wide = min(length, limit + 1)
            text = "".join([words[i][:wide] for i in rows]).encode("utf-32-le", "surrogatepass")
            codes = self.letter[np.minimum(np.frombuffer(text, np.uint32), 0xFFFF)].reshape(len(rows), wide)
            state, stems = np.full(len(rows), self.start, np.int32), np.full(len(rows), -1, np.int32)
            near = stems.copy()
            for t in range(wide):
                new = self.table[state, codes[:, t]]
                lost = np.flatnonzero(new < 0)
                if len(lost):
                    pairs = np.unique(state[lost].astype(np.int64) * len(self.letters) + codes[lost, t])
                    for p in pairs.tolist():
                        s, c = divmod(p, len(self.letters))
                        to = self._step(s, c)
                        self.table[s, c] = to
                    new[lost] = self.table[state[lost], codes[lost, t]]
                state = new
                if self.stem_at:
                    stems = np.where(stems < 0, self._accepts()[1][state], stems)
                if self.near_stem_at:
                    near = np.where(near < 0, self._accepts()[3][state], near)
            exact, _, fuzzy, _ = (x[state] for x in self._accepts())
            if wide < length:
                exact, fuzzy = np.full_like(exact, -1), np.full_like(fuzzy, -1)
            if length < SHORT_FROM:
                fuzzy = np.full_like(fuzzy, -1)
            fuzzy = np.where(fuzzy >= 0, fuzzy, near)
            if self.plain:
                fuzzy[[j for j, i in enumerate(rows) if words[i] in self.plain]] = -1
            k = np.where(exact >= 0, 1, np.where(stems >= 0, 2, np.where(fuzzy >= 0, 3, 0)))
            kind[rows] = k
            term[rows] = np.where(k == 1, exact, np.where(k == 2, stems, fuzzy))
        return kind, term

    def _terms(self) -> Iterator[str]:
        stack = [(0, "")]
        while stack:
            node, said = stack.pop()
            if not self.next[node]:
                yield said
            stack += [(n, said + c) for c, n in self.next[node].items()]


@dataclass
class ToxicityModel:
    lexicon: Lexicon
    weights: np.ndarray = field(default_factory=lambda: np.zeros(FEATURES))
    bias: float = -4.0
    report: frozenset[str] = frozenset(REPORT)
    address: frozenset[str] = frozenset(ADDRESS)


def words_of(text: str) -> list[str]:
    return [w for w in (x.strip(EDGE) for x in WORD.findall(text.lower())) if w]


def near_words(text: str, start: int, end: int) -> tuple[list[str], list[str]]:
    """The four words before a hit and the three behind it, inside its window."""
    before, after = text[max(0, start - WINDOW):start].lower(), text[end:end + WINDOW].lower()
    return [w.strip(EDGE) for w in WORD.findall(before)[-4:]], [w.strip(EDGE) for w in WORD.findall(after)[:3]]


def context(text: str, start: int, end: int, report: frozenset[str] = frozenset(REPORT),
            address: frozenset[str] = frozenset(ADDRESS)) -> tuple[bool, bool]:
    """Whether the hit at ``start:end`` is quoted or reported, and whether it addresses the reader."""
    before, after = text[max(0, start - WINDOW):start], text[end:end + WINDOW]
    for o, c in zip(OPEN, CLOSE):
        inside = before.count(o) % 2 == 1 if o == c else before.rfind(o) > before.rfind(c)
        if inside and c in after:
            return True, False
    near, behind = near_words(text, start, end)
    return not report.isdisjoint(near), not address.isdisjoint(near + behind)


class _Evidence:
    """What the hits of one text add up to."""

    def __init__(self):
        self.sums, self.terms, self.best = [0.0] * 3, set(), 0.0
        self.quoted_best, self.n_quoted, self.n_direct = 0.0, 0, 0

    def add(self, kind: int, term: int, weight: float, quoted: bool, direct: bool) -> None:
        if kind == 3:
            kind, weight = 1, MISSPELLED * weight
        if quoted:
            self.n_quoted += 1
            self.quoted_best = max(self.quoted_best, weight)
            return
        self.sums[kind] += weight
        self.n_direct += direct
        self.terms.add(term)
        self.best = max(self.best, weight)

    def row(self, words: int) -> list[float]:
        return [self.best, math.log1p(self.sums[1]), math.log1p(self.sums[2]),
                math.log1p(len(self.terms)), math.log1p(self.n_direct), math.log1p(self.n_quoted), self.quoted_best,
                10 * sum(self.sums) / (words + 20)]


def features_of(texts: list, lexicon: Lexicon, report: frozenset[str] = frozenset(REPORT),
                address: frozenset[str] = frozenset(ADDRESS)) -> np.ndarray:
    """One row of evidence a text; null and empty texts have none.

    Long texts are read in parts that end at white space; contexts look across them.
    """
    x = np.zeros((len(texts), FEATURES))
    if not lexicon.weights:
        return x
    found: dict[int, _Evidence] = {}

    def weigh(i: int, start: int, end: int, kind: int, term: int) -> None:
        found.setdefault(i, _Evidence()).add(kind, term, lexicon.weights[term], *context(texts[i], start, end, report, address))

    counts = each_hit(texts, lexicon, weigh)
    for i, evidence in found.items():
        x[i] = evidence.row(counts[i])
    return x


def each_hit(texts: list, lexicon: Lexicon, visit: Callable[[int, int, int, int, int], None]) -> list[int]:
    """``visit(text, start, end, kind, term)`` of every hit, in order within a text; returns the texts' word counts."""
    counts = [0] * len(texts)
    held: list[tuple[int, int, int]] = []
    size = 0
    for i, t in enumerate(texts):
        for a, b in cuts_before(t or "", CHARS_AT_ONCE, r"\s"):
            if held and size + b - a > CHARS_AT_ONCE:
                _collect(texts, held, lexicon, counts, visit)
                held, size = [], 0
            held.append((i, a, b))
            size += b - a
    _collect(texts, held, lexicon, counts, visit)
    return counts


def _collect(texts: list, parts: list[tuple[int, int, int]], lexicon: Lexicon, counts: list[int], visit: Callable) -> None:
    """Count the words of ``parts`` (text, start, end) and visit the hits among them."""
    index: dict[str, int] = {}
    seen, upto = [], []
    for i, a, b in parts:
        own = words_of(texts[i][a:b])
        counts[i] += len(own)
        seen += [index.setdefault(w, len(index)) for w in own]
        upto.append(len(seen))
    if not index:
        return
    kind, term = lexicon.match(list(index))
    hits = np.flatnonzero((kind > 0)[np.array(seen, np.int64)])
    for p in np.unique(np.searchsorted(upto, hits, side="right")).tolist():
        i, a, b = parts[p]
        for m in WORD.finditer(texts[i], a, b):
            w = m[0].lower().strip(EDGE)
            k = index.get(w, -1) if w else -1
            if k >= 0 and kind[k]:
                visit(i, m.start(), m.end(), int(kind[k]), int(term[k]))


def surprise_of(a: float, b: float, toxic: int, clean: int) -> float:
    """How far a feature of ``a`` toxic and ``b`` clean texts stands out (a likelihood ratio statistic)."""
    share, n = toxic / (toxic + clean), a + b
    return 2 * ((a * math.log(a / (n * share)) if a else 0) + (b * math.log(b / (n * (1 - share))) if b else 0))


def learn_lexicon(rows: list[tuple], toxic: int, clean: int, least: int = 3, surprise: float = 15.0) -> Lexicon:
    """Words and stems whose toxic document counts stand out; ``rows``: (feature, toxic, clean), stems end in ``*``.

    Words that a stem covers, and longer stems below it, are kept for their misspellings.
    """
    good = []
    for feature, a, b in rows:
        n = a + b
        if a < least or a < n * (0.5 if feature[-1] == "*" else 0.2):  # a stem stands for all its words
            continue
        g = surprise_of(a, b, toxic, clean)
        if g >= surprise:
            weight = math.log((a + .5) / (toxic + 1)) - math.log((b + .5) / (clean + 1))
            good.append((g, feature, a, weight))
    good.sort(key=lambda r: (-r[0], r[1]))
    words = {f: (a, w) for _, f, a, w in good if f[-1] != "*"}
    stems: dict[str, float] = {}
    lead: dict[str, int] = defaultdict(int)
    for f, (a, _) in words.items():
        for n in STEMS:
            lead[f[:n]] = max(lead[f[:n]], a)
    for _, f, a, w in good:
        stem = f[:-1]
        if f[-1] == "*" and a > 1.1 * lead[stem] and not any(stem[:n] in stems for n in STEMS if n < len(stem)):
            stems[stem] = w
    own = {f: w for f, (_, w) in words.items() if not any(f[:n] in stems for n in STEMS)}
    # what a stem answers for stays open to misspelling: its words, and longer stems, whose neighbours are fewer
    covered = {f: w for _, f, a, w in good if f not in own and any(f[:n] in stems for n in STEMS)
               and (f[-1] != "*" or f[:-1] not in stems and a > 1.1 * lead[f[:-1]])}
    return Lexicon(own, stems, covered)


def train(docs: DataFrame, labels: DataFrame, max_docs: int = 12_000) -> ToxicityModel:
    """Learn from ``docs`` (``doc_id, text``) and ``labels`` (``doc_id, toxic``).

    At most about ``max_docs`` labelled rows, a third of them toxic where there are that
    many, are drawn by a hash of the id; equal texts among them count once, as toxic if
    any of them is.  A label that is null is none; of several labels of an id the largest
    holds.  Words and stems of the sample are counted on the executors; the lexicon holds
    all that stand out so far that no feature of the sample would by chance (``CHANCE``).

    Words near a term that clean texts of the sample hold, and toxic ones do not favour,
    are no misspellings.  A term whose neighbours clean texts use now and then (two words
    that they hold only once, or one of three in all) is closed to misspellings: more such
    words are to be expected.  What is kept is bounded by the sample, whatever the corpus.
    """
    known = labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    n = known.agg(F.sum((F.col("toxic") == 1).cast("long")).alias("t"), F.count("*").alias("n")).first()
    toxic, clean = n["t"] or 0, n["n"] - (n["t"] or 0)
    if not toxic or not clean:
        return ToxicityModel(Lexicon({}, {}), bias=-4.0 if not toxic else 4.0)
    draw = F.pmod(F.xxhash64("doc_id", F.lit("toxicity")), F.lit(1_000_000))
    part = [int(1_000_000 * min(1.0, most / count)) + 1 for most, count in ((max_docs // 3, toxic), (max_docs - max_docs // 3, clean))]
    drawn = known.where(((F.col("toxic") == 1) & (draw < part[0])) | ((F.col("toxic") != 1) & (draw < part[1])))
    # at most about max_docs rows of two numbers: small enough to be sent to every task
    sample = docs.select("doc_id", "text").where("text is not null").join(F.broadcast(drawn), "doc_id").select("text", "toxic")
    sample = cut(sample.groupBy("text").agg(F.max((F.col("toxic") == 1).cast("int")).alias("toxic")))
    sizes = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    a, b = sizes.get(1, 0), sizes.get(0, 0)
    if not a or not b:
        return ToxicityModel(Lexicon({}, {}), bias=-4.0 if not a else 4.0)

    def words_and_stems(texts: list) -> list[set[str]]:
        own = [set(words_of(t)) for t in texts]
        return [x | {w[:k] + "*" for w in x for k in STEMS if len(w) >= k} for x in own]

    counted = cut(label_counts(sample, words_and_stems))
    surprise = 2 * math.log(max(1, counted.count()) / CHANCE)
    favoured = counted.where(f"a >= 3 and a * {b} > b * {a}")
    outstanding = favoured.where(surprise_column(a, b) >= surprise * 0.999).collect()  # few: none stands there by chance
    lexicon = learn_lexicon([tuple(r) for r in outstanding], a, b, surprise=surprise)
    precise = {r["f"] for r in outstanding if r["a"] >= SURE * (r["a"] + r["b"])}

    def near_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kind, term = lexicon.match(batch.column("f").to_pylist())
            at = pa.array(np.flatnonzero(kind == 3))
            yield pa.RecordBatch.from_arrays([*[batch.column(c).take(at) for c in ("f", "a", "b")], pa.array(term[kind == 3], pa.int32())],
                                             names=["f", "a", "b", "term"])

    near = counted.where(f"b > 0 and a * {b} < 3 * b * {a} and f not like '%*'").mapInArrow(near_terms, "f string, a long, b long, term int").collect()
    lexicon.plain = frozenset(r["f"] for r in near)  # words of the sample
    words, singles = Counter(r["term"] for r in near), Counter(r["term"] for r in near if r["a"] == 0 and r["b"] == 1)
    lexicon.close({t for t, n in singles.items() if n >= 2 or words[t] >= 3})

    def contexts(texts: list) -> list[set[str]]:
        """Words near the hits of precise terms; the empty word marks a text that has such a hit."""
        out: list[set[str]] = [set() for _ in texts]

        def gather(i: int, start: int, end: int, kind: int, term: int) -> None:
            if lexicon.named[term] in precise:
                near, behind = near_words(texts[i], start, end)
                out[i].update(near, behind, {""})

        each_hit(texts, lexicon, gather)
        return out

    around = cut(label_counts(sample, contexts))
    hits = around.where("f = ''").first()
    report, address = set(REPORT), set(ADDRESS)
    if hits and hits["a"] and hits["b"]:  # terms stand in clean texts as well: what is near them tells those apart
        bound = 2 * math.log(around.count() / CHANCE)
        for r in around.where(surprise_column(hits["a"], hits["b"]) >= bound).collect():
            (report if r["a"] * hits["b"] < r["b"] * hits["a"] else address).add(r["f"])

    def evidence(batch: pa.RecordBatch) -> list[pa.Array]:
        out = [x for _, texts in text_chunks(batch, "text") for x in features_of(texts, lexicon, frozenset(report), frozenset(address)).tolist()]
        return [pa.array(out, pa.list_(pa.float64()))]

    got = add_columns(sample, evidence, T.StructType([T.StructField("x", T.ArrayType(T.DoubleType()))]), ["toxic"]).collect()
    x, y = np.array([r["x"] for r in got]), np.array([float(r["toxic"]) for r in got])
    weights, bias = fit_logistic(x, y, SIGNS)
    return ToxicityModel(lexicon, weights, bias, frozenset(report), frozenset(address))


def label_counts(sample: DataFrame, features: Callable[[list], list[set[str]]]) -> DataFrame:
    """``f, a, b``: in how many toxic and clean texts of the sample each feature stands."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in text_chunks(batch, "text"):
                held: dict[int, Counter] = {0: Counter(), 1: Counter()}
                for own, label in zip(features(texts), batch.column("toxic").slice(first, len(texts)).to_pylist()):
                    held[label].update(own)
                names = list(held[0].keys() | held[1].keys())
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([held[1][x] for x in names], pa.int64()),
                                                  pa.array([held[0][x] for x in names], pa.int64())], names=["f", "a", "b"])

    return sample.mapInArrow(count, "f string, a long, b long").groupBy("f").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))


def surprise_column(toxic: int, clean: int):
    """``surprise_of`` over the columns ``a`` and ``b``."""
    n = F.col("a") + F.col("b")
    share = toxic / (toxic + clean)

    def part(x, of):
        return F.when(x > 0, x * F.log(x / (n * of))).otherwise(0.0)

    return 2 * (part(F.col("a"), share) + part(F.col("b"), 1 - share))


def fit_logistic(x: np.ndarray, y: np.ndarray, signs: np.ndarray, l2: float = 1.0, steps: int = 100) -> tuple[np.ndarray, float]:
    """Ridge logistic regression whose weights keep the given signs (or are 0), by projected Newton steps."""
    z = np.column_stack([x, np.ones(len(x))])
    signs = np.append(signs, 0)
    w = np.zeros(z.shape[1])
    ridge = np.append(np.full(x.shape[1], l2), 1e-6)

    def loss(v: np.ndarray) -> float:
        m = z @ v
        return float(np.logaddexp(0, m).sum() - y @ m + 0.5 * (ridge * v * v).sum())

    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        grad = z.T @ (p - y) + ridge * w
        free = (signs == 0) | (w != 0) | (grad * signs < 0)  # the others would leave their sign
        hess = (z[:, free] * (p * (1 - p))[:, None]).T @ z[:, free] + np.diag(ridge[free])
        move, now, pace = np.linalg.solve(hess, grad[free]), loss(w), 1.0
        while True:
            new = w.copy()
            new[free] -= pace * move
            new = np.where(signs * new < 0, 0, new)
            if loss(new) <= now or pace < 1e-6:
                break
            pace /= 2
        moved, w = np.abs(new - w).max(), new
        if moved < 1e-8:
            break
    return w[:-1], float(w[-1])


def score(docs: DataFrame, model: ToxicityModel, keep: list[str] | None = None) -> DataFrame:
    """Append ``score`` (0 to 1) and ``predicted`` (1 from 0.5 on) to every row, from its whole text alone.

    Null, empty and wordless texts get the score of a text without evidence; repeated
    rows get equal scores; clashing columns are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # its lexicon is bounded by ``learn_lexicon``

    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        m = shared.value
        x = [features_of(texts, m.lexicon, m.report, m.address) for _, texts in text_chunks(batch, "text", CHARS_AT_ONCE)]
        x = np.concatenate(x) if x else np.zeros((0, FEATURES))
        p = 1 / (1 + np.exp(-np.clip(x @ m.weights + m.bias, -30, 30)))
        return [pa.array(p, pa.float64()), pa.array((p >= 0.5).astype(np.int32), pa.int32())]

    return add_columns(docs, run, T.StructType([T.StructField("score", T.DoubleType()),
                                                T.StructField("predicted", T.IntegerType())]), keep)
