"""Language identification by hierarchical discrimination.

A one-versus-rest linear support vector machine a family names the family; inside it,
one-versus-one machines separate the related languages and vote.  Features are hashed
letter 1- to 3-grams of the whole text, as shares of all its n-grams, so a text's score
is one gather and one segmented sum over its characters, whatever its length.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import CHUNK_CHARS, add_columns, text_chunks

DIM_BITS = 13
ORDERS = (1, 2, 3)
UNKNOWN = "und"
PER_LANGUAGE = 40   # training rows of a language at least, where it has them
DENSE_ROWS = 3200   # of a sample that the driver holds as a dense table (100 MB)
BLOCK_ROWS = 1024   # made dense at once where a sample is larger
MACHINES = 8        # fitted together by a task
RELATED = 0.8       # likeness of mean features from which languages are taken for related
MOST_KIN = 12       # languages that are put into one family by likeness; the closest come first
#: Related languages; the families of languages not listed here are found from their features.
FAMILIES = {"en": "germanic", "de": "germanic", "nl": "germanic", "sv": "germanic", "da": "germanic",
            "no": "germanic", "fr": "romance", "es": "romance", "it": "romance", "pt": "romance",
            "ro": "romance", "ca": "romance", "pl": "slavic", "cs": "slavic", "ru": "slavic", "uk": "slavic"}


def _fold_table() -> np.ndarray:
    table = np.zeros(1 << 16, np.uint16)
    for c in range(1 << 16):
        ch = chr(c)
        if ch.isalpha():
            low = ord(ch.lower()[0])
            table[c] = low if low < 1 << 16 else c
    return table


FOLD: np.ndarray | None = None


def fold(text: str) -> np.ndarray:
    """Lower-cased letter codes, 0 for every other character; letters beyond the basic plane keep 16 bits."""
    global FOLD
    if FOLD is None:
        FOLD = _fold_table()
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    folded = FOLD[np.minimum(codes, 0xFFFF)]
    high = codes > 0xFFFF
    if high.any():
        known, back = np.unique(codes[high], return_inverse=True)
        folded[high] = np.array([(c & 0xFFFF) if chr(c).isalpha() else 0 for c in known.tolist()], np.uint16)[back]
    return folded


def ngram_slots(seq: np.ndarray, done: int = 0) -> np.ndarray:
    """Hashed feature slots of the n-grams of a letter sequence; those inside its first ``done`` letters are left out."""
    c = seq.astype(np.uint32)
    out = [np.zeros(0, np.uint32)]
    for n in ORDERS:
        first = max(0, done - n + 1)
        if len(c) - n + 1 <= first:
            continue
        h = np.full(len(c) - n + 1 - first, 0x9E3779B1 * n & 0xFFFFFFFF, np.uint32)
        for j in range(n):
            h = (h ^ c[first + j:len(c) - n + 1 + j]) * np.uint32(0x85EBCA6B)
            h ^= h >> np.uint32(13)
        out.append(h >> np.uint32(32 - DIM_BITS))
    return np.concatenate(out)


def features(text: str | None) -> np.ndarray | None:
    """Shares of the feature slots over the whole text (they sum to 1); None without a letter.

    Runs of other characters count as one blank, and one stands at either end.  Long
    texts are read in pieces that overlap by what an n-gram needs.
    """
    counts, total, any_letter = np.zeros(1 << DIM_BITS, np.int64), 0, False
    carry, done = np.zeros(1, np.uint16), 0
    for at in range(0, len(text or ""), CHUNK_CHARS):
        folded = fold(text[at:at + CHUNK_CHARS])
        any_letter = any_letter or bool(folded.any())
        end = np.zeros(1 if at + CHUNK_CHARS >= len(text) else 0, np.uint16)
        seq = np.concatenate([carry, folded, end])
        keep = np.ones(len(seq), bool)
        keep[1:] = (seq[1:] != 0) | (seq[:-1] != 0)
        seq = seq[keep]
        slots = ngram_slots(seq, done)
        counts += np.bincount(slots, minlength=1 << DIM_BITS)
        total += len(slots)
        carry = seq[-(max(ORDERS) - 1):]
        done = len(carry)
    return (counts / total).astype(np.float32) if any_letter else None


@dataclass
class LangModel:
    """Column weights (slots x machines) and biases: family machines first, then the pairs."""
    weights: np.ndarray
    bias: np.ndarray
    families: list[str]
    members: list[list[str]]
    pairs: list[tuple[int, int, int]]  # family, first and second member

    def decide(self, margins: np.ndarray) -> tuple[list[str], np.ndarray]:
        """Languages and confidences of rows of machine margins."""
        sure = 1 / (1 + np.exp(-3 * np.clip(margins, -50, 50)))
        nf = len(self.families)
        if nf > 1:
            fam = margins[:, :nf].argmax(axis=1)
            conf = sure[np.arange(len(margins)), fam]
        else:
            fam, conf = np.zeros(len(margins), int), np.ones(len(margins))
        votes = [np.zeros((len(margins), len(m))) for m in self.members]
        for col, (f, a, b) in enumerate(self.pairs, nf):
            p = sure[:, col]
            votes[f][:, a] += (p >= 0.5) + p / 1e3
            votes[f][:, b] += (p < 0.5) + (1 - p) / 1e3
        best = [v.argmax(axis=1) for v in votes]
        for col, (f, a, b) in enumerate(self.pairs, nf):
            p, rows = sure[:, col], fam == f
            win = best[f]
            conf = np.where(rows & (win == a), conf * p, np.where(rows & (win == b), conf * (1 - p), conf))
        return [self.members[f][best[f][i]] for i, f in enumerate(fam)], conf


def fit_machines(x: np.ndarray, targets: np.ndarray, l2: float = 1e-4, steps: int = 300) -> tuple[np.ndarray, np.ndarray]:
    """Linear machines with squared hinge loss, one a column of ``targets`` (1, -1, or 0: row not used).

    ``x`` (single precision) is scaled in place.
    """
    d = x.shape[1]
    scale = 1 / np.sqrt(x.mean(axis=0) + np.float32(1e-6))
    z = x
    z *= scale
    share = np.stack([np.where(targets == s, 1 / np.maximum(1, (targets == s).sum(axis=0)), 0) for s in (1, -1)]).sum(0).astype(np.float32)
    w = np.zeros((d, targets.shape[1]), np.float32)
    b = np.zeros(targets.shape[1], np.float32)
    vw, vb = w.copy(), b.copy()
    lip = np.float32(2 * (np.einsum("ij,ij->i", z, z).max() + 1))  # single precision throughout: no copies of ``z``
    for t in range(steps):
        slack = np.maximum(0, 1 - targets * (z @ vw + vb)) * targets * share
        gw, gb = -2 * (z.T @ slack) + np.float32(l2) * vw, -2 * slack.sum(axis=0)
        nw, nb = vw - gw / lip, vb - gb / lip
        k = np.float32(t / (t + 3))
        vw, vb = nw + k * (nw - w), nb + k * (nb - b)
        w, b = nw, nb
    return (w * scale[:, None]).astype(np.float32), b


@dataclass
class Sample:
    """Sparse training rows: ``at`` and ``value`` of row ``i`` lie between ``upto[i]`` and ``upto[i + 1]``."""
    upto: np.ndarray
    at: np.ndarray
    value: np.ndarray

    def dense(self, rows: np.ndarray) -> np.ndarray:
        out = np.zeros((len(rows), 1 << DIM_BITS), np.float32)
        for i, r in enumerate(rows.tolist()):
            part = slice(self.upto[r], self.upto[r + 1])
            out[i, self.at[part]] = self.value[part]
        return out


def fit_in_blocks(x: Sample, targets: np.ndarray, scale: np.ndarray, lip: np.float32, l2: float = 1e-4,
                  steps: int = 300) -> tuple[np.ndarray, np.ndarray]:
    """``fit_machines`` with the rows made dense a block at a time; ``scale`` and ``lip`` are those of the whole sample."""
    share = np.stack([np.where(targets == s, 1 / np.maximum(1, (targets == s).sum(axis=0)), 0) for s in (1, -1)]).sum(0).astype(np.float32)
    used = np.flatnonzero(targets.any(axis=1))
    blocks = [used[i:i + BLOCK_ROWS] for i in range(0, len(used), BLOCK_ROWS)]
    held = x.dense(blocks[0]) * scale if len(blocks) == 1 else None
    w = np.zeros((1 << DIM_BITS, targets.shape[1]), np.float32)
    b = np.zeros(targets.shape[1], np.float32)
    vw, vb = w.copy(), b.copy()
    for t in range(steps):
        gw, gb = np.float32(l2) * vw, np.zeros_like(b)
        for rows in blocks:
            z = held if held is not None else x.dense(rows) * scale
            slack = np.maximum(0, 1 - targets[rows] * (z @ vw + vb)) * targets[rows] * share[rows]
            gw -= 2 * (z.T @ slack)
            gb -= 2 * slack.sum(axis=0)
        nw, nb = vw - gw / lip, vb - gb / lip
        k = np.float32(t / (t + 3))
        vw, vb = nw + k * (nw - w), nb + k * (nb - b)
        w, b = nw, nb
    return (w * scale[:, None]).astype(np.float32), b


def kin_of(names: list[str], means: np.ndarray, table: dict[str, str]) -> dict[str, str]:
    """The family of each language: that of ``table``, or one found by the likeness of mean features.

    The likeness of two languages is the sum of the geometric means of their shares.
    Pairs of ``RELATED`` likeness are joined, the closest first, where one of the two is
    not listed; two listed families are never joined, and no family grows beyond ``MOST_KIN`` so.
    """
    root = np.sqrt(means)
    like = root @ root.T
    family = {i: table.get(l) for i, l in enumerate(names)}
    group: dict[int, list[int]] = {}
    for i, f in family.items():
        mates = next((g for g in group.values() if f is not None and family[g[0]] == f), None)
        group[i] = mates if mates is not None else []
        group[i].append(i)
    a, b = np.triu_indices(len(names), 1)
    near = np.flatnonzero(like[a, b] >= RELATED)
    for p in near[np.argsort(-like[a, b][near], kind="stable")].tolist():
        one, two = group[int(a[p])], group[int(b[p])]
        if one is two or len(one) + len(two) > MOST_KIN or all(any(family[i] for i in g) for g in (one, two)):
            continue
        one += two
        for i in two:
            group[i] = one
    return {l: next((family[m] for m in group[i] if family[m]), names[min(group[i])]) for i, l in enumerate(names)}


def train(labelled: DataFrame, max_docs: int = 1600, families: dict[str, str] | None = None) -> LangModel:
    """Fit the machines on rows ``(doc_id, text, lang)``; rows without text, letters or lang are passed over.

    Every value of lang is learned.  At most about ``max_docs`` rows, shared evenly by the
    languages, or ``PER_LANGUAGE`` rows of each where that is more, chosen by a hash of the
    id, become training vectors (made on the executors); that bound is the only sample.
    A sample above ``DENSE_ROWS`` stays sparse (some 0.3 MB a language) and its machines are
    fitted in Spark tasks.  No labelled row at all gives a model that answers ``und``.
    """
    rows = labelled.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return LangModel(np.zeros((1 << DIM_BITS, 0), np.float32), np.zeros(0, np.float32), [], [], [])
    quota = max(1, PER_LANGUAGE, max_docs // len(sizes))
    draw = F.pmod(F.xxhash64("doc_id", F.lit("langid")), F.lit(1_000_000))
    limits = labelled.sparkSession.createDataFrame(
        [(lang, int(1_000_000 * min(1.0, quota / n)) + 1) for lang, n in sizes.items()], "lang string, __below long")
    # one small row a language, of which the model holds a column each
    chosen = rows.select("doc_id", "text", "lang").join(F.broadcast(limits), "lang").where(draw < F.col("__below"))

    def vectors(batch: pa.RecordBatch) -> list[pa.Array]:
        out = [[] for _ in range(batch.num_rows)]
        for first, texts in text_chunks(batch, "text"):
            for i, t in enumerate(texts, first):
                x = features(t)
                if x is None:
                    continue
                at = np.flatnonzero(x)
                out[i] = np.stack([at, x[at]], axis=1).astype(np.float32).ravel()
        return [pa.array(out, pa.list_(pa.float32()))]

    drawn = add_columns(chosen.select("lang", "text"), vectors,
                        T.StructType([T.StructField("x", T.ArrayType(T.FloatType()))]), keep=["lang"]).toArrow()
    langs = np.array(drawn.column("lang").to_pylist(), object)
    parts = [np.asarray(v.values, np.float32) for v in drawn.column("x")]
    del drawn
    used = np.array([len(v) > 0 for v in parts], bool)
    parts, langs = [v for v in parts if len(v)], langs[used] if len(used) else langs
    if not parts:
        return LangModel(np.zeros((1 << DIM_BITS, 0), np.float32), np.zeros(0, np.float32), [], [], [])
    sample = Sample(np.cumsum([0] + [len(v) // 2 for v in parts]), np.concatenate([v[0::2].astype(np.uint16) for v in parts]),
                    np.concatenate([v[1::2] for v in parts]))
    del parts
    names = sorted(set(langs))
    means = np.zeros((len(names), 1 << DIM_BITS), np.float32)
    place = {l: i for i, l in enumerate(names)}
    for r, l in enumerate(langs):
        part = slice(sample.upto[r], sample.upto[r + 1])
        means[place[l], sample.at[part]] += sample.value[part]
    means /= means.sum(axis=1, keepdims=True)
    kin = kin_of(names, means, families or FAMILIES)
    del means
    fams = sorted(set(kin.values()))
    members = [[l for l in names if kin[l] == f] for f in fams]
    pairs = [(f, a, b) for f, m in enumerate(members) for a, b in combinations(range(len(m)), 2)]
    code, kin_code = np.array([place[l] for l in langs]), np.array([fams.index(kin[l]) for l in langs])
    jobs = [(f, -1, -1) for f in range(len(fams))] + [(f, place[members[f][a]], place[members[f][b]]) for f, a, b in pairs]

    def targets(some: list[tuple]) -> np.ndarray:
        return np.stack([np.where(kin_code == f, 1, -1) if a < 0 else (code == a).astype(int) - (code == b).astype(int)
                         for f, a, b in some], axis=1).astype(np.float32)

    if len(langs) <= DENSE_ROWS:
        w, b = fit_machines(sample.dense(np.arange(len(langs))), targets(jobs))
    else:
        w, b = _fit_in_tasks(labelled.sparkSession, sample, jobs, targets)
    return LangModel(w, b, fams, members, pairs)


def _fit_in_tasks(spark, sample: Sample, jobs: list[tuple], targets) -> tuple[np.ndarray, np.ndarray]:
    """All machines, ``MACHINES`` of them a row of a Spark job; the sparse sample is broadcast."""
    n = len(sample.upto) - 1
    mean = np.bincount(sample.at, weights=sample.value, minlength=1 << DIM_BITS) / n
    scale = (1 / np.sqrt(mean + 1e-6)).astype(np.float32)
    lip = np.float32(2 * (np.add.reduceat((sample.value * scale[sample.at]) ** 2, sample.upto[:-1]).max() + 1))
    shared = spark.sparkContext.broadcast(sample)
    groups = [jobs[i:i + MACHINES] for i in range(0, len(jobs), MACHINES)]

    def fit(batches):
        for batch in batches:
            for g in batch.column("id").to_pylist():
                w, b = fit_in_blocks(shared.value, targets(groups[g]), scale, lip)
                yield pa.RecordBatch.from_arrays([pa.array([g], pa.int64()), pa.array([w.tobytes()], pa.binary()),
                                                  pa.array([b.tobytes()], pa.binary())], names=["id", "w", "b"])

    got = {r["id"]: r for r in spark.range(0, len(groups), 1, len(groups)).mapInArrow(fit, "id long, w binary, b binary").collect()}
    w = np.concatenate([np.frombuffer(got[g]["w"], np.float32).reshape(1 << DIM_BITS, -1) for g in range(len(groups))], axis=1)
    return w, np.concatenate([np.frombuffer(got[g]["b"], np.float32) for g in range(len(groups))])


def score_texts(texts: list, model: LangModel) -> tuple[list[str], np.ndarray]:
    """Language and confidence of each text."""
    langs, conf = [UNKNOWN] * len(texts), np.zeros(len(texts))
    if not model.families:
        return langs, conf
    rows, margins = [], []
    for i, t in enumerate(texts):
        x = features(t)
        if x is not None:
            rows.append(i)
            margins.append(x @ model.weights + model.bias)
    if rows:
        got, sure = model.decide(np.stack(margins).astype(np.float64))
        for i, l, s in zip(rows, got, sure):
            langs[i], conf[i] = l, s
    return langs, conf


def lettered(docs: DataFrame) -> DataFrame:
    """The rows whose text holds a letter, the ones that ``identify`` can name a language for."""

    def keep(batches):
        for batch in batches:
            good = [t is not None and any(fold(t[i:i + CHUNK_CHARS]).any() for i in range(0, len(t), CHUNK_CHARS))
                    for _, texts in text_chunks(batch, "text") for t in texts]
            yield batch.filter(pa.array(good, pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)


def identify(docs: DataFrame, model: LangModel, keep: list[str] | None = None) -> DataFrame:
    """Append ``lang_pred`` and ``score`` (0 to 1) to every row, from its whole text alone.

    Null texts and texts without a letter give ``und`` with score 0; so does a model
    without languages.  Repeated rows get equal results; columns that clash with the two
    new ones are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # slots x machines floats: bounded by the languages

    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        langs, scores = [], []
        for _, texts in text_chunks(batch, "text"):
            a, b = score_texts(texts, shared.value)
            langs += a
            scores.append(b)
        return [pa.array(langs, pa.string()), pa.array(np.concatenate(scores) if scores else np.zeros(0), pa.float64())]

    return add_columns(docs, run, T.StructType([T.StructField("lang_pred", T.StringType()),
                                                T.StructField("score", T.DoubleType())]), keep)
