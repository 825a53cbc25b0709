"""Byte-pair-encoding vocabulary training on DataFrames.

Data layout
-----------
* ``work(syms, freq)``: every distinct pre-token that still has two symbols or more,
  with its frequency (a word that became one symbol can never merge again and leaves).
* ``pairs(l, r, n)``: weighted adjacent-pair counts, hash-clustered by ``(l, r)``.

Both stay distributed.  A round is one job: the driver receives only the head of
``pairs`` in merge order (at most ``head`` rows).

Exact batching
--------------
From the ordered head ``p1 > p2 > ...`` (order: ``n`` desc, then greatest byte pair) a
prefix is accepted and applied in order with one rewrite.  Merging ``p = (a, b)`` only
*lowers* counts of existing pairs that touch it, ``(x, a)`` and ``(b, y)``, and creates
pairs with the new symbol whose counts are bounded by those touching pairs (and by
``n(p)`` itself when ``a == b``).  So ``pj`` is still the true arg-max after the accepted
prefix when

1. it does not touch an accepted pair (its count is unchanged), and
2. its count is strictly above every bound of the accepted pairs, and
3. the merged symbol of every accepted pair is new (else existing pairs could grow; such
   a merge is only ever accepted alone).

Every pair whose count is above the head's smallest count stands in the head, so the
bounds that matter are read from the head itself; a candidate at that smallest count is
left for the next round.  The result equals one merge per round, merge for merge (tests
prove it).

By default the batches are longer than that rule allows: ``foresight`` proposes them from a
sample of the words and checks them over all, which are held as ``blocks`` of arrays then.
The rule is what remains with ``foresight_words=0``.

A round of the rule rewrites the words with a fold of literal ``replace`` calls.  The words that
changed give ``-old`` and ``+new`` pair rows; their sums are the only rows shuffled, as
they are united with counts that are clustered alike.  Every ``checkpoint_every`` rounds
both tables are written to the shared checkpoint folder, which cuts the lineage; lost
cache blocks recompute from there.  The width of the loop's shuffles follows the number
of pairs at every cut.  The loop runs in a session of its own, so the settings of the
caller's session stay as they are.
"""

from __future__ import annotations

import json
import os
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.patterns import END_OF_TEXT
from ..functions.symbols import apply_merges_data
from ..operators.pairs import pair_order, pair_counts, pair_rows
from ..operators.pretokenize import count_words, with_symbols
from ..session import delete_path, ensure_checkpoint_dir, scratch_path
from .blocks import BLOCKS_PER_TASK, Symbols, block_changes, block_pair_counts, blocks_with, packed, unpacked
from .foresight import Foresight, accepted_prefix, counts_with, most_frequent, touched_above


@dataclass
class BPEModel:
    """Trained vocabulary: specials and the ordered merges, all as hex.

    The merge list is bounded by ``vocab_size`` (a parameter), so it is safe to
    hold on the driver and to broadcast.
    """

    specials: list[str]
    merges: list[tuple[str, str, int]] = field(default_factory=list)  # (l_hex, r_hex, pair_count)
    byte_freq: dict[int, int] = field(default_factory=dict)
    rounds: int = 0

    @property
    def n_base(self) -> int:
        return 256 + len(self.special_ids())

    def special_ids(self) -> dict[str, int]:
        """Specials get ids from 256 in order; one whose bytes already exist is skipped."""
        out: dict[str, int] = {}
        taken = {bytes([i]) for i in range(256)}
        for s in self.specials:
            b = s.encode("utf-8")
            if b in taken:
                continue
            taken.add(b)
            out[s] = 256 + len(out)
        return out

    def merge_rows(self) -> list[tuple[int, str, str, int, int]]:
        """``(rank, l, r, merged id, pair count)``; a merge that spells a known token keeps its id."""
        ids = {h: i for i, h in enumerate(self._first_hexes())}
        return [(i, l, r, ids.setdefault(l + r, len(ids)), n) for i, (l, r, n) in enumerate(self.merges)]

    def _first_hexes(self) -> list[str]:
        return [f"{i:02X}" for i in range(256)] + [x.encode("utf-8").hex().upper() for x in self.special_ids()]

    def vocab_rows(self) -> list[tuple[int, str, int, bool]]:
        """``(token_id, token_hex, token_freq, is_special)`` in id order, one row a byte string."""
        rows = [(i, h, int(self.byte_freq.get(i, 0)) if i < 256 else 0, i >= 256) for i, h in enumerate(self._first_hexes())]
        for _, l, r, mid, n in self.merge_rows():
            if mid == len(rows):
                rows.append((mid, l + r, n, False))
        return rows

    def token_bytes(self) -> list[bytes]:
        """Bytes of every id (index = id)."""
        return [bytes.fromhex(h) for _, h, _, _ in self.vocab_rows()]

    def vocab_df(self, spark: SparkSession) -> DataFrame:
        return (spark.createDataFrame(self.vocab_rows(), "token_id int, token_hex string, token_freq bigint, is_special boolean")
                .withColumn("token_bytes", F.unhex("token_hex")))

    def merges_df(self, spark: SparkSession) -> DataFrame:
        return (spark.createDataFrame(self.merge_rows(), "rank int, left_hex string, right_hex string, merged_id int, pair_count bigint")
                .withColumn("left_bytes", F.unhex("left_hex"))
                .withColumn("right_bytes", F.unhex("right_hex")))

    def to_json(self) -> str:
        return json.dumps({"specials": self.specials, "merges": self.merges,
                           "byte_freq": {str(k): v for k, v in self.byte_freq.items()}, "rounds": self.rounds})

    @classmethod
    def from_json(cls, s: str) -> BPEModel:
        d = json.loads(s)
        return cls(d["specials"], [tuple(m) for m in d["merges"]],
                   {int(k): v for k, v in d.get("byte_freq", {}).items()}, d.get("rounds", 0))


# --- the batch rule (driver side, on at most ``head`` rows) -------------------------

def choose_batch(head: list[tuple[str, str, int]], budget: int, known: set[str], batched: bool = True,
                 floor: int = -1) -> tuple[list[tuple[str, str, int]], bool]:
    """Longest prefix of ``head`` that equals one-merge-at-a-time training.

    ``floor`` is the head's smallest count if pairs were left out of it, else -1.
    Returns the accepted merges and whether the (then only) merge produced a symbol that
    already existed.  ``known`` is updated with the new symbols.
    """
    max_in: dict[str, int] = {}
    max_out: dict[str, int] = {}
    for l, r, n in head:
        max_in[r] = max(n, max_in.get(r, 0))
        max_out[l] = max(n, max_out.get(l, 0))
    accepted: list[tuple[str, str, int]] = []
    lefts: set[str] = set()
    rights: set[str] = set()
    bound = floor
    for l, r, n in head:
        if len(accepted) >= budget:
            break
        merged = l + r
        if accepted:
            if n <= bound or l in rights or r in lefts or merged in known:
                break
        accepted.append((l, r, n))
        if merged in known:
            return accepted, True  # merged bytes already a symbol: existing pairs may grow
        known.add(merged)
        if not batched:
            break
        lefts.add(l)
        rights.add(r)
        bound = max(bound, max_in.get(l, 0), max_out.get(r, 0), n if l == r else 0)
    return accepted, False


def fetch_head(pairs: DataFrame, head: int) -> list[tuple[str, str, int]]:
    """The first ``head`` pairs in merge order, in one job."""
    return [(x.l, x.r, int(x.n)) for x in pairs.orderBy(*pair_order()).limit(head).collect()]


# --- training ------------------------------------------------------------------

@dataclass
class TrainOptions:
    head: int = 2048            # rows that the driver receives a round
    batched: bool = True
    foresight_words: int = 1 << 17  # the most frequent words, held by the driver to foresee merges; 0: none
    most_merges: int = 256      # foreseen a round, at most; about twice as many as the last round accepted
    checkpoint_every: int = 24  # rounds between cuts
    foresight_cut: int = 6      # the same where merges are foreseen: fewer and longer rounds
    pairs_per_task: int = 100_000
    state_dir: str | None = None
    save_every: int | None = None  # save state every this many new ids


def shuffle_width(n_pairs: int, cores: int, per_task: int = 100_000) -> int:
    """Tasks of the loop's shuffles: as many as the pair table fills, and all cores once it has a few rows for each."""
    return max(1, -(-n_pairs // per_task), min(cores, -(-n_pairs // 2_000)))


def word_table(corpus: DataFrame, specials: list[str], text_col: str = "text") -> DataFrame:
    """Distinct pre-tokens with frequency and byte symbols."""
    return with_symbols(count_words(corpus, text_col, specials, drop_specials=True))


def train_bpe(corpus: DataFrame, vocab_size: int, specials: list[str] | None = None,
              text_col: str = "text", options: TrainOptions | None = None,
              words: DataFrame | None = None, resume: tuple[BPEModel, DataFrame] | None = None) -> BPEModel:
    """Train a BPE vocabulary of ``vocab_size`` ids on a text DataFrame.

    ``words`` may pass a precomputed ``(word|syms, freq)`` table (cached counts);
    ``resume`` continues from a saved ``(model, work)`` state (I4).
    """
    opts = options or TrainOptions()
    specials = [END_OF_TEXT] if specials is None else ([specials] if isinstance(specials, str) else list(specials))
    src = corpus if corpus is not None else (words if words is not None else resume[1])
    spark = src.sparkSession
    ensure_checkpoint_dir(spark)

    held = None
    if resume is not None:
        model, work = resume
        model = BPEModel(list(model.specials), list(model.merges), dict(model.byte_freq), model.rounds)
    else:
        if words is None:
            words = word_table(corpus, specials, text_col)
        elif "syms" not in words.columns:
            words = with_symbols(words)
        work = held = words.persist()
        model = BPEModel(specials)
        model.byte_freq = _byte_freq(words)
    work = work.select("syms", "freq").filter(F.instr("syms", "><") > 0)
    try:
        if vocab_size > len(model.vocab_rows()):
            _Trainer(spark, model, opts, vocab_size).run(work)
    finally:
        if held is not None:
            held.unpersist()
    return model


class _Trainer:
    """The merge loop over written tables, in a session of its own."""

    def __init__(self, spark: SparkSession, model: BPEModel, opts: TrainOptions, vocab_size: int):
        self.spark, self.model, self.opts, self.vocab_size = spark, model, opts, vocab_size
        self.cores = spark.sparkContext.defaultParallelism
        self.loop = spark.newSession()
        self.loop.conf.set("spark.sql.adaptive.enabled", "false")  # the loop's plans are clustered beforehand
        self.loop.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BLOCKS_PER_TASK // 4))  # blocks are rows of 1 MB and more
        self.files: list[str] = []

    def _width(self, n_pairs: int) -> int:
        width = shuffle_width(n_pairs, self.cores, self.opts.pairs_per_task)
        self.loop.conf.set("spark.sql.shuffle.partitions", str(width))
        return width

    def _stored(self, df: DataFrame, name: str) -> DataFrame:
        """``df`` written to the shared folder and read by the loop's session."""
        path = scratch_path(self.spark, name)
        df.write.parquet(path)
        self.files.append(path)
        return self.loop.read.schema(df.schema).parquet(path)

    def _dealt(self, blocks: DataFrame) -> DataFrame:
        """Stored blocks, spread over all cores and no more than ``BLOCKS_PER_TASK`` a task, kept."""
        return blocks.repartition(max(2 * self.cores, -(-blocks.count() // BLOCKS_PER_TASK))).persist()

    def run(self, work: DataFrame) -> None:
        """Merge by merge where merges are not foreseen, else in long batches over blocks of words."""
        opts = self.opts
        if opts.batched and opts.foresight_words > 0 and self.vocab_size - len(self.model.vocab_rows()) > 1:
            self._run_foreseen(work)
        else:
            self._run_rule(work)

    def _known(self) -> set[str]:
        return {h for _, h, _, _ in self.model.vocab_rows() if h not in
                {x.encode("utf-8").hex().upper() for x in self.model.special_ids()}}

    def _run_foreseen(self, work: DataFrame) -> None:
        model, opts = self.model, self.opts
        size = last_saved = len(model.vocab_rows())
        known, since_cut = self._known(), 0
        symbols = Symbols([f"{i:02X}" for i in range(256)] + [l + r for l, r, _ in model.merges])
        sample = most_frequent(work, opts.foresight_words)
        most = opts.most_merges if len(sample) < opts.foresight_words else 32  # below: the sample is all there is
        ahead = Foresight(sample)
        cut_every = min(opts.checkpoint_every, opts.foresight_cut)
        self._width(min(len(sample) * 4, 1 << 16))  # byte pairs
        work = self._dealt(self._stored(packed(work, symbols), "bpe-blocks"))
        pairs = block_pair_counts(work, symbols).persist()
        held, old_files = [work, pairs], []
        beside = ThreadPoolExecutor(1)  # the sample is brought up to date while a job runs
        following = None
        while size < self.vocab_size:
            head = fetch_head(pairs, opts.head)
            if following is not None:
                following.result()
            for path in old_files:
                delete_path(self.spark, path)
            old_files = []
            while len(held) > 6:  # tables before the last round's are not read again
                held.pop(0).unpersist()
            if not head:
                break  # D14: no pair left
            floor = head[-1][2] if len(head) == opts.head else -1
            foreseen = ahead.foresee(head, floor, min(most, opts.most_merges, self.vocab_size - size))
            changes = block_changes(work, foreseen, symbols.with_merges(foreseen), known).persist()
            accepted = accepted_prefix(head, touched_above(pairs, changes, floor), foreseen, floor)
            following = beside.submit(ahead.settle, len(accepted))
            most = max(32, (2 if len(accepted) < len(foreseen) else 4) * len(accepted))
            merges = [(l, r) for l, r, _ in accepted]
            symbols = symbols.with_merges(merges)
            work = blocks_with(work, merges, symbols, known).persist()
            size += len({l + r for l, r in merges} - known)
            known.update(l + r for l, r in merges)
            pairs = counts_with(pairs, changes, len(accepted)).persist()
            held += [changes, work, pairs]
            model.merges.extend(accepted)
            model.rounds += 1
            since_cut += 1
            save = bool(opts.state_dir and opts.save_every and size - last_saved >= opts.save_every)
            if size < self.vocab_size and (save or since_cut >= cut_every):
                old_files, self.files = self.files, []
                work = self._dealt(self._stored(work, "bpe-blocks"))
                pairs = self._stored(pairs, "bpe-pairs")
                pairs = pairs.repartition(self._width(pairs.count()), "l", "r").persist()
                held += [work, pairs]
                since_cut = 0
                if save:
                    save_state(self.spark, opts.state_dir, model, unpacked(work, symbols))
                    last_saved = size
        beside.shutdown()
        if opts.state_dir:
            save_state(self.spark, opts.state_dir, model, unpacked(work, symbols))
        self._release(held, old_files)

    def _run_rule(self, work: DataFrame) -> None:
        model, opts = self.model, self.opts
        size = last_saved = len(model.vocab_rows())
        known, since_cut = self._known(), 0
        work = self._stored(work, "bpe-words").persist()
        self._width(min(work.count() * 4, 1 << 16))  # byte pairs
        pairs = pair_counts(work).persist()
        held, old_files = [work, pairs], []
        while size < self.vocab_size:
            head = fetch_head(pairs, opts.head)
            for path in old_files:
                delete_path(self.spark, path)
            old_files = []
            while len(held) > 4:  # tables before the last round's are not read again
                held.pop(0).unpersist()
            if not head:
                break  # D14: no pair left
            floor = head[-1][2] if len(head) == opts.head else -1
            accepted, again = choose_batch(head, self.vocab_size - size, known, opts.batched, floor)
            size += 0 if again else len(accepted)
            step = rewritten(work, [(l, r) for l, r, _ in accepted]).persist()  # read twice: changes now, words next
            work, pairs = words_after(step), counts_after(pairs, step).persist()
            held += [step, pairs]
            model.merges.extend(accepted)
            model.rounds += 1
            since_cut += 1
            save = bool(opts.state_dir and opts.save_every and size - last_saved >= opts.save_every)
            if size < self.vocab_size and (save or since_cut >= opts.checkpoint_every):
                old_files, self.files = self.files, []
                work = self._stored(work, "bpe-words").persist()
                pairs = self._stored(pairs, "bpe-pairs")
                pairs = pairs.repartition(self._width(pairs.count()), "l", "r").persist()
                held += [work, pairs]
                since_cut = 0
                if save:
                    save_state(self.spark, opts.state_dir, model, work)
                    last_saved = size
        if opts.state_dir:
            save_state(self.spark, opts.state_dir, model, work)
        self._release(held, old_files)

    def _release(self, held: list[DataFrame], old_files: list[str]) -> None:
        for df in held:
            df.unpersist()
        for path in self.files + old_files:
            delete_path(self.spark, path)


def rewritten(work: DataFrame, merges: list[tuple[str, str]]) -> DataFrame:
    """``(syms, new, freq)``: every word before and after ``merges``."""
    return work.select("syms", apply_merges_data(F.col("syms"), merges).alias("new"), "freq")


def words_after(step: DataFrame) -> DataFrame:
    """The working words of a rewriting."""
    return step.select(F.col("new").alias("syms"), "freq").filter(F.instr("syms", "><") > 0)


def counts_after(pairs: DataFrame, step: DataFrame) -> DataFrame:
    """Pair counts after a rewriting.

    Only the words that change give rows, and only their summed rows are shuffled: the
    counts are clustered by ``(l, r)`` as the sums are, and stay where they are.
    """
    changed = step.filter("syms <> new")
    delta = (pair_rows(changed, sign=-1).unionByName(pair_rows(changed.select(F.col("new").alias("syms"), "freq")))
             .groupBy("l", "r").agg(F.sum("w").alias("n")))
    return pairs.unionByName(delta).groupBy("l", "r").agg(F.sum("n").alias("n")).filter(F.col("n") > 0)


def _byte_freq(words: DataFrame) -> dict[int, int]:
    from ..operators.pretokenize import byte_frequencies
    return {int(r.byte): int(r.freq) for r in byte_frequencies(words).collect()}  # ≤ 256 rows


# --- state (I4) -----------------------------------------------------------------

def save_state(spark: SparkSession, state_dir: str, model: BPEModel, work: DataFrame) -> str:
    """Write the working words, then ``model``, under ``size=NNNNNNN``: a state with a model is complete."""
    path = os.path.join(state_dir, f"size={len(model.special_ids()) + 256 + len(model.merges):07d}")
    work.select("syms", "freq").write.mode("overwrite").parquet(os.path.join(path, "work"))
    spark.createDataFrame([(model.to_json(),)], "model string").write.mode("overwrite").parquet(os.path.join(path, "model"))
    return path


def latest_state(spark: SparkSession, state_dir: str) -> tuple[int, str] | None:
    """Greatest saved size that has both its words and its model (other names are skipped)."""
    jvm = spark._jvm
    conf = spark._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(state_dir)
    fs = p.getFileSystem(conf)
    if not fs.exists(p):
        return None
    best = None
    for st in fs.listStatus(p):
        digits = st.getPath().getName().partition("size=")[2].strip()
        whole = all(fs.exists(jvm.org.apache.hadoop.fs.Path(st.getPath(), f"{part}/_SUCCESS")) for part in ("work", "model"))
        if digits.isdigit() and whole and (best is None or int(digits) > best[0]):
            best = (int(digits), st.getPath().toString())
    return best


def load_state(spark: SparkSession, path: str) -> tuple[BPEModel, DataFrame]:
    """Model and working words of a saved state; a state without words raises."""
    model = BPEModel.from_json(spark.read.parquet(os.path.join(path, "model")).first()["model"])
    return model, spark.read.schema("syms string, freq bigint").parquet(os.path.join(path, "work"))


def resume_train_bpe(spark: SparkSession, state_dir: str, vocab_size: int,
                     options: TrainOptions | None = None) -> BPEModel:
    """I4: continue training from the newest complete state; raises where there is none."""
    found = latest_state(spark, state_dir)
    if found is None:
        raise FileNotFoundError(f"no complete saved state under {state_dir}")
    model, work = load_state(spark, found[1])
    return train_bpe(None, vocab_size, model.specials, options=options, resume=(model, work))
