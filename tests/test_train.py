from collections import Counter

import pytest
import regex

from mergeloom.functions.display import undisplay
from mergeloom.plans.train import (BPEModel, TrainOptions, choose_batch, latest_state, resume_train_bpe, shuffle_width,
                                   train_bpe)

from .conftest import fixture_path
from .test_pretokenize import PY_PATTERN


def brute_force_bpe(texts, n_merges):
    """One merge at a time over a word counter (ties: greatest byte pair)."""
    words = Counter()
    for t in texts:
        for w in regex.findall(PY_PATTERN, t):
            words[tuple(bytes([b]) for b in w.encode())] += 1
    merges = []
    for _ in range(n_merges):
        pairs = Counter()
        for w, f in words.items():
            for a, b in zip(w, w[1:]):
                pairs[(a, b)] += f
        if not pairs:
            break
        best = max(pairs.items(), key=lambda kv: (kv[1], kv[0]))[0]
        merges.append(best)
        new = Counter()
        for w, f in words.items():
            out, i = [], 0
            while i < len(w):
                if i < len(w) - 1 and (w[i], w[i + 1]) == best:
                    out.append(w[i] + w[i + 1])
                    i += 2
                else:
                    out.append(w[i])
                    i += 1
            new[tuple(out)] += f
        words = new
    return [(a.hex().upper(), b.hex().upper()) for a, b in merges]


def indexed_bpe(texts, n_merges):
    """One merge at a time, pairs looked up in an index of words: fast enough for thousands of merges."""
    words = Counter(w.encode() for t in texts for w in regex.findall(PY_PATTERN, t))
    held = [([bytes([b]) for b in w], f) for w, f in words.items()]
    count, places = Counter(), {}
    for i, (w, f) in enumerate(held):
        for p in zip(w, w[1:]):
            count[p] += f
            places.setdefault(p, set()).add(i)
    merges = []
    while len(merges) < n_merges:
        best = max(count, key=lambda p: (count[p], p), default=None)
        if best is None or count[best] <= 0:
            break
        merges.append((best[0].hex().upper(), best[1].hex().upper()))
        for i in list(places.pop(best)):
            w, f = held[i]
            out, k = [], 0
            while k < len(w):
                step = 2 if tuple(w[k:k + 2]) == best else 1
                out.append(b"".join(w[k:k + step]))
                k += step
            for p in zip(w, w[1:]):
                count[p] -= f
            for p in zip(out, out[1:]):
                count[p] += f
                places.setdefault(p, set()).add(i)
            held[i] = (out, f)
        count = +count
    return merges


def test_matches_a_plain_counter_over_2000_ids(spark, small_docs):
    """A production-like vocabulary with default options, then its encoding against one merge after the other."""
    from mergeloom.operators.encode import decode_ids, encode
    texts = [r.text for r in small_docs.collect()]
    want = indexed_bpe(texts, 2000 - 257)
    assert want[:60] == brute_force_bpe(texts, 60)
    m = train_bpe(small_docs, 2000)
    assert [(l, r) for l, r, _ in m.merges] == want and m.rounds < 40
    ids = {b: i for i, b in reversed(list(enumerate(m.token_bytes())))}
    rank = {(bytes.fromhex(l), bytes.fromhex(r)): i for i, (l, r) in reversed(list(enumerate(want)))}
    got = encode(small_docs, m).select("text", "ids", decode_ids("ids", m).alias("back")).limit(30).collect()
    for r in got:
        out = []
        for w in regex.findall(PY_PATTERN, r.text):
            s = [bytes([b]) for b in w.encode()]
            while len(s) > 1:
                i = min(range(len(s) - 1), key=lambda k: rank.get((s[k], s[k + 1]), 1 << 30))
                if (s[i], s[i + 1]) not in rank:
                    break
                s[i:i + 2] = [s[i] + s[i + 1]]
            out += [ids[x] for x in s]
        assert r.ids == out and r.back == r.text


@pytest.mark.parametrize("held", [1, 5, 40, 400])
def test_foresight_on_a_poor_sample_changes_nothing(spark, small_docs, held):
    a = train_bpe(small_docs, 257 + 45, options=TrainOptions(foresight_words=held, head=300, foresight_cut=2))
    b = train_bpe(small_docs, 257 + 45, options=TrainOptions(foresight_words=0))
    assert a.merges == b.merges


def test_foresight_takes_back_what_was_not_accepted():
    from mergeloom.plans.foresight import Foresight, WordPairs
    words = [("<61><62><61><62>", 5), ("<62><61><62>", 3), ("<63><61><62><63>", 2), ("<61><61><61>", 4)]
    ahead = Foresight(words)
    fresh = Foresight(words).sample
    foreseen = ahead.foresee([("61", "62", 15), ("61", "61", 8), ("62", "61", 8)], -1, 10)
    assert foreseen[0] == ("61", "62") and len(foreseen) > 2
    ahead.settle(1)
    fresh.merge("61", "62")
    assert ahead.sample.words == fresh.words and +Counter(ahead.sample.count) == +Counter(fresh.count)
    again = WordPairs((list(w), f) for w, f in zip(fresh.words, fresh.freqs))
    assert +Counter(again.count) == +Counter(fresh.count)


def test_batches_end_where_the_foresight_errs():
    from mergeloom.plans.foresight import accepted_prefix
    head = [("61", "62", 10), ("63", "64", 9), ("65", "66", 8)]
    touched = [("61", "62", 10, [(0, -10)]), ("63", "64", 9, [(1, -9)]), ("6162", "67", 0, [(0, 9)])]
    # the pair that the first merge makes is as frequent as the second one and greater: it comes first
    assert accepted_prefix(head, touched, [("61", "62"), ("63", "64")], -1) == [("61", "62", 10), ("63", "64", 9)]
    touched[-1] = ("6862", "67", 0, [(0, 9)])
    assert accepted_prefix(head, touched, [("61", "62"), ("63", "64")], -1) == [("61", "62", 10)]
    assert accepted_prefix(head, touched, [("61", "62"), ("6862", "67")], 9) == [("61", "62", 10)]


def test_matches_brute_force_on_documents(spark, small_docs):
    texts = [r.text for r in small_docs.collect()]
    want = brute_force_bpe(texts, 60)
    m = train_bpe(small_docs, 257 + 60)
    assert [(l, r) for l, r, _ in m.merges] == want
    assert m.rounds < 60  # several merges per round


def test_matches_brute_force_over_a_whole_small_vocabulary(spark, small_docs):
    """243 merges, one after the other, by a plain word counter: the size of a 500-id vocabulary."""
    docs = small_docs.filter("doc_id < 40").persist()
    want = brute_force_bpe([r.text for r in docs.collect()], 243)
    assert [(l, r) for l, r, _ in train_bpe(docs, 500).merges] == want
    docs.unpersist()


def test_batched_equals_one_per_round(spark, small_docs):
    a = train_bpe(small_docs, 257 + 40, options=TrainOptions(batched=True, checkpoint_every=3))
    b = train_bpe(small_docs, 257 + 40, options=TrainOptions(batched=False))
    assert a.merges == b.merges
    assert b.rounds == 40


def test_golden_merges_and_vocab(spark):
    text = open(fixture_path("corpus.en"), encoding="utf-8").read()
    df = spark.createDataFrame([(0, text)], "doc_id long, text string")
    m = train_bpe(df, 500, ["<|endoftext|>"])
    gold = []
    for line in open(fixture_path("train-bpe-reference-merges.txt"), encoding="utf-8"):
        a, b = line.rstrip().split(" ")
        gold.append((undisplay(a).hex().upper(), undisplay(b).hex().upper()))
    assert [(l, r) for l, r, _ in m.merges] == gold
    import json
    ref = json.load(open(fixture_path("train-bpe-reference-vocab.json"), encoding="utf-8"))
    ref_vals = {undisplay(k) for k in ref}
    ours = {bytes.fromhex(h) for _, h, _, _ in m.vocab_rows()}
    assert ours == ref_vals
    assert {i for i, _, _, _ in m.vocab_rows()} == set(ref.values())


def test_choose_batch_rules():
    head = [("61", "62", 100), ("63", "64", 90), ("62", "65", 80), ("66", "67", 10)]
    # (63,64) beats every bound of (61,62); (62,65) touches (61,62) on the right symbol 62
    got, dup = choose_batch(head, 10, {"61", "62"})
    assert [m[:2] for m in got] == [("61", "62"), ("63", "64")] and not dup
    # a pair that enters 61 stops the batch at its count
    got, _ = choose_batch([("61", "62", 100), ("65", "61", 95), ("63", "64", 90)], 10, set())
    assert [m[:2] for m in got] == [("61", "62")]
    # a == b ends the batch (its own count is a bound)
    got, _ = choose_batch([("61", "61", 100), ("63", "64", 90)], 10, set())
    assert len(got) == 1
    # merged bytes already known: accepted alone, flagged
    got, dup = choose_batch(head, 10, {"6162"})
    assert len(got) == 1 and dup
    # pairs were left out of the head: a candidate at its smallest count waits
    got, _ = choose_batch(head[:2], 10, set(), floor=90)
    assert len(got) == 1


@pytest.mark.parametrize("seed", range(3))
def test_batches_on_crowded_alphabets(spark, seed):
    """Few letters: nearly every pair touches another, runs of one letter overlap themselves."""
    import random
    r = random.Random(seed)
    texts = [" ".join("".join(r.choice("aab" if seed else "abc") for _ in range(r.randrange(1, 12))) for _ in range(60)) for _ in range(8)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    m = train_bpe(df, 257 + 40, options=TrainOptions(head=40))
    want = brute_force_bpe(texts, len(m.merges))
    assert [(l, r) for l, r, _ in m.merges] == want


def test_small_heads_give_the_same_merges(spark, small_docs):
    a = train_bpe(small_docs, 257 + 30, options=TrainOptions(head=7, checkpoint_every=5))
    b = train_bpe(small_docs, 257 + 30)
    assert a.merges == b.merges


def test_one_id_per_byte_string():
    # ("61","6262") and ("6162","62") spell the same bytes: the second keeps the first one's id
    m = BPEModel(["<|endoftext|>", "abb"], [("61", "62", 9), ("62", "62", 8), ("61", "6262", 7), ("6162", "62", 5), ("63", "64", 4)])
    assert [r[3] for r in m.merge_rows()] == [258, 259, 257, 257, 260]
    rows = m.vocab_rows()
    assert [r[0] for r in rows] == list(range(261)) and len({r[1] for r in rows}) == 261


def test_shuffle_width_follows_the_pair_table():
    widths = [shuffle_width(n, 8) for n in (10, 5_000, 60_000, 10 ** 6, 10 ** 8)]
    assert widths == sorted(widths) and widths[0] == 1 and widths[2] == 8 and widths[-1] == 1000


def test_training_leaves_the_session_as_it_was(spark, small_docs):
    keys = ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")
    before = [spark.conf.get(k) for k in keys]
    train_bpe(small_docs, 257 + 3)
    assert [spark.conf.get(k) for k in keys] == before


def test_resume_from_saved_state(spark, small_docs, tmp_path):
    state = str(tmp_path / "state")
    train_bpe(small_docs, 257 + 12, options=TrainOptions(state_dir=state, save_every=4))
    resumed = resume_train_bpe(spark, state, 257 + 25)
    full = train_bpe(small_docs, 257 + 25)
    assert resumed.merges == full.merges


def test_model_json_round_trip():
    m = BPEModel(["<|endoftext|>"], [("61", "62", 3)], {97: 5})
    assert BPEModel.from_json(m.to_json()) == m


def test_stops_when_no_pairs(spark):
    df = spark.createDataFrame([(0, "ab ab")], "doc_id long, text string")
    m = train_bpe(df, 1000)
    assert len(m.merges) < 10


@pytest.mark.parametrize("special", ["a", "<|endoftext|>"])
def test_special_ids(special):
    m = BPEModel([special, "<|pad|>"])
    ids = m.special_ids()
    assert ids["<|pad|>"] == (256 if special == "a" else 257)


def test_resume_needs_a_complete_state(spark, small_docs, tmp_path):
    import shutil
    state = str(tmp_path / "state")
    train_bpe(small_docs, 257 + 6, options=TrainOptions(batched=False, state_dir=state, save_every=3))
    newest = latest_state(spark, state)[1].removeprefix("file:")
    shutil.rmtree(newest + "/work")
    older = latest_state(spark, state)
    assert older is not None and older[1].removeprefix("file:") != newest
    assert resume_train_bpe(spark, state, 257 + 9).merges == train_bpe(small_docs, 257 + 9).merges
    shutil.rmtree(older[1].removeprefix("file:") + "/work")
    with pytest.raises(FileNotFoundError):
        resume_train_bpe(spark, state, 257 + 9)
