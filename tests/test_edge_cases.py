"""Rows that used to be dropped, changed or costly."""

import random
import time

import pytest
from pyspark.sql import functions as F

from mergeloom.operators import batches as B
from mergeloom.operators import encode as E
from mergeloom.operators import scores as S
from mergeloom.operators.pretokenize import pretoken_array
from mergeloom.operators.vocab import byte_undisplay
from mergeloom.plans.train import BPEModel
from mergeloom.sources import corpus as corpus_source
from mergeloom.sources.corpus import read_corpus, write_corpus
from mergeloom.streaming.streams import count_words_stream, run_to_end, running_counts, stream_table

EOT = "<|endoftext|>"


@pytest.fixture(scope="module")
def model():
    return BPEModel([EOT], [("20", "61", 9), ("61", "62", 8), ("2061", "62", 7), ("6162", "6162", 6), ("62", "62", 5), ("61", "6262", 4)])


def test_corpus_keeps_genuine_replacement_characters_and_empty_documents(spark, tmp_path):
    p = tmp_path / "c.txt"
    p.write_bytes("a�b\x01c\x010".encode() + b"\xff" + EOT.encode() * 2 + b"y\xe2\x82" + EOT.encode())
    rows = read_corpus(spark, str(p)).orderBy("doc_id").collect()
    assert [(r.doc_id, r.text) for r in rows] == [(0, "a�b\x01c\x010"), (1, ""), (2, "y")]


def test_corpus_ids_do_not_depend_on_splits(spark, tmp_path):
    docs = spark.createDataFrame([(f"text {i} " + "x" * (i % 50),) for i in range(500)], "text string").repartition(3)
    write_corpus(docs, str(tmp_path / "c"))
    whole = {r.doc_id: r.text for r in read_corpus(spark, str(tmp_path / "c")).collect()}
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "2000")
    try:
        split = {r.doc_id: r.text for r in read_corpus(spark, str(tmp_path / "c")).collect()}
    finally:
        spark.conf.set(key, before)
    assert whole == split and sorted(whole) == list(range(500))


def test_corpus_files_are_scanned_once(spark, tmp_path):
    """What is read back comes from the scratch table alone, also when the files are gone."""
    write_corpus(spark.createDataFrame([("a",), ("",), ("c",)], "text string").coalesce(1), str(tmp_path / "c"))
    corpus = read_corpus(spark, str(tmp_path / "c"))
    assert str(tmp_path) not in corpus._jdf.queryExecution().executedPlan().toString()
    for f in (tmp_path / "c").iterdir():
        f.write_bytes(b"") if f.name.startswith("part") else None
    assert [(r.doc_id, r.text) for r in corpus.orderBy("doc_id").collect()] == [(0, "a"), (1, ""), (2, "c")]


def test_corpus_ids_meet_in_a_shuffle_beyond_the_broadcast_bound(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(corpus_source, "MAX_BROADCAST_SPLITS", 1)
    docs = spark.createDataFrame([(f"text {i}",) for i in range(40)], "text string").repartition(4)
    write_corpus(docs, str(tmp_path / "c"))
    assert sorted(r.doc_id for r in read_corpus(spark, str(tmp_path / "c")).collect()) == list(range(40))


def test_corpus_of_empty_files_has_no_rows(spark, tmp_path):
    (tmp_path / "c").mkdir()
    (tmp_path / "c" / "part-0").write_bytes(b"")
    assert read_corpus(spark, str(tmp_path / "c")).collect() == []


def test_dictionary_encode_keeps_every_document(spark, model):
    docs = spark.createDataFrame([(1, "ab ab"), (2, ""), (3, None), (4, EOT)], "doc_id long, text string")
    got = {r.doc_id: r.ids for r in E.dictionary_encode(docs, model).collect()}
    want = {r.doc_id: r.ids for r in E.encode(docs, model).collect()}
    assert got == want and got[2] == [] and got[3] is None and got[4] == [256]


@pytest.mark.parametrize("bad", [99_999, -1, 263])
def test_unknown_ids_raise(spark, model, bad):
    df = spark.createDataFrame([([97, bad, 98],)], "ids array<int>")
    with pytest.raises(Exception, match="outside the vocabulary"):
        df.select(E.decode_ids("ids", model)).collect()
    rows = E.ids_to_bytes(spark.createDataFrame([(97,), (bad,)], "token_id int"), model.vocab_df(spark)).collect()
    assert {r.token_id: r.token_hex for r in rows} == {97: "61", bad: None}


def test_bytes_to_ids_gives_one_row_a_key(spark, model):
    vocab = model.vocab_df(spark).unionByName(model.vocab_df(spark).withColumn("token_id", F.col("token_id") + 1000))
    rows = E.bytes_to_ids(spark.createDataFrame([("61",), ("6162",), ("FFFF",)], "token_hex string"), vocab).collect()
    assert {r.token_hex: r.token_id for r in rows} == {"61": 97, "6162": 258, "FFFF": None} and len(rows) == 3


def test_undisplay_of_an_unknown_character_is_null(spark):
    rows = spark.createDataFrame([("a b",), ("ab",), ("",)], "s string").select("s", byte_undisplay("s").alias("h")).collect()
    assert {r.s: r.h for r in rows} == {"a b": None, "ab": "6162", "": ""}


def test_bigrams_of_an_empty_text(spark):
    df = spark.createDataFrame([("",), ("one",), ("one two",), (None,)], "text string")
    assert [(r.context, r.token, r.n) for r in S.bigram_counts(df).collect()] == [("one", " two", 1)]


def test_specials_cost_linear_time(spark):
    def seconds(n):
        df = spark.createDataFrame([("word " + EOT + " word") * n for _ in range(1)], "string").toDF("text")
        df.select(F.size(pretoken_array("text", [EOT]))).collect()
        t = time.time()
        assert df.select(F.size(pretoken_array("text", [EOT]))).first()[0] == 4 * n - (n - 1)
        return time.time() - t
    assert seconds(8000) < 8 * max(seconds(2000), 0.25)


# --- per-word encoders against the plain rules ---------------------------------------------

def plain_rank(b, ranks):
    parts = [b[i:i + 1] for i in range(len(b))]
    while True:
        known = [ranks[p] for p in zip(parts, parts[1:]) if p in ranks]
        if not known:
            return parts
        left, right = next(p for p, r in ranks.items() if r == min(known))
        out = []
        for x in parts:
            if out and out[-1] == left and x == right and not isinstance(out[-1], bytearray):
                out[-1] = bytearray(left + right)  # a fresh symbol takes no part in this pass
            else:
                out.append(x)
        parts = [bytes(x) for x in out]


def plain_greedy(b, ids):
    if b in ids:
        return [b]
    parts, before = [b[i:i + 1] for i in range(len(b))], -1
    while len(parts) != before:
        before, out = len(parts), []
        for x in parts:
            out[-1:] = [out[-1] + x] if out and out[-1] + x in ids else [*out[-1:], x]
        parts = out
    return parts


def test_word_encoders_match_the_plain_rules(model):
    t = E.encoder_tables(model)
    r = random.Random(5)
    for _ in range(3000):
        w = bytes(r.choice(b" aabbbc") for _ in range(r.randrange(0, 14)))
        assert E.bpe_rank_word(w, t["ranks"], t["ids"]) == [t["ids"][x] for x in plain_rank(w, t["ranks"])], w
        assert E.bpe_greedy_word(w, t["ranks"], t["ids"]) == [t["ids"][x] for x in plain_greedy(w, t["ids"])], w
    assert len(E.bpe_rank_word(b"ab" * 100_000, t["ranks"], t["ids"])) == 50_000  # n log n


def test_nested_ids_flatten_to_the_flat_ones(spark, model):
    docs = spark.createDataFrame([(1, "ab abb" + EOT), (2, ""), (3, None)], "doc_id long, text string")
    nested = E.encode_words(docs, model)
    flat = {r.doc_id: r.ids for r in E.encode(docs, model).collect()}
    assert {r.doc_id: r.ids for r in nested.select("doc_id", E.flatten_tokens("word_ids").alias("ids")).collect()} == flat
    assert {r.doc_id: r.word_ids for r in nested.collect()}[1] == [[258], [259, 98], [256]]


# --- streams of shards -------------------------------------------------------------------------

@pytest.mark.parametrize("shards", [1, 3])
def test_offsets_and_random_windows_with_hashed_ids(spark, shards):
    r = random.Random(shards)
    rows = [(r.getrandbits(62), [r.randrange(1000) for _ in range(r.randrange(0, 90))]) for _ in range(700)]
    df = spark.createDataFrame(rows, "doc_id long, ids array<int>").withColumn("shard_id", F.pmod("doc_id", F.lit(shards)).cast("int"))
    got = B.stream_offsets(df.withColumn("n_tokens", F.size("ids").cast("long")), block_rows=64)
    stream = {s: [] for s in range(shards)}
    want = {}
    for d, ids in sorted(rows):
        want[d] = len(stream[d % shards])
        stream[d % shards] += ids
    assert {x.doc_id: x.offset for x in got.collect()} == want
    length = 17
    wins = B.random_windows(got, length, seed=3).collect()
    assert len(wins) == sum(len(v) // length for v in stream.values())
    for w in wins:
        s = stream[w.shard_id]
        assert w.input_ids == s[w.start:w.start + length] and w.target_ids == s[w.start + 1:w.start + length + 1]
    seq = B.sequential_windows(got, 50, overlap=7).collect()
    for w in seq:
        want_tokens = stream[w.shard_id][w.window_idx * 50:w.window_idx * 50 + 57]
        assert w.tokens == want_tokens + [0] * (57 - len(want_tokens)) and w.n_real == len(want_tokens)


def test_ranks_do_not_depend_on_the_buckets(spark):
    df = spark.range(3000).withColumn("part", F.lit(0))
    key = B.seeded_hash(F.lit(1), F.col("id"))
    a = {r.id: r.rn for r in B.rank_by_hash(df, key, ["id"], rows=100).collect()}
    b = {r.id: r.rn for r in B.rank_by_hash(df, key, ["id"]).collect()}
    assert a == b and sorted(a.values()) == list(range(3000))


def test_shard_subsets_are_distinct_and_uniform(spark):
    rows = B.sample_shards(spark.range(4000).select(F.col("id").alias("step")), 7, 3, seed=1).collect()
    by = {}
    for r in rows:
        by.setdefault(r.step, []).append((r.slot, r.shard_id))
    assert all(len({s for _, s in v}) == 3 and sorted(x for x, _ in v) == [0, 1, 2] for v in by.values())
    counts = {}
    for v in by.values():
        k = tuple(sorted(s for _, s in v))
        counts[k] = counts.get(k, 0) + 1
    assert len(counts) == 35 and max(counts.values()) < 2 * min(counts.values())  # all subsets, about equally


def test_preview_drops_later_rows_before_grouping(spark):
    df = spark.createDataFrame([(b, i, [b, i]) for b in range(2) for i in range(9)], "batch_id long, row_in_batch int, input_ids array<int>")
    got = {r.batch_id: r.preview_ids for r in B.preview_batch(df, 5).collect()}
    assert got == {b: [b, 0, b, 1, b] for b in range(2)}


# --- score tables ----------------------------------------------------------------------------------

def test_two_level_ranks_match_a_window(spark):
    r = random.Random(2)
    rows = [(c, "".join(r.choice("abé🙃") for _ in range(r.randrange(0, 5))), n) for c in "xy" for n in (1, 1, 1, 2, 5) for _ in range(60)]
    df = spark.createDataFrame(sorted({(c, t): n for c, t, n in rows}.items()), "k struct<context:string,token:string>, n long").select("k.*", "n")
    got = {(x.context, x.token): (x.rk, x.n_before) for x in S.rank_candidates(df).collect()}
    for c in "xy":
        before = 0
        for i, x in enumerate(sorted((x for x in df.collect() if x.context == c), key=lambda x: (-x.n, x.token.encode())), 1):
            assert got[c, x.token] == (i, before)
            before += x.n


@pytest.mark.parametrize("t", [1.0, 0.7])
def test_contexts_that_lie_in_several_blocks(spark, t):
    r = random.Random(5)
    rows = [(c, f"{c}{i}", r.choice([1, 1, 2, 9])) for c, size in (("a", 3), ("b", 70), ("c", 1), ("d", 40), ("e", 2)) for i in range(size)]
    df = spark.createDataFrame(rows, "context string, token string, n long")
    cut = S.in_blocks(df, 7).persist()
    assert {x.context for x in cut.where("shared").collect()} >= {"b", "d"} and cut.select("block").distinct().count() > 3
    assert {(x.context) for x in cut.groupBy("context").agg(F.countDistinct("block").alias("k")).where("k > 1").collect()} == \
        {x.context for x in cut.where("shared").collect()}
    plain = {(x.context, x.token): x for x in S.cumulative_mass(S.rank_candidates(S.candidate_probs(S.in_blocks(df, 1), t))).collect()}
    got = {(x.context, x.token): x for x in S.cumulative_mass(S.rank_candidates(S.candidate_probs(cut, t))).collect()}
    assert got.keys() == plain.keys() == {(c, x) for c, x, _ in rows}
    for c in "abcde":
        own = sorted((x for x in rows if x[0] == c), key=lambda x: (-x[2], x[1]))
        w = [x[2] ** (1 / t) for x in own]
        for i, x in enumerate(own):
            assert got[c, x[1]].rk == plain[c, x[1]].rk == i + 1 and got[c, x[1]].n_before == sum(y[2] for y in own[:i])
            assert got[c, x[1]].mass == pytest.approx(sum(w[:i + 1]) / sum(w)) == pytest.approx(plain[c, x[1]].mass)
    top = {(x.context, x.token, x.rk) for x in S.topk_candidates(S.candidate_probs(cut, t), 4).collect()}
    assert top == {(c, x.token, x.rk) for (c, _), x in got.items() if x.rk <= 4}
    cut.unpersist()


def test_bigrams_split_a_text_once(spark):
    plan = S.bigram_counts(spark.createDataFrame([("a b",)], "text string"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all") == 1


def test_long_form_temperature_matches_the_vector_form(spark):
    df = spark.createDataFrame([("x", t, n) for t, n in (("a", 1), ("b", 7), ("c", 30))], "context string, token string, n long")
    got = {r.token: r.p for r in S.candidate_probs(df, 0.7).collect()}
    vec = spark.range(1).select(S.softmax(S.temperature(F.array(*[F.log(F.lit(float(n))) for n in (1, 7, 30)]), 0.7)).alias("v")).first().v
    assert [got[t] for t in "abc"] == pytest.approx(vec)
    with pytest.raises(ValueError):
        S.candidate_probs(df, 0.0)


@pytest.mark.parametrize("t", [0.01, 0.3, 0.7, 1.0, 40.0])
def test_running_mass_follows_the_temperature(spark, t):
    r = random.Random(8)
    rows = [(c, f"{c}{i}", n) for c in "xy" for i, n in enumerate(r.choices([1, 1, 1, 2, 3, 900, 10 ** 12], k=50))] + [("z", "a", 9), ("z", "b", 3), ("z", "c", 1)]
    df = spark.createDataFrame(rows, "context string, token string, n long")
    got = {(x.context, x.token): x for x in S.cumulative_mass(S.rank_candidates(S.candidate_probs(df, t))).collect()}
    assert len(got) == len(rows)
    for c in "xyz":
        own = sorted((x for x in rows if x[0] == c), key=lambda x: (-x[2], x[1]))
        top = own[0][2]
        w = [(x[2] / top) ** (1 / t) for x in own]
        for i, x in enumerate(own):
            g = got[c, x[1]]
            assert (g.rk, g.p) == (i + 1, pytest.approx(w[i] / sum(w), rel=1e-9))
            assert g.mass == pytest.approx(sum(w[:i + 1]) / sum(w), rel=1e-9) and g.mass_before == pytest.approx(sum(w[:i]) / sum(w), rel=1e-9)
        assert got[c, own[-1][1]].mass == pytest.approx(1.0)
    if t == 0.7:
        assert [round(got["z", x].mass, 3) for x in "abc"] == [0.799, 0.965, 1.0]


# --- streaming counts --------------------------------------------------------------------------------

def test_running_counts_are_compacted(spark, tmp_path):
    src, out, ck = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ck")
    for i in range(5):
        spark.createDataFrame([(i, "a b " + "c" * i)], "doc_id long, text string").coalesce(1).write.mode("append").parquet(src)
    stream = stream_table(spark, src, "doc_id long, text string", max_files=1)
    run_to_end(count_words_stream(stream, out, checkpoint=ck, compact_every=2))
    got = {r.word: r.freq for r in running_counts(spark, out).collect()}
    assert got["a"] == 5 and got[" b"] == 5
    import os
    assert sorted(os.listdir(f"{out}/totals")) == ["epoch=3"] and sorted(os.listdir(f"{out}/changed")) == ["epoch=4"]


def test_a_cluster_needs_a_shared_folder(monkeypatch, spark):
    from types import SimpleNamespace

    from mergeloom import session
    fake = SimpleNamespace(sparkContext=SimpleNamespace(getCheckpointDir=lambda: None, master="yarn",
                                                        getConf=lambda: SimpleNamespace(get=lambda *a: None)),
                           conf=SimpleNamespace(get=lambda *a: None))
    monkeypatch.setattr(session, "ship_package", lambda s: None)
    with pytest.raises(RuntimeError):
        session.ensure_checkpoint_dir(fake)
