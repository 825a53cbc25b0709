"""Plan-shape checks for the properties that matter at scale."""

from mergeloom.operators.pairs import pair_counts
from mergeloom.operators.pretokenize import count_words
from mergeloom.plans.foresight import counts_with, first_met, holds_any, replayed, words_with
from mergeloom.plans.train import counts_after, rewritten, word_table
from mergeloom.sources.corpus import table

from .conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_word_count_prunes_columns_and_pre_aggregates(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    plan = _plan(count_words(docs))
    assert "ReadSchema: struct<text:string>" in plan  # only the text column is read
    assert plan.count("partial_count") == 1  # map-side combine before the word shuffle


def test_round_update_shuffles_only_the_delta(spark):
    loop = spark.newSession()
    loop.conf.set("spark.sql.adaptive.enabled", "false")
    docs = table(loop, SF_SMALL, "documents")
    work = word_table(docs, ["<|endoftext|>"]).select("syms", "freq").persist()
    pairs = pair_counts(work).persist()
    pairs.count()
    plan = _plan(counts_after(pairs, rewritten(work, [("20", "74"), ("68", "65")])))
    top = plan.partition("InMemoryTableScan")[0] + plan.rpartition("InMemoryRelation")[0].rpartition("Union")[2]
    assert "Join" not in plan
    # outside the two kept tables there is one exchange: the sums of the changed words' pairs
    alive = [line for line in plan.splitlines() if "Exchange hashpartitioning(l" in line]
    assert len(alive) == 2 and top  # one of them made the kept counts


def test_spread_only_single_split_inputs(spark):
    from mergeloom.session import spread
    big = spark.range(0, 1000, 1, 2)
    assert spread(big, 8) is big
    small = spark.range(0, 10, 1, 1)
    assert spread(small, 8).rdd.getNumPartitions() == 8


def test_shards_are_encoded_once(spark, small_docs, tmp_path, monkeypatch):
    from mergeloom.plans import prepare
    from mergeloom.plans.train import BPEModel
    plans = []
    write = prepare.write_token_shards
    monkeypatch.setattr(prepare, "write_token_shards", lambda df, *a, **k: (plans.append(_plan(df)), write(df, *a, **k))[1])
    out = prepare.prepare_dataset(small_docs, BPEModel(["<|endoftext|>"]), str(tmp_path / "s"), 2)
    assert plans[0].count("ArrowEvalPython") == 1
    assert plans[0].index("ArrowEvalPython") < plans[0].index("Exchange")  # ranges are cut before the encoder
    assert out.count() == small_docs.count()


def test_broadcasts_are_checked(spark):
    from mergeloom.session import small
    df = spark.range(100)
    assert "ResolvedHint" in small(df)._jdf.queryExecution().analyzed().toString()
    assert small(df, 99) is df


def test_checkpoint_dir_is_read_from_session(spark):
    from mergeloom.session import ensure_checkpoint_dir, scratch_path
    d = ensure_checkpoint_dir(spark)
    assert d and scratch_path(spark, "x").startswith(d)


def test_only_touched_words_are_replayed_and_rewritten(spark):
    work = spark.createDataFrame([("<61><62><63>", 3), ("<64><65><66>", 5), ("<66><61><62>", 2)], "syms string, freq long").persist()
    merges = [("61", "62"), ("6162", "63"), ("67", "68")]
    known = {"61", "62", "63", "64", "65", "66", "67", "68"}
    assert first_met(merges, known) == [("61", "62"), ("67", "68")]
    assert {r.syms for r in work.where(holds_any(merges, known)).collect()} == {"<61><62><63>", "<66><61><62>"}
    plan = _plan(replayed(work, merges, known))
    assert plan.index("MapInArrow") < plan.index("Filter exists") and plan.count("Exchange") == 1  # the filter lies below
    assert "CASE WHEN exists" in _plan(words_with(work, merges, known))  # others keep their symbols as they are
    changes = {(r.step, r.l, r.r): r.n for r in replayed(work, merges, known).collect()}
    assert changes == {(0, "61", "62"): -5, (0, "62", "63"): -3, (0, "6162", "63"): 3, (0, "66", "61"): -2, (0, "66", "6162"): 2,
                       (1, "6162", "63"): -3}
    assert {r.syms for r in words_with(work, merges, known).collect()} == {"<64><65><66>", "<66><6162>"}


def test_foreseen_counts_stay_clustered(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        work = spark.createDataFrame([("<61><62><63>", 3)], "syms string, freq long")
        pairs = spark.createDataFrame([("61", "62", 3), ("62", "63", 3)], "l string, r string, n long").repartition("l", "r").persist()
        pairs.count()
        changes = replayed(work, [("61", "62")], {"61", "62", "63"}).persist()
        changes.count()
        assert "Exchange" not in _plan(counts_with(pairs, changes, 1)).split("InMemoryTableScan")[0]
        assert {(r.l, r.r, r.n) for r in counts_with(pairs, changes, 1).collect()} == {("6162", "63", 3)}
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_blocks_change_as_words_one_a_row_do(spark):
    """Overlapping runs, words that end as one symbol, a merge that spells a known symbol, several blocks."""
    import random

    from mergeloom.plans.blocks import Symbols, block_changes, block_pair_counts, blocks_with, packed, unpacked
    rnd = random.Random(5)
    words = ["<" + "><".join(rnd.choice(("61", "61", "62", "63", "6162")) for _ in range(rnd.randrange(1, 9))) + ">" for _ in range(300)]
    work = spark.createDataFrame([(w, rnd.randrange(1, 1 << 40)) for w in words], "syms string, freq long").repartition(3).persist()
    merges, known = [("61", "61"), ("61", "62"), ("6161", "61"), ("6162", "63"), ("62", "63"), ("64", "61")], {"61", "62", "63", "64", "6162"}
    symbols = Symbols(known)
    more = symbols.with_merges(merges)
    blocks = packed(work, symbols).persist()
    assert blocks.count() < 4
    rows = lambda df: sorted(map(tuple, df.collect()))
    assert rows(unpacked(blocks, symbols)) == rows(work)
    assert rows(block_pair_counts(blocks, symbols)) == rows(pair_counts(work))
    assert rows(block_changes(blocks, merges, more, known)) == rows(replayed(work, merges, known).where("n <> 0"))
    after = blocks_with(blocks, merges, more, known)
    assert rows(unpacked(after, more).where("instr(syms, '><') > 0")) == rows(words_with(work, merges, known))
    plan = _plan(block_changes(after, merges, more, known))
    assert plan.split("InMemoryTableScan")[0].count("Exchange hashpartitioning(l") == 1 and "exists" not in plan  # only sums are shuffled


def test_merges_that_touch_most_words_come_in_long_batches(spark):
    """A few thousand words of few letters: ten merges take two or three rounds, not one each."""
    import random

    from mergeloom.plans.train import TrainOptions, train_bpe
    rnd = random.Random(8)
    texts = [" ".join("".join(rnd.choice(("th", "e", "an", "in", "o", "er", "s")) for _ in range(rnd.randrange(2, 9))) for _ in range(80)) for _ in range(60)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    some = train_bpe(df, 257 + 10, options=TrainOptions(foresight_words=1500))
    assert some.merges == train_bpe(df, 257 + 10, options=TrainOptions(foresight_words=0)).merges
    assert some.rounds <= 5
