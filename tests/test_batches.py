import math
from collections import Counter

from pyspark.sql import functions as F

from mergeloom.operators.batches import (assign_device, build_batches, permuted, permuted_batches, preview_batch, random_windows, rank_by_hash,
                                         sample_shards, seeded_hash, sequential_windows, stream_offsets, training_pairs, window_counts)


def _docs(spark, lists, shard=0):
    rows = [(i, shard, ids) for i, ids in enumerate(lists)]
    df = spark.createDataFrame(rows, "doc_id long, shard_id int, ids array<int>")
    return stream_offsets(df.withColumn("n_tokens", F.size("ids").cast("long")))


def test_offsets_and_sequential_windows(spark):
    lists = [list(range(100 * i, 100 * i + n)) for i, n in enumerate([5, 0, 13, 7, 30])]
    docs = _docs(spark, lists)
    stream = [x for ids in lists for x in ids]
    offs = {r.doc_id: r.offset for r in docs.collect()}
    assert offs == {0: 0, 1: 5, 2: 5, 3: 18, 4: 25}
    w = 8
    wins = training_pairs(sequential_windows(docs, w), w).orderBy("window_idx").collect()
    expect = [stream[i:i + w] for i in range(0, len(stream), w)]
    expect = [e + [0] * (w - len(e)) for e in expect]
    assert [r.tokens for r in wins] == expect
    for r in wins:
        assert len(r.input_ids) == w - 1 and r.input_ids[1:] == r.target_ids[:-1]


def test_exact_multiple_has_no_all_pad_window(spark):
    docs = _docs(spark, [list(range(16))])
    assert sequential_windows(docs, 8).count() == 2


def test_random_windows_uniform_and_shifted(spark):
    """Same statistical test as the reference's batch sampler: 1D arange(100), L=7."""
    docs = _docs(spark, [list(range(100))])
    n_samples = 32 * 1000
    r = random_windows(docs, 7, n_samples=F.lit(n_samples), seed=1).collect()
    starts = Counter(x.input_ids[0] for x in r)
    for x in r:
        assert len(x.input_ids) == 7 and [v + 1 for v in x.input_ids] == x.target_ids
    possible = 100 - 7
    assert min(starts) == 0 and max(starts) == possible - 1
    mu = n_samples / possible
    sd = math.sqrt(n_samples * (1 / possible) * (1 - 1 / possible))
    assert all(mu - 5 * sd <= c <= mu + 5 * sd for c in starts.values())


def test_batches_are_a_permutation(spark):
    docs = _docs(spark, [list(range(i * 50, i * 50 + 37)) for i in range(6)])
    wins = sequential_windows(docs, 8)
    b = assign_device(build_batches(wins, 4, seed=3), 4, 2).collect()
    assert sorted((r.batch_id * 4 + r.row_in_batch) for r in b) == list(range(len(b)))
    assert {r.device_id for r in b} == {0, 1}
    assert len({(r.shard_id, r.window_idx) for r in b}) == len(b)


def test_sample_shards(spark):
    steps = spark.range(200).withColumnRenamed("id", "step")
    no_rep = sample_shards(steps, 10, 4, seed=7).collect()
    by_step = Counter()
    for r in no_rep:
        by_step[(r.step, r.shard_id)] += 1
    assert max(by_step.values()) == 1
    rep = sample_shards(steps, 3, 8, seed=7).collect()
    assert len(rep) == 1600 and {r.shard_id for r in rep} == {0, 1, 2}


def test_permuted_numbers_are_a_permutation(spark):
    for n in (1, 2, 3, 5, 16, 17, 1000):
        got = [r.p for r in spark.range(n).select(permuted(F.col("id"), n, 7).alias("p")).collect()]
        assert sorted(got) == list(range(n))
    a, b = ([r.p for r in spark.range(500).select(permuted(F.col("id"), 500, s).alias("p")).collect()] for s in (1, 2))
    assert a != b and sum(x == i for i, x in enumerate(a)) < 12  # seeded, and few numbers stay in place


def test_permuted_batches_need_neither_ranks_nor_shuffles_of_windows(spark, capsys):
    docs = _docs(spark, [list(range(i * 50, i * 50 + 37)) for i in range(6)] + [[]]).withColumn("n_tokens", F.size("ids").cast("long"))
    wins = sequential_windows(docs, 8)
    plain = permuted_batches(wins, window_counts(docs, 8), 4, seed=3)
    rows = plain.collect()
    assert sorted(r.batch_id * 4 + r.row_in_batch for r in rows) == list(range(wins.count()))
    assert {tuple(r.tokens) for r in rows} == {tuple(r.tokens) for r in wins.collect()}
    held = spark.createDataFrame([(0, i, [i]) for i in range(20)], "shard_id int, window_idx long, tokens array<int>")
    permuted_batches(held, held.groupBy("shard_id").agg(F.count("*").alias("n")), 4).explain()
    plan = capsys.readouterr().out
    assert "Window" not in plan and "hashpartitioning" not in plan and "rangepartitioning" not in plan


def test_few_of_a_million_shards(spark):
    rows = sample_shards(spark.range(300).withColumnRenamed("id", "step"), 10 ** 6, 8, seed=1).collect()
    by = {}
    for r in rows:
        by.setdefault(r.step, set()).add(r.shard_id)
    assert len(by) == 300 and all(len(v) == 8 for v in by.values())
    mean = sum(r.shard_id for r in rows) / len(rows)
    assert 0 <= min(r.shard_id for r in rows) and max(r.shard_id for r in rows) < 10 ** 6 and abs(mean - 5e5) < 3e4


def test_floyd_draws_whole_sets_in_uniform_order(spark):
    rows = sample_shards(spark.range(3000).withColumnRenamed("id", "step"), 4, 4, seed=2).collect()
    first = Counter(r.shard_id for r in rows if r.slot == 0)
    by = Counter((r.step, r.shard_id) for r in rows)
    assert max(by.values()) == 1 and len(by) == 12000 and all(650 < first[s] < 850 for s in range(4))


def test_samples_are_made_by_many_tasks_and_not_broadcast(spark):
    docs = spark.createDataFrame([(0, 0, list(range(500)))], "shard_id int, offset long, ids array<int>")
    plan = random_windows(docs, 7, seed=1)._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan and "REPARTITION_BY_COL" not in plan and "BroadcastHashJoin" not in plan


def test_rows_to_rank_are_made_once(spark):
    made = spark.sparkContext.accumulator(0)

    def note(x):
        made.add(1)
        return (x,)

    df = spark.createDataFrame(spark.sparkContext.parallelize(range(700), 3).map(note), "x long")
    got = rank_by_hash(df, seeded_hash("x"), ["x"], rows=100).collect()
    assert sorted(r.rn for r in got) == list(range(700)) and made.value == 700


def test_rows_of_raw_shards_are_made_once(spark, tmp_path):
    from mergeloom.sources.shards import read_raw_shards, write_raw_shards
    made = spark.sparkContext.accumulator(0)

    def note(x):
        made.add(1)
        return (x, x % 2, [x])

    df = spark.createDataFrame(spark.sparkContext.parallelize(range(700), 3).map(note), "doc_id long, shard_id int, ids array<int>")
    write_raw_shards(df, str(tmp_path / "raw"))
    rows = sorted(read_raw_shards(spark, str(tmp_path / "raw")).collect(), key=lambda r: (r.path, r.offset))
    assert [t for r in rows for t in r.tokens] == [*range(0, 700, 2), *range(1, 700, 2)] and made.value == 700


# --- what is shuffled ------------------------------------------------------------------------------

def _shuffled(spark, make):
    """Rows of ``make()`` and the bytes, before they are compressed, that its exchanges wrote."""
    def exchanges(node):
        below = [x for i in range(node.children().size()) for x in exchanges(node.children().apply(i))]
        return ([node.metrics().apply("dataSize").value()] if node.nodeName() == "Exchange" else []) + below

    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = make()
        rows = df.collect()
        return rows, sum(exchanges(df._jdf.queryExecution().executedPlan()))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_random_windows_shuffle_packed_ids(spark):
    docs = spark.createDataFrame([(0, 3000 * i, [(i + j) % 300 for j in range(3000)]) for i in range(40)], "shard_id int, offset long, ids array<int>")
    stream = [x for i in range(40) for x in ((i + j) % 300 for j in range(3000))]
    rows, size = _shuffled(spark, lambda: random_windows(docs, 600, seed=1))
    assert len(rows) == 200 and all(r.input_ids == stream[r.start:r.start + 600] and r.target_ids == stream[r.start + 1:r.start + 601] for r in rows)
    assert size < 3 * len(stream)  # four bytes an id before


def test_previews_shuffle_packed_ids(spark):
    docs = spark.createDataFrame([(0, 3000 * i, [(i + j) % 120 for j in range(3000)]) for i in range(40)], "shard_id int, offset long, ids array<int>")
    rows, size = _shuffled(spark, lambda: preview_batch(build_batches(training_pairs(sequential_windows(docs, 600), 600), 4), 2000))
    assert len(rows) == 50 and all(len(r.preview_ids) == 2000 for r in rows)
    assert size < 4 * 120_000  # twice four bytes an id before


def test_stored_shards_get_offsets_without_a_shuffle_of_ids(spark, tmp_path):
    from mergeloom.plans.prepare import prepare_dataset
    from mergeloom.plans.train import BPEModel
    texts = [(i % 50, "a" * (i + 1) * 20) for i in range(60)] + [(7, None), (None, "x")]  # ids come twice, with other texts
    corpus = spark.createDataFrame(texts, "doc_id long, text string")
    rows, size = _shuffled(spark, lambda: prepare_dataset(corpus, BPEModel(["<|endoftext|>"]), str(tmp_path / "s"), 3).select("doc_id", "shard_id", "n_tokens", "offset", "ids"))
    assert size < sum(len(t or "") for _, t in texts)
    assert len(rows) == 61  # the row without an id belongs to no shard
    want = stream_offsets(spark.createDataFrame([(r.doc_id, r.shard_id, r.ids, r.n_tokens) for r in rows if r.ids is not None], "doc_id long, shard_id int, ids array<int>, n_tokens long"))
    assert sorted((r.doc_id, r.offset, len(r.ids)) for r in rows if r.ids is not None) == sorted((r.doc_id, r.offset, len(r.ids)) for r in want.collect())


def test_ids_without_a_packed_form_stay_as_they_are(spark):
    lists = [[1, -1, 2**31 - 1], [None, 5, 0xD7FF], list(range(50)), [0xD800, 3], [0x7F, 0x80, 0x7FF, 0x800]]
    stream, at, rows = [], 0, []
    for ids in lists:
        rows.append((0, at, ids))
        stream, at = stream + ids, at + len(ids)
    docs = spark.createDataFrame(rows, "shard_id int, offset long, ids array<int>")
    for overlap in (0, 3):
        got = sequential_windows(docs, 4, overlap=overlap).collect()
        assert len(got) == -(-len(stream) // 4) and all(r.tokens[:r.n_real] == stream[4 * r.window_idx:4 * r.window_idx + 4 + overlap] for r in got)
    batches = spark.createDataFrame([(i, 0, ids) for i, ids in enumerate(lists + [[], None])], "batch_id long, row_in_batch int, input_ids array<int>")
    assert {r.batch_id: r.preview_ids for r in preview_batch(batches, 100).collect()} == dict(enumerate(lists + [[], None]))
