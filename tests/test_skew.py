"""A corpus where one word holds a third of all occurrences."""

import random

from mergeloom.operators.pretokenize import count_words
from mergeloom.plans.train import train_bpe

from .test_train import brute_force_bpe


def test_hot_word_counts_and_training(spark):
    rnd = random.Random(5)
    vocab = ["alpha", "beta", "gamma", "delta", "omega", "sigma", "kappa", "theta"]
    texts = []
    for i in range(300):
        words = []
        for _ in range(30):
            words.append("the" if rnd.random() < 1 / 3 else rnd.choice(vocab) + rnd.choice(["", "s", "ed"]))
        texts.append(" ".join(words))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(8)
    counts = {r.word: r.freq for r in count_words(df).collect()}
    assert sum(counts.values()) == 300 * 30
    hot = counts.get(" the", 0) + counts.get("the", 0)
    assert 0.28 < hot / (300 * 30) < 0.39
    m = train_bpe(df, 257 + 30)
    assert [(l, r) for l, r, _ in m.merges] == brute_force_bpe(texts, 30)


def test_hot_words_meet_their_dictionary_without_a_shuffle(spark):
    from mergeloom.operators.encode import dictionary_encode, encode
    rnd = random.Random(6)
    texts = [" ".join("the" if rnd.random() < 1 / 3 else f"w{rnd.randrange(4000)}" for _ in range(60)) for _ in range(200)] + ["", None]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    model = train_bpe(df, 257 + 20)
    got = dictionary_encode(df, model, hot_words=100)
    assert {r.doc_id: r.ids for r in got.collect()} == {r.doc_id: r.ids for r in encode(df, model).collect()}
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("strategy=broadcast") == 2 and "Generate explode(sequence" not in plan  # hot words only; no copies of the rest


def test_dictionary_meets_the_words_of_blocks_not_their_occurrences(spark):
    from mergeloom.operators.encode import dictionary_encode, encode

    from .test_batches import _shuffled
    rnd = random.Random(7)
    texts = [(i, " ".join(f"w{rnd.randrange(60)}" for _ in range(900))) for i in range(60)]
    model = train_bpe(spark.createDataFrame(texts, "doc_id long, text string"), 257 + 5)
    odd = [(3, texts[3][1]), (5, "again w1"), (5, None), (70, ""), (71, None), (71, None), (None, "w1 w2"), (None, None)]
    df = spark.createDataFrame(texts + odd, "doc_id long, text string").repartition(4)
    rows, size = _shuffled(spark, lambda: dictionary_encode(df, model))
    assert size < 3 * sum(len(t) for _, t in texts)  # a row of some 50 bytes for each of 54,000 words before
    once = {r.doc_id: r.word_ids for r in encode_words_of(spark, texts, model)}
    got = sorted((r.doc_id is None, r.doc_id or 0, r.ids is None, r.ids or []) for r in rows)
    flat = {k: [x for w in v for x in w] for k, v in once.items()}
    flat[3] = [x for w in once[3] for x in w + w]  # an id that comes twice: both rows get the words of both, by place
    again = [[*w] for w in next(r.word_ids for r in encode_words_of(spark, [(5, "again w1")], model))]
    flat[5] = [x for _, w in sorted((at, w) for v in (once[5], again) for at, w in enumerate(v)) for x in w]
    want = [(False, k, False, v) for k, v in flat.items()] + [(False, 3, False, flat[3])] + 2 * [(False, 5, False, flat[5])]
    want += [(False, 70, False, []), (False, 71, True, []), (False, 71, True, []), (True, 0, False, []), (True, 0, True, [])]
    assert got == sorted(want)


def encode_words_of(spark, texts, model):
    from mergeloom.operators.encode import encode_words
    return encode_words(spark.createDataFrame(texts, "doc_id long, text string"), model).select("doc_id", "word_ids").collect()
