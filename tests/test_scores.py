import numpy as np
from pyspark.sql import functions as F

from mergeloom.operators.scores import (argmax_token, candidate_probs, cross_entropy, nucleus, rms_normalize, softmax,
                                        temperature, topk_candidates, topk_per_vector, weighted_sample)


def test_softmax_and_cross_entropy_match_numpy(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(6, 9)) * 10
    x[0] += 1000.0  # large inputs stay stable
    tgt = rng.integers(0, 9, size=6)
    df = spark.createDataFrame([(i, x[i].tolist(), int(tgt[i])) for i in range(6)], "i int, x array<double>, t int")
    got = np.array([r.p for r in df.orderBy("i").select(softmax(F.col("x")).alias("p")).collect()])
    e = np.exp(x - x.max(axis=1, keepdims=True))
    np.testing.assert_allclose(got, e / e.sum(axis=1, keepdims=True), rtol=1e-9)
    ce = cross_entropy(df, "x", "t").first()[0]
    logp = x - x.max(axis=1, keepdims=True) - np.log(e.sum(axis=1, keepdims=True))
    assert abs(ce - (-logp[np.arange(6), tgt].mean())) < 1e-8
    t = np.array([r.p for r in df.orderBy("i").select(temperature(F.col("x"), 0.5).alias("p")).collect()])
    np.testing.assert_allclose(t, x / 0.5 - (x / 0.5).max(axis=1, keepdims=True), atol=1e-9)


def test_rms_and_topk(spark):
    x = [3.0, -4.0, 1.0, 4.0]
    df = spark.createDataFrame([(x,)], "x array<double>")
    r = df.select(rms_normalize(F.col("x")).alias("n"), topk_per_vector(F.col("x"), 2).alias("k")).first()
    d = np.sqrt(np.mean(np.square(x))) + 1e-6
    np.testing.assert_allclose(r.n, np.array(x) / d)
    assert [(s.idx, s.value) for s in r.k] == [(3, 4.0), (0, 3.0)]


def test_candidates(spark):
    rows = [("a", "x", 5), ("a", "y", 3), ("a", "z", 2), ("b", "x", 1), ("b", "w", 1)]
    c = spark.createDataFrame(rows, "context string, token string, n long")
    p = candidate_probs(c)
    top = {(r.context, r.token): r.rk for r in topk_candidates(p, 2).collect()}
    assert top == {("a", "x"): 1, ("a", "y"): 2, ("b", "w"): 1, ("b", "x"): 2}
    nuc = {(r.context, r.token): r.p_norm for r in nucleus(topk_candidates(p, 3), 0.5).collect()}
    assert nuc == {("a", "x"): 1.0, ("b", "w"): 1.0}   # the crossing token is kept, never empty
    am = {r.context: r.token for r in argmax_token(c).collect()}
    assert am == {"a": "x", "b": "w"}
    s1 = {r.context: r.token for r in weighted_sample(c, 1).collect()}
    s2 = {r.context: r.token for r in weighted_sample(c, 1).collect()}
    assert s1 == s2 and set(s1) == {"a", "b"}


def test_weighted_sample_frequencies(spark):
    rows = [(f"c{i}", t, n) for i in range(3000) for t, n in (("x", 6), ("y", 3), ("z", 1))]
    c = spark.createDataFrame(rows, "context string, token string, n long")
    counts = {r.token: r["count"] for r in weighted_sample(c, 11).groupBy("token").count().collect()}
    for tok, share in (("x", 0.6), ("y", 0.3), ("z", 0.1)):
        assert abs(counts.get(tok, 0) / 3000 - share) < 0.04
