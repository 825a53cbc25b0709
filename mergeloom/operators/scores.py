"""Score tables: softmax, losses, candidate ranking and sampling (M1-M3, M6, A9, A10,
W7, W8, T1-T3, T6, U5, J8).

Wide form: a row holds a score vector (``ARRAY<DOUBLE>``) and array
higher-order functions do the maths in place (no shuffle).  Long form
``(context, token, n)``: rows are cut into ranges of their rank order, so windows see
the part of a context that lies in one range; the few contexts that lie in several get
what the ranges before hold from a broadcast table, and no task holds a whole large
context.  Top-k filters become a group limit in Catalyst.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .batches import seeded_hash
from .pretokenize import pretoken_array

ROUND = 9


def as_double_array(c: Column | str) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.transform(col, lambda x: x.cast("double"))


# A row scalar (max, sum) is never written inside a lambda: Spark would
# re-evaluate it for every element (quadratic per row, worse when nested, and
# the optimizer inlines staged columns back).  It is handed to the lambda as a
# second array, ``array_repeat(scalar, size)``, through ``zip_with``, so it is
# computed once per row.

def _with_scalar(vec: Column, scalar: Column, f) -> Column:
    return F.zip_with(vec, F.array_repeat(scalar, F.size(vec)), f)


def softmax(vec: Column) -> Column:
    """M1: max-shifted softmax of a score vector."""
    e = _with_scalar(vec, F.array_max(vec), lambda x, m: F.exp(x - m))
    s = F.aggregate(e, F.lit(0.0), lambda acc, x: acc + x)
    return _with_scalar(e, s, lambda x, t: x / t)


def temperature(vec: Column, t: float) -> Column:
    """M2: divide by the temperature and shift by the max."""
    scaled = F.transform(vec, lambda x: x / F.lit(float(t)))
    return _with_scalar(scaled, F.array_max(scaled), lambda x, m: x - m)


def logsumexp(vec: Column) -> Column:
    m = F.array_max(vec)
    shifted = _with_scalar(vec, m, lambda x, mm: F.exp(x - mm))
    return m + F.log(F.aggregate(shifted, F.lit(0.0), lambda acc, x: acc + x))


def target_log_prob(vec: Column, target: Column) -> Column:
    """M3: log-probability of the 0-based ``target`` index."""
    return F.element_at(vec, target + 1) - logsumexp(vec)


def cross_entropy(df: DataFrame, logits: str, target: str) -> DataFrame:
    """Mean token cross-entropy (stable log-sum-exp)."""
    return df.agg(F.round(F.avg(-target_log_prob(F.col(logits), F.col(target))), ROUND).alias("mean_loss"))


def rms_normalize(vec: Column, eps: float = 1e-6, gain: float = 1.0) -> Column:
    """M6: vector ÷ (root mean square + ε) × gain (ε outside the root)."""
    d = F.sqrt(F.aggregate(vec, F.lit(0.0), lambda acc, x: acc + x * x) / F.size(vec)) + F.lit(eps)
    return _with_scalar(vec, d, lambda x, dd: x / dd * F.lit(gain))


def topk_per_vector(vec: Column, k: int) -> Column:
    """``ARRAY<STRUCT<idx, value>>`` of the k largest entries (ties: lower index)."""
    tagged = F.transform(vec, lambda x, i: F.struct((-x).alias("neg"), i.alias("idx"), x.alias("value")))
    return F.transform(F.slice(F.array_sort(tagged), 1, k), lambda s: F.struct(s["idx"].alias("idx"), s["value"].alias("value")))


def mean_val_loss(losses: DataFrame, steps: DataFrame, by: str = "step") -> DataFrame:
    """A10: average loss of each step's validation batches; 0.0 for a step with none."""
    avg = losses.groupBy(by).agg(F.avg("loss").alias("_a"))
    return steps.join(avg, by, "left").select(by, F.round(F.coalesce("_a", F.lit(0.0)), ROUND).alias("val_loss"))


# --- long form: next-token candidates ----------------------------------------------

def bigram_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Next-pre-token candidates ``(context, token, n)`` from adjacent pre-tokens.

    Pairs are made inside each text's array (no window over a document) and
    counted with a partial + final aggregate.
    """
    held = docs.select(pretoken_array(text_col).alias("a"))  # a column, so that the text is split once
    n = F.greatest(F.size("a") - 1, F.lit(0))  # an empty text has no pair
    return (held.select(F.explode(F.arrays_zip(F.slice("a", 1, n).alias("context"), F.slice("a", 2, n).alias("token"))).alias("p"))
            .groupBy(F.col("p.context").alias("context"), F.col("p.token").alias("token"))
            .agg(F.count(F.lit(1)).alias("n")))


def in_blocks(cands: DataFrame, n_blocks: int | None = None) -> DataFrame:
    """Candidates cut into ranges of (context, count desc, token): adds ``block`` and ``shared``.

    A context lies in one block or in consecutive ones; ``shared`` marks the latter, of which
    there are fewer than blocks.  The rows are written once, so their numbers hold for every
    reader.  Rows that carry a ``block`` are left as they are.
    """
    if "block" in cands.columns:
        return cands
    spark, path = cands.sparkSession, scratch_path(cands.sparkSession, "candidates")
    order = [F.col("context"), F.col("n").desc(), F.col("token")]
    ranged = cands.repartitionByRange(n_blocks, *order) if n_blocks else cands.repartitionByRange(*order)
    cut = ranged.withColumn("block", F.spark_partition_id())
    cut.write.parquet(path)
    rows = spark.read.schema(cut.schema).parquet(path)
    ends = rows.groupBy("block").agg(F.min("context").alias("first"), F.max("context").alias("last")).collect()  # one row a block
    met: set[str] = set()
    shared: set[str] = set()
    for r in ends:
        own = {r["first"], r["last"]} - {None}
        shared |= own & met
        met |= own
    return rows.withColumn("shared", F.coalesce(F.col("context").isin(sorted(shared)), F.lit(False)))


def block_window() -> Window:
    return Window.partitionBy("block", "context").orderBy(F.col("n").desc(), F.col("token").asc())


def candidate_probs(cands: DataFrame, t: float = 1.0) -> DataFrame:
    """Softmax of ``ln(n) / t`` per context (M1/M2 in long form): adds ``w``, ``w_total`` and ``p = w / w_total``.

    The weight is the count itself at ``t = 1``, else ``(n / n_max)^(1/t)`` with the
    context's largest count, so no positive temperature overflows; weights that are
    nothing beside the largest become 0.  Sums run over the rows of a context in its block
    (``in_blocks``); contexts in several blocks have theirs from a broadcast row each.
    """
    if not t > 0:
        raise ValueError("a temperature is positive")
    rows = in_blocks(cands).where(F.col("context").isNotNull())
    whole = block_window().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    if t == 1.0:
        def weighted(part: DataFrame, windowed: bool) -> DataFrame:
            return part.withColumn("w", F.col("n"))
    else:
        peaks = F.broadcast(rows.where("shared").groupBy("context").agg(F.max("n").alias("_peak")))

        def weighted(part: DataFrame, windowed: bool) -> DataFrame:
            top = F.coalesce("_peak", F.max("n").over(whole)) if windowed else F.col("_peak")
            held = part.join(peaks, "context", "left").withColumn("_top", top)
            return held.withColumn("w", F.pow(F.col("n") / F.col("_top"), F.lit(1.0 / t))).drop("_peak", "_top")

    totals = F.broadcast(weighted(rows.where("shared"), False).groupBy("context").agg(F.sum("w").alias("_all")))
    own = weighted(rows, True).withColumn("_own", F.sum("w").over(whole)).join(totals, "context", "left")
    return (own.withColumn("w_total", F.coalesce("_all", "_own"))
            .select(*cands.columns, "w", "w_total", (F.col("w") / F.col("w_total")).alias("p")))


def rank_window() -> Window:
    return Window.partitionBy("context").orderBy(F.col("n").desc(), F.col("token").asc())


def rank_candidates(cands: DataFrame) -> DataFrame:
    """Rank of each candidate in its context (count desc, then token), as ``rk``.

    Two levels, so that no task holds a large context: rows are numbered inside their block
    (``in_blocks``); where a context goes on from a block before, what lies there is added.
    ``n_before`` is the sum of the counts ranked before; where weights ``w`` come along,
    which depend on the context and the count alone, ``w_before`` is theirs.
    """
    sums = [x for x in ("n", "w") if x in cands.columns]
    rows = in_blocks(cands).where("context is not null and token is not null and n is not null")
    parts = rows.where("shared").groupBy("context", "block").agg(F.count(F.lit(1)).alias("_c"), *[F.sum(x).alias(f"_{x}") for x in sums])
    before = Window.partitionBy("context").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select("context", "block", F.sum("_c").over(before).alias("_first"), *[F.sum(f"_{x}").over(before).alias(f"_{x}s") for x in sums])
    prior = block_window().rowsBetween(Window.unboundedPreceding, -1)
    inside = rows.withColumn("_in", F.row_number().over(block_window())).withColumns({f"_{x}in": F.sum(x).over(prior) for x in sums})
    none = F.lit(0)
    return (inside.join(F.broadcast(starts), ["context", "block"], "left")
            .withColumn("rk", (F.coalesce("_first", none) + F.col("_in")).cast("int"))
            .withColumns({f"{x}_before": F.coalesce(f"_{x}s", none) + F.coalesce(f"_{x}in", none) for x in sums})
            .select(*cands.columns, "rk", *[f"{x}_before" for x in sums]))


def cumulative_mass(ranked: DataFrame) -> DataFrame:
    """Running probability mass in rank order (``mass``) and before the row (``mass_before``).

    ``ranked`` are ranked candidates with their weights (``candidate_probs``, then W7): the
    masses follow the temperature of the weights; at ``t = 1`` they come from exact counts.
    """
    return (ranked.withColumn("mass", (F.col("w_before") + F.col("w")) / F.col("w_total"))
            .withColumn("mass_before", F.col("w_before") / F.col("w_total")))


def topk_candidates(probs: DataFrame, k: int) -> DataFrame:
    """The k best candidates of each context (group limit runs before the shuffle).

    Rows that carry a ``block`` are cut to the k best of their context in it first.
    """
    if "block" in probs.columns:
        probs = probs.withColumn("_in", F.row_number().over(block_window())).filter(F.col("_in") <= k).drop("_in")
    return probs.withColumn("rk", F.row_number().over(rank_window())).filter(F.col("rk") <= k)


def nucleus(topk: DataFrame, top_p: float) -> DataFrame:
    """T2 (D8): keep candidates whose mass before them is < p; renormalise (never empty).

    Masses are sums of weights over the context's total; at ``t = 1`` weights are exact
    counts, so the cut does not depend on the order of summation.  The rows of a context
    are at most ``k`` and clustered by the ranking already.
    """
    before = rank_window().rowsBetween(Window.unboundedPreceding, -1)
    kept = (topk.withColumn("w_before", F.coalesce(F.sum("w").over(before), F.lit(0)))
            .filter(F.col("w_before") / F.col("w_total") < F.lit(float(top_p))))
    return kept.withColumn("p_norm", F.col("w") / F.sum("w").over(Window.partitionBy("context"))).drop("w_before")


def sample_next(cands: DataFrame, seed: int, t: float = 1.0, k: int = 50, top_p: float = 1.0) -> DataFrame:
    """The sampling chain: temperature, then the ``k`` best, then the nucleus, then one draw of the rest per context."""
    kept = nucleus(topk_candidates(candidate_probs(in_blocks(cands), t), k), top_p)
    return weighted_sample(kept.select("context", "token", "w"), seed, weight="w")


def argmax_token(cands: DataFrame) -> DataFrame:
    """Greedy choice per context (highest count, then smallest token); partial aggregate."""
    return cands.groupBy("context").agg(
        F.min_by("token", F.struct((-F.col("n")).alias("a"), F.col("token").alias("b"))).alias("token"),
        F.max("n").alias("n"))


def gumbel_key(n: Column, u: Column, t: float = 1.0) -> Column:
    return F.log(n) / F.lit(float(t)) - F.log(-F.log(u))


def uniform_from_hash(*parts: Column) -> Column:
    """Seeded U(0,1) from md5 (60 bits), identical in DuckDB."""
    return (seeded_hash(*parts).cast("double") + F.lit(0.5)) / F.lit(float(1 << 60))


def weighted_sample(cands: DataFrame, seed: int, t: float = 1.0, weight: str = "n") -> DataFrame:
    """One draw per context ∝ ``weight^(1/t)`` by the Gumbel-max trick (a max_by aggregate)."""
    u = uniform_from_hash(F.lit(seed), F.col("context"), F.col("token"))
    key = F.round(gumbel_key(F.col(weight).cast("double"), u, t), ROUND)
    return cands.groupBy("context").agg(F.max_by("token", F.struct(key.alias("k"), F.col("token").alias("tk"))).alias("token"))


def embedding_lookup(token_counts: DataFrame, emb: DataFrame) -> DataFrame:
    """Equi-join token ids to their vectors (inner: ids without a vector have no row)."""
    return token_counts.join(emb.withColumnRenamed("vec_id", "token_id"), "token_id")
