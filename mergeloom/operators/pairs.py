"""Adjacent symbol pairs over the distinct-word table.

Input is always the distinct-word table ``(syms, freq[, word])``: pairs are
counted once per distinct word and weighted by its frequency, so a hot word
costs one row however often it occurs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.symbols import apply_merges, merge_pattern, pair_structs, syms_array

def pair_order() -> list:
    """Merge order: count desc, then the greatest byte pair (hex order = byte order)."""
    return [F.col("n").desc(), F.col("l").desc(), F.col("r").desc()]


def pair_rows(words: DataFrame, weight: str = "freq", sign: int = 1) -> DataFrame:
    """One row per adjacent pair occurrence inside each distinct word: ``(l, r, w)``."""
    w = F.col(weight) if sign == 1 else -F.col(weight)
    return (words.select(F.explode(pair_structs(syms_array("syms"))).alias("p"), w.alias("w"))
            .select(F.col("p.l").alias("l"), F.col("p.r").alias("r"), "w"))


def pair_counts(words: DataFrame) -> DataFrame:
    """A4: weighted count ``n`` of each adjacent pair ``(l, r)`` (hex symbols)."""
    return pair_rows(words).groupBy("l", "r").agg(F.sum("w").alias("n"))


def pair_postings(words: DataFrame) -> DataFrame:
    """A5: the posting relation pair → word, one row per (pair, word) with its weight.

    Kept as rows rather than ``collect_set`` so a pair present in a third of all
    words never builds one giant array in one task.
    """
    return (words.select("word", "freq", F.explode(F.array_distinct(pair_structs(syms_array("syms")))).alias("p"))
            .select(F.col("p.l").alias("l"), F.col("p.r").alias("r"), "word", "freq"))


def best_pair(pairs: DataFrame) -> DataFrame:
    """The arg-max pair; ties go to the greatest ``(l, r)`` byte pair."""
    return pairs.agg(F.max(F.struct("n", "l", "r")).alias("b")).select("b.l", "b.r", "b.n").filter(F.col("n").isNotNull())


def top_pairs(pairs: DataFrame, n: int) -> DataFrame:
    """T4: the first ``n`` pairs in merge order (distributed top-n, no full sort)."""
    return pairs.orderBy(*pair_order()).limit(n)


def words_with_pair(words: DataFrame, l_hex: str, r_hex: str) -> DataFrame:
    """Words whose current symbols hold the pair (the posting list of one pair)."""
    needle, _ = merge_pattern(l_hex, r_hex)
    return words.filter(F.contains(F.col("syms"), F.lit(needle)))


def merge_words(words: DataFrame, merges: list[tuple[str, str]]) -> DataFrame:
    """Rewrite ``syms`` with an ordered list of merges (narrow, no shuffle)."""
    return words.withColumn("syms", apply_merges(F.col("syms"), merges))


def update_pair_counts(pairs: DataFrame, words: DataFrame, merges: list[tuple[str, str]]) -> DataFrame:
    """New pair counts after ``merges``, from the changed words only.

    ``−old`` and ``+new`` pair rows of the words that hold a merged pair are
    added to the old counts; pairs that reach zero disappear.
    """
    hit = words.filter(_any_pair(merges))
    old = pair_rows(hit, sign=-1)
    new = pair_rows(merge_words(hit, merges))
    delta = old.unionByName(new).groupBy("l", "r").agg(F.sum("w").alias("n"))
    return (pairs.unionByName(delta).groupBy("l", "r").agg(F.sum("n").alias("n"))
            .filter(F.col("n") > 0))


def _any_pair(merges: list[tuple[str, str]]):
    cond = F.lit(False)
    for l_hex, r_hex in merges:
        cond = cond | F.contains(F.col("syms"), F.lit(merge_pattern(l_hex, r_hex)[0]))
    return cond


def adjacent_pairs(words: DataFrame) -> DataFrame:
    """W1 in row form: each symbol of a word with its successor (null behind the last); narrow."""
    syms = syms_array("syms")
    follow = F.arrays_zip(syms.alias("sym"), F.slice(syms, 2, F.greatest(F.size(syms) - 1, F.lit(0))).alias("next_sym"))
    return words.select("word", F.posexplode(follow).alias("pos", "p")).select("word", "pos", "p.sym", "p.next_sym")
