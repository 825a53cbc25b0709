"""Pre-tokenization and word counting.

Everything here is built-in expressions: the split is one ``regexp_extract_all``
per text piece (compiled once per task), counting is a partial + final hash
aggregate, so a very common word is pre-summed inside every task before the
shuffle and never lands whole on one reducer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.patterns import special_pattern, spark_pattern
from ..functions.symbols import syms_array, to_syms


def pretoken_array(text: Column | str, specials: Sequence[str] | None = None) -> Column:
    """ARRAY<STRING> of the pre-tokens of ``text`` (P1, with P2 when specials are given)."""
    t = F.col(text) if isinstance(text, str) else text
    pat = F.lit(spark_pattern())
    if not specials:
        return F.regexp_extract_all(t, pat, F.lit(0))
    sp = special_pattern(specials)
    # zip_with evaluates both arrays once a row and pads the shorter one (the
    # specials) with null; an expression named inside a lambda would be
    # evaluated again for every piece.
    none = F.array().cast("array<string>")
    return F.flatten(F.zip_with(
        F.split(t, sp, -1), F.regexp_extract_all(t, F.lit(sp), F.lit(0)),
        lambda piece, special: F.concat(F.regexp_extract_all(piece, pat, F.lit(0)),
                                        F.when(special.isNull(), none).otherwise(F.array(special)))))


def pretokenize(df: DataFrame, text_col: str = "text", specials: Sequence[str] | None = None,
                keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """One row per pre-token occurrence: ``keep..., pos, pretoken``."""
    cols = [F.col(c) for c in keep]
    return df.select(*cols, F.posexplode(pretoken_array(text_col, specials)).alias("pos", "pretoken"))


def split_specials(df: DataFrame, specials: Sequence[str], text_col: str = "text",
                   keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Pre-tokens with an ``is_special`` flag; specials are never split."""
    return pretokenize(df, text_col, specials, keep).withColumn(
        "is_special", F.col("pretoken").isin(list(specials)))


def count_words(df: DataFrame, text_col: str = "text", specials: Sequence[str] | None = None,
                drop_specials: bool = True) -> DataFrame:
    """A1: ``(word, freq)`` for every distinct pre-token; P3 drops the specials."""
    words = df.select(F.explode(pretoken_array(text_col, specials)).alias("word"))
    if specials and drop_specials:
        words = drop_separators(words, specials)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("freq"))


def merge_counts(a: DataFrame, b: DataFrame) -> DataFrame:
    """A2: add two ``(word, freq)`` tables."""
    return a.unionByName(b).groupBy("word").agg(F.sum("freq").alias("freq"))


def drop_separators(words: DataFrame, specials: Sequence[str]) -> DataFrame:
    """Remove the separators from a table of words (counted or not)."""
    return words.filter(~F.col("word").isin(list(specials)))


def with_symbols(words: DataFrame) -> DataFrame:
    """Add ``syms`` (single-byte symbols) to a ``(word, freq)`` table."""
    return words.withColumn("syms", to_syms("word"))


def byte_frequencies(words: DataFrame) -> DataFrame:
    """A3: weighted frequency of each byte value present: ``(byte, freq)``."""
    src = words if "syms" in words.columns else with_symbols(words)
    return (src.select(F.explode(syms_array("syms")).alias("h"), "freq")
            .groupBy("h").agg(F.sum("freq").alias("freq"))
            .select(F.conv("h", 16, 10).cast("int").alias("byte"), "freq"))


def missing_separators(spark, words: DataFrame, specials: Sequence[str]) -> DataFrame:
    """Specials that never occur in the counted words (left anti join)."""
    sp = spark.createDataFrame([(s,) for s in specials], "word string")
    # Shrink the big side to the specials first: the anti join then joins two tiny tables.
    present = words.filter(F.col("word").isin(list(specials))).select("word")
    return sp.join(present, "word", "left_anti")
