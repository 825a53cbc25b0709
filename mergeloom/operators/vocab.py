"""Vocabulary tables.

A vocabulary has at most ``vocab_size`` rows; joins broadcast it after a check of
its size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.display import byte_to_char
from ..session import small

VOCAB_SCHEMA = "token_id int, token_hex string, token_freq bigint, is_special boolean"


def base_vocab(spark: SparkSession, specials: Sequence[str], byte_freq: DataFrame | None = None) -> DataFrame:
    """P5 + U1: 256 byte tokens, then each special whose bytes are new, from id 256."""
    b = spark.range(256).select(F.col("id").cast("int").alias("token_id"),
                                F.lpad(F.hex("id"), 2, "0").alias("token_hex"))
    if byte_freq is not None:
        b = b.join(F.broadcast(byte_freq.select(F.col("byte").alias("token_id"), F.col("freq").alias("token_freq"))), "token_id", "left")
        b = b.withColumn("token_freq", F.coalesce("token_freq", F.lit(0)).cast("long"))
    else:
        b = b.withColumn("token_freq", F.lit(0).cast("long"))
    b = b.withColumn("is_special", F.lit(False))
    rows, taken = [], {bytes([i]) for i in range(256)}
    for s in specials:
        e = s.encode("utf-8")
        if e in taken:
            continue
        taken.add(e)
        rows.append((256 + len(rows), e.hex().upper(), 0, True))
    sp = spark.createDataFrame(rows, VOCAB_SCHEMA) if rows else None
    return b.unionByName(sp) if sp is not None else b


def vocab_union(base: DataFrame, extra: DataFrame) -> DataFrame:
    """Append the rows of ``extra`` whose bytes are not in ``base`` yet."""
    new = extra.join(small(base.select("token_hex")), "token_hex", "left_anti")
    return base.unionByName(new)


def vocab_diff(a: DataFrame, b: DataFrame, cols: Sequence[str] = ("token_id", "token_hex")) -> DataFrame:
    """Rows only in ``a`` and rows only in ``b`` (empty when equal as sets)."""
    x, y = a.select(*cols), b.select(*cols)
    return (x.exceptAll(y).withColumn("side", F.lit("only_a"))
            .unionByName(y.exceptAll(x).withColumn("side", F.lit("only_b"))))


def vocab_listing(vocab: DataFrame) -> DataFrame:
    """T5: vocabulary in id order."""
    return vocab.orderBy("token_id")


def display_array() -> Column:
    """256-entry constant: printable alias of each byte (index = byte)."""
    m = byte_to_char()
    return F.split(F.lit("\t".join(m[i] for i in range(256))), "\t")


def byte_display(hex_col: Column | str) -> Column:
    """Token hex → printable alias string (one character per byte)."""
    h = F.col(hex_col) if isinstance(hex_col, str) else hex_col
    arr = display_array()
    pairs = F.regexp_extract_all(h, F.lit("(..)"), F.lit(1))
    return F.array_join(F.transform(pairs, lambda x: F.element_at(arr, F.conv(x, 16, 10).cast("int") + 1)), "")


def byte_undisplay(disp_col: Column | str) -> Column:
    """P6 inverse: printable alias string → token hex (null on an unknown character)."""
    d = F.col(disp_col) if isinstance(disp_col, str) else disp_col
    arr = display_array()
    chars = F.regexp_extract_all(d, F.lit("(?s)(.)"), F.lit(1))
    places = F.transform(chars, lambda c: F.array_position(arr, c))
    spelled = F.array_join(F.transform(places, lambda p: F.lpad(F.hex(p - 1), 2, "0")), "")
    return F.when(~F.exists(places, lambda p: p == 0), spelled)
