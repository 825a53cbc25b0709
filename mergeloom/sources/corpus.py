"""Text corpora and the parquet test tables (read_corpus, cache_word_counts)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.patterns import END_OF_TEXT
from ..session import scratch_path, small, spread

MAX_BROADCAST_SPLITS = 1 << 17  # of a path and two numbers each, some 30 MB; more meet in a shuffled join

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str, spread_small: bool = True) -> DataFrame:
    """A parquet test table; single-split inputs are spread over the cores."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return spread(df) if spread_small else df


def drop_invalid_utf8(text: Column) -> Column:
    """``text`` without bytes that are not UTF-8 (D12); genuine U+FFFD characters stay.

    They are set aside (as U+0001 and a digit, U+0001 likewise) while the others, which
    ``make_valid_utf8`` writes for bad bytes, are taken out.
    """
    mark, bad = "\x01", "\ufffd"
    aside = F.replace(F.replace(text, F.lit(mark), F.lit(mark + "0")), F.lit(bad), F.lit(mark + "1"))
    clean = F.replace(F.make_valid_utf8(aside), F.lit(bad), F.lit(""))
    return F.replace(F.replace(clean, F.lit(mark + "1"), F.lit(bad)), F.lit(mark + "0"), F.lit(mark))


def read_corpus(spark: SparkSession, path: str, separator: str = END_OF_TEXT,
                drop_invalid: bool = True) -> DataFrame:
    """Scan text files whose documents are separated by ``separator``.

    One row per document, empty ones included: ``(doc_id, path, text)``.  Splits of large
    files are read in parallel by the text source (``lineSep`` may be several characters).
    ``doc_id`` counts documents in the order of path and place, from 0, however the
    files are split: documents of the splits before, then those before in the split.
    Bytes that are not UTF-8 are dropped unless ``drop_invalid`` is false.

    The files are scanned once: their documents are written to a scratch table, each with
    its split and a number that rises within it, when this function is called.  Splits are
    counted in that table, so no second scan has to agree with the first, and a task that
    is run again gives the same ids.  An empty input gives no rows.
    """
    text = drop_invalid_utf8(F.col("value")) if drop_invalid else F.col("value")
    stored = scratch_path(spark, "corpus")
    (spark.read.option("lineSep", separator).text(path)
     .select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("split"),
             F.monotonically_increasing_id().alias("row"), text.alias("text")).write.parquet(stored))
    docs = spark.read.schema("path string, split bigint, row bigint, text string").parquet(stored)
    splits = docs.groupBy("path", "split").agg(F.min("row").alias("first"), F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("path", "split").rowsBetween(Window.unboundedPreceding, -1)  # one row a split of a file
    starts = splits.select("path", "split", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift"))
    return docs.join(small(starts, MAX_BROADCAST_SPLITS), ["path", "split"]).select(
        (F.col("row") + F.col("shift")).alias("doc_id"), "path", "text")


def write_corpus(df: DataFrame, path: str, text_col: str = "text", separator: str = END_OF_TEXT) -> None:
    """Write texts as files of separator-terminated documents."""
    df.select(F.col(text_col).alias("value")).write.mode("overwrite").option("lineSep", separator).text(path)


def cache_word_counts(spark: SparkSession, path: str, compute) -> DataFrame:
    """Reuse stored word counts at ``path`` if present, else compute and store them."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS")):
        compute().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
