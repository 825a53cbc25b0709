"""Token shards: parquet tables partitioned by shard, and raw little-endian uint16 files (``raw_shards``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .raw_shards import read_raw_shards, stream_digests, write_raw_shards

__all__ = ["write_token_shards", "read_token_shards", "write_raw_shards", "read_raw_shards", "stream_digests"]


def write_token_shards(df: DataFrame, path: str, ids_col: str = "ids", compact: bool = True,
                       files_per_shard: int = 8) -> None:
    """Write ``(shard_id, doc_id, ids)`` partitioned by shard, several files a shard.

    With ``compact`` every id must fit 16 bits (D15); the write itself raises, so the
    rows are made once.  Rows that carry a ``block`` (ranges of the shard and id) are
    written as they lie; others are spread over ``files_per_shard`` tasks for each shard.
    """
    if compact:
        bad = F.exists(ids_col, lambda i: (i < 0) | (i > 0xFFFF))
        df = df.withColumn(ids_col, F.when(~bad, F.col(ids_col)).otherwise(F.raise_error(F.lit("an id does not fit 16 bits"))))
    if "block" not in df.columns:
        df = df.repartition(F.col("shard_id"), F.pmod(F.xxhash64("doc_id"), F.lit(files_per_shard)))
        df = df.sortWithinPartitions("shard_id", "doc_id")
    df.write.mode("overwrite").partitionBy("shard_id").parquet(path)


def read_token_shards(spark: SparkSession, path: str) -> DataFrame:
    """Read the shard table back (hidden files are ignored by the source)."""
    return spark.read.parquet(path)
