"""Sharding by a two-pass external shuffle, in DataFrame operations only.

Pass one tags every record with a seeded draw and writes it to the shared folder, so
that the draw of a record is the same in every later read.  Pass two scatters the
records by their draw into buckets of a bounded size and Fisher-Yates shuffles each:
the swap partner of place ``i`` is a seeded hash of bucket and place, so a task run
again gives the same order.  Buckets laid end to end are one shuffled sequence, which is
dealt to the shards in turn; their row counts differ by one at most.

The draw hashes the record's place in the input and no column, so copies, equal keys
and null keys scatter like all other records.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import let, without, written

TASK_BYTES = 64 << 20  # of records that a task shuffles, about
BLOCK = 1024  # buckets whose offsets are summed together


def text_size(text: Column) -> Column:
    """UTF-8 bytes of a text (null: none) plus 1."""
    return (F.octet_length(F.coalesce(text, F.lit(""))) + 1).cast("long")


def permutation(n: Column, seed: int, bucket: Column) -> Column:
    """A Fisher-Yates permutation of ``0 .. n - 1`` (inside-out form) drawn from hashes of the place."""
    def place(order: Column, i: Column) -> Column:
        def put(j: Column) -> Column:
            return F.when(j == i, F.concat(order, F.array(i))).otherwise(F.concat(
                F.slice(order, F.lit(1), j), F.array(i), F.slice(order, j + 2, F.greatest(i - j - 1, F.lit(0))),
                F.array(F.get(order, j))))
        return let(F.pmod(F.xxhash64(F.lit(seed), bucket, i), i + 1).cast("int"), put)

    one = F.array(F.lit(0))
    return F.when(n <= 1, F.slice(one, F.lit(1), n)).otherwise(
        F.aggregate(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))), one, place))


def bucket_offsets(sizes: DataFrame) -> DataFrame:
    """``(bucket, n)`` -> ``(bucket, offset)``: rows before each bucket, summed in two levels."""
    sizes = sizes.withColumn("block", F.floor(F.col("bucket") / BLOCK))
    before = (sizes.groupBy("block").agg(F.sum("n").alias("n"))
              .select("block", (F.sum("n").over(W.orderBy("block")) - F.col("n")).alias("base")))
    inner = F.sum("n").over(W.partitionBy("block").orderBy("bucket")) - F.col("n")
    return sizes.select("block", "bucket", inner.alias("own")).join(before, "block").select(
        "bucket", (F.col("base") + F.col("own")).alias("offset"))


def shard(records: DataFrame, shards: int = 8, seed: int = 42, bucket_rows: int = 1024,
          bucket_bytes: int = 32 << 20, text: str = "text") -> DataFrame:
    """All records with ``shard`` (0 to ``shards - 1``) and ``slot`` (gapless from 0 in each shard).

    The law is ``rows``: shard sizes differ by one at most.  ``bucket_rows`` and
    ``bucket_bytes`` set the mean size of the buckets that one task holds.  Nulls in any
    column, empty and very long texts, and repeated rows are records like all others (a
    repeated row is dealt once for every time it occurs); an empty table gives an empty
    result; columns named ``shard`` or ``slot`` are replaced.  The same input files, read
    in the same splits, give the same shards.
    """
    if shards < 1:
        raise ValueError("shards must be positive")
    records = without(records, ["shard", "slot", "__size", "__row", "__draw"])
    columns = records.columns
    tagged = records.withColumns({
        "__size": text_size(F.col(f"`{text}`")) if text in columns else F.lit(1).cast("long"),
        "__row": F.monotonically_increasing_id()}).withColumn("__draw", F.xxhash64(F.lit(seed), F.col("__row")))
    table = written(tagged, "scatter")
    total = table.agg(F.count("*").alias("rows"), F.coalesce(F.sum("__size"), F.lit(0)).alias("bytes")).first()
    buckets = max(1, math.ceil(total["rows"] / bucket_rows), math.ceil(total["bytes"] / bucket_bytes))
    table = table.withColumn("bucket", F.pmod("__draw", F.lit(buckets)))
    offsets = bucket_offsets(table.groupBy("bucket").agg(F.count("*").alias("n")))
    record = F.struct("__draw", "__row", *[f"`{c}`" for c in columns])
    # tasks of about TASK_BYTES, however large the input is
    width = max(int(table.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(total["bytes"] / TASK_BYTES))
    filled = table.repartition(width, "bucket").groupBy("bucket").agg(F.collect_list(record).alias("held"))  # bounded by design

    def dealt(held: Column) -> Column:
        """The records in the bucket's order: sorted by draw and row alone, then permuted."""
        order = F.sort_array(F.transform(held, lambda r, i: F.struct(r["__draw"], r["__row"], i.alias("at"))))
        return let(order, lambda by: F.transform(permutation(F.size(held), seed, F.col("bucket")), lambda p: F.get(held, F.get(by, p)["at"])))

    shuffled = filled.select("bucket", let(F.col("held"), dealt).alias("held"))
    rows = shuffled.join(offsets, "bucket").select("offset", F.posexplode("held").alias("at", "r"))
    place = F.col("offset") + F.col("at")
    return rows.select(*[F.col(f"r.`{c}`") for c in columns], F.pmod(place, F.lit(shards)).cast("int").alias("shard"),
                       F.floor(place / shards).cast("long").alias("slot"))


def write_shards(sharded: DataFrame, path: str) -> None:
    """Write one folder a shard; rows inside a file follow their slots.

    Nulls, empty and very long texts and repeated rows are written like all others; an
    empty table writes no shard.  A folder that is there already raises.
    """
    sharded.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
