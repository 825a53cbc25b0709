"""Token shards, stream offsets, training windows and batches.

Nothing here gathers a whole shard or stream in one task:

* stream offsets are a two-level prefix sum over blocks of rows that a range
  partitioning has cut (whatever the ids look like), so a window function sees one block;
* a window is assembled from the document slices that overlap it, so a group
  holds at most ``w`` tokens however long the documents are; ids are packed
  (``packed_ids``) wherever they are shuffled;
* the seeded batch order is a rank of the windows' keys over hash buckets, as many
  as their number asks for, plus per-bucket offsets; or, where the windows of each shard
  are counted, a permutation of their numbers by arithmetic alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import MAX_BROADCAST_IDS, scratch_path, ship_package, small
from .packed_ids import SLICE_IDS, any_odd, packable, packed, packed_rows, row_slices, text_slices, unpacked

BLOCK_ROWS = 1 << 18  # rows of a block of the two-level sums


def seeded_hash(*parts: Column | str, bits: int = 60) -> Column:
    """Non-negative BIGINT from md5 of ``parts`` joined by ``|`` (same in DuckDB)."""
    cols = [F.col(p) if isinstance(p, str) else p for p in parts]
    digits = bits // 4
    return F.conv(F.substring(F.md5(F.concat_ws("|", *[c.cast("string") for c in cols])), 1, digits), 16, 10).cast("long")


def assign_shards(encoded: DataFrame, n_shards: int, id_col: str = "doc_id") -> DataFrame:
    """Shard of each document: ``pmod(doc_id, n_shards)``; a shard's stream is its documents by id."""
    return encoded.withColumn("shard_id", F.pmod(F.col(id_col), F.lit(n_shards)).cast("int"))


def block_count(n: int, cores: int, rows: int = BLOCK_ROWS) -> int:
    """Blocks for ``n`` rows: of ``rows`` rows each, and one per core as soon as that pays."""
    return max(1, -(-n // rows), min(cores, -(-n // 256)))


def ordered_blocks(docs: DataFrame, key: str = "doc_id", part: str = "shard_id", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Rows in ranges of ``(part, key)`` with the range's number as ``block``; not yet cut from the lineage."""
    n = block_count(docs.count(), docs.sparkSession.sparkContext.defaultParallelism, block_rows)
    return docs.repartitionByRange(n, part, key).withColumn("block", F.spark_partition_id())


def tokens_before(docs: DataFrame, len_col: str = "n_tokens", key: str = "doc_id", part: str = "shard_id") -> DataFrame:
    """Add ``before``: the tokens of the rows ahead of each one in its ``block`` and ``part``.

    For rows whose partitions are blocks, sorted by ``(part, key)``: a running sum where they
    lie, nothing is shuffled.  Rows of equal keys count in the order of a hash of their ids.
    """
    ship_package(docs.sparkSession)
    names = docs.columns

    def summed(rows: pa.RecordBatch, state: list) -> pa.RecordBatch:
        parts, keys, lens, ties = (rows.column(c).to_pylist() for c in (part, key, len_col, "_tie"))
        before, i = [0] * len(lens), 0
        while i < len(lens):
            if parts[i] != state[0]:
                state[:] = [parts[i], 0]
            j = i + 1
            while j < len(lens) and keys[j] == keys[i] and parts[j] == parts[i]:
                j += 1
            for r in sorted(range(i, j), key=ties.__getitem__) if j > i + 1 else (i,):
                before[r] = state[1]
                state[1] += max(lens[r] or 0, 0)
            i = j
        return pa.RecordBatch.from_arrays([*(rows.column(c) for c in names), pa.array(before, pa.int64())], names=[*names, "before"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, held = [None, 0], None
        for rows in batches:
            if held is not None and len(held):
                rows = pa.concat_batches([held, rows])
            parts, keys = rows.column(part).to_pylist(), rows.column(key).to_pylist()
            cut = len(rows) - 1  # the last key may go on in the next batch
            while cut > 0 and keys[cut - 1] == keys[-1] and parts[cut - 1] == parts[-1]:
                cut -= 1
            held = rows.slice(max(cut, 0))
            if cut > 0:
                yield summed(rows.slice(0, cut), state)
        if held is not None:
            yield summed(held, state)

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in docs.schema)
    return docs.withColumn("_tie", F.xxhash64("ids")).mapInArrow(run, f"{kinds}, before long")


def stream_offsets(docs: DataFrame, len_col: str = "n_tokens", key: str = "doc_id", part: str = "shard_id",
                   block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Position of each document in its shard's concatenated stream.

    ``offset = Σ len`` of the earlier documents of the shard: totals of the blocks
    before, then the rows before inside the block.  Rows that carry a ``block`` (as the
    stored shards do) keep theirs; others are cut into ranges first, in a written table,
    since the numbers of a range partitioning hold for one evaluation only.  Rows that also
    carry the tokens ``before`` them in their block are not shuffled.
    """
    if "block" not in docs.columns:
        spark, path = docs.sparkSession, scratch_path(docs.sparkSession, "blocks")
        ordered_blocks(docs, key, part, block_rows).write.parquet(path)
        docs = spark.read.parquet(path)
    totals = docs.groupBy(part, "block").agg(F.sum(len_col).alias("_bt"))
    before = Window.partitionBy(part).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    block_off = totals.select(part, "block", F.coalesce(F.sum("_bt").over(before), F.lit(0)).alias("_bo"))
    if "before" in docs.columns:
        return (docs.join(small(block_off), [part, "block"])
                .withColumn("offset", (F.col("_bo") + F.col("before")).cast("long"))
                .drop("block", "before", "_bo"))
    ties = [F.xxhash64(c) for c in ("ids",) if c in docs.columns]
    inner = Window.partitionBy(part, "block").orderBy(key, *ties).rowsBetween(Window.unboundedPreceding, -1)
    return (docs.withColumn("_io", F.coalesce(F.sum(len_col).over(inner), F.lit(0)))
            .join(block_off, [part, "block"])
            .withColumn("offset", (F.col("_bo") + F.col("_io")).cast("long"))
            .drop("block", "_bo", "_io"))


def pad_window(arr: Column, n: int, pad_id: int = 0) -> Column:
    """Right-pad an array to length ``n`` with ``pad_id``."""
    return F.concat(arr, F.array_repeat(F.lit(pad_id), F.greatest(F.lit(n) - F.size(arr), F.lit(0))))


def shift_targets(window: Column, n: int) -> tuple[Column, Column]:
    """inputs = all but the last, targets = all but the first."""
    return F.slice(window, 1, n - 1), F.slice(window, 2, n - 1)


def _pieces(docs: DataFrame, w: int, ids_col: str, part: str, overlap: int) -> DataFrame:
    """``part, window_idx, start, piece``: the slice of each document in each window that it overlaps."""
    n = F.size(ids_col)
    first = F.greatest(F.lit(0), F.floor((F.col("offset") - overlap) / w))
    last = F.floor((F.col("offset") + n - 1) / w)
    return (docs.filter(n > 0)
            .select(part, "offset", ids_col, F.explode(F.sequence(first, last)).alias("window_idx"))
            .withColumn("_s", F.greatest(F.col("window_idx") * w, F.col("offset")))
            .withColumn("_e", F.least((F.col("window_idx") + 1) * w + overlap, F.col("offset") + F.size(ids_col)))
            .select(part, "window_idx", F.col("_s").alias("start"),
                    F.slice(ids_col, (F.col("_s") - F.col("offset") + 1).cast("int"), (F.col("_e") - F.col("_s")).cast("int")).alias("piece")))


def _packed_pieces(docs: DataFrame, w: int, ids_col: str, part: str, overlap: int) -> DataFrame:
    """The same with packed pieces, cut in Python from documents that are packed once, no row holding more."""
    ship_package(docs.sparkSession)
    names = [part, "window_idx", "start", "text", "piece"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for ids in row_slices(batch.column(ids_col), SLICE_IDS):
                rows, at = batch.slice(at, len(ids)), at + len(ids)
                offset = np.asarray(rows.column("offset").fill_null(0)).astype(np.int64)
                tokens, n, data, places, odd = packed_rows(ids)
                first = np.maximum(0, (offset - overlap) // w)
                counts = np.where(n > 0, (offset + n - 1) // w - first + 1, 0)
                of = np.repeat(np.arange(len(n)), counts)
                window = first[of] + np.arange(len(of)) - np.repeat(np.cumsum(counts) - counts, counts)
                start, end = np.maximum(window * w, offset[of]), np.minimum((window + 1) * w + overlap, (offset + n)[of])
                low, high = tokens[of] + start - offset[of], tokens[of] + end - offset[of]
                bare = any_odd(odd, low, high)
                whole = ids.flatten() if bare.any() else None
                piece = pa.array([whole[x:y].to_pylist() if z else None for x, y, z in zip(low, high, bare)] if bare.any() else [None] * len(of), pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([rows.column(part).take(pa.array(of)), pa.array(window), pa.array(start),
                                                  text_slices(data, places[low], places[high], bare), piece], names=names)

    kind = docs.schema[part].dataType.simpleString()
    return docs.select(part, "offset", ids_col).mapInArrow(cut, f"{part} {kind}, window_idx long, start long, text string, piece array<int>")


def sequential_windows(docs: DataFrame, w: int, pad_id: int = 0, ids_col: str = "ids",
                       part: str = "shard_id", overlap: int = 0) -> DataFrame:
    """Windows of ``w`` tokens, ``w`` apart, over each shard stream, tail padded.

    ``overlap`` lets each window run on into the next one by that many tokens.

    ``docs`` needs ``part, offset, ids``.  The all-padding window that the
    reference emits when the length is a multiple of ``w`` is not produced.
    Output: ``part, window_idx, tokens, n_real``.
    """
    pieces = _packed_pieces(docs, w, ids_col, part, overlap) if packable(docs, ids_col) else _pieces(docs, w, ids_col, part, overlap)
    held = [c for c in ("text", "piece") if c in pieces.columns]
    grouped = pieces.groupBy(part, "window_idx").agg(F.sort_array(F.collect_list(F.struct("start", *held))).alias("_p"))
    found = F.transform("_p", lambda x: unpacked(x["text"], x["piece"]) if "text" in held else x["piece"])
    whole = grouped.select(part, "window_idx", F.flatten(found).alias("_t"))  # a column: joined once
    return whole.select(part, "window_idx", pad_window(F.col("_t"), w + overlap, pad_id).alias("tokens"), F.size("_t").alias("n_real"))


def training_pairs(windows: DataFrame, w: int) -> DataFrame:
    """P12 over windows: ``input_ids`` / ``target_ids`` of length ``w - 1``."""
    x, y = shift_targets(F.col("tokens"), w)
    return windows.withColumn("input_ids", x).withColumn("target_ids", y)


def random_windows(docs: DataFrame, length: int, n_samples: Column | None = None, seed: int = 0,
                   part: str = "shard_id", ids_col: str = "ids") -> DataFrame:
    """Windows at seeded uniform starts in ``[0, n - length)`` of each shard stream.

    Each shard gets ``floor(n / length)`` samples unless ``n_samples`` says otherwise.
    Tokens are fetched from blocks that overlap by ``length`` tokens, so a span lies in
    one of them (one equi-join).  Sample numbers are spread over tasks before they are
    made: no row holds a shard's numbers.  The runs that they are made from are few and
    small, which says nothing of their number: neither are tasks merged nor the samples
    broadcast for it.
    Output: ``part, sample_idx, start, input_ids, target_ids``.
    """
    blk, step = max(length + 1, 1024), 4096
    blocks = sequential_windows(docs, blk, 0, ids_col, part, overlap=length).select(
        part, F.col("window_idx").alias("b"), F.slice("tokens", 1, F.col("n_real")).alias("toks"))
    totals = docs.groupBy(part).agg(F.sum(F.size(ids_col)).alias("n"))
    count = n_samples if n_samples is not None else F.floor(F.col("n") / length)
    runs = (totals.filter(F.col("n") > length).withColumn("_c", count.cast("long")).filter(F.col("_c") > 0)
            .select(part, "n", "_c", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_c") - 1) / step))).alias("_run"))
            .repartition(4 * docs.sparkSession.sparkContext.defaultParallelism, F.col(part), F.col("_run")))
    spans = (runs.select(part, "n", F.explode(F.sequence(F.col("_run") * step, F.least((F.col("_run") + 1) * step, F.col("_c")) - 1)).alias("sample_idx"))
             .withColumn("start", F.pmod(seeded_hash(F.lit(seed), F.col(part), F.col("sample_idx")), F.col("n") - length))
             .select(F.col(part).alias("_part"), "sample_idx", "start"))
    joined = spans.hint("merge").join(blocks, (F.col("_part") == F.col(part)) & (F.floor(F.col("start") / blk) == F.col("b"))).withColumn(
        "_w", F.slice("toks", (F.col("start") - F.col("b") * blk + 1).cast("int"), length + 1))
    return joined.select(part, "sample_idx", "start", F.slice("_w", 1, length).alias("input_ids"),
                         F.slice("_w", 2, length).alias("target_ids"))


def rank_by_hash(df: DataFrame, key: Column, order: list[str], name: str = "rn",
                 bits: int = 60, rows: int = BLOCK_ROWS) -> DataFrame:
    """0-based global rank by a uniform ``bits``-bit hash ``key`` (ties by ``order``).

    Rows go to buckets by the top bits of the key, about ``rows`` rows each, are numbered
    inside their bucket and get the bucket's offset from the counts of those before.  The
    rows are written once, with their keys, as they are counted, bucketed and numbered.
    """
    spark, path = df.sparkSession, scratch_path(df.sparkSession, "ranked")
    keyed = df.withColumn("_key", key)
    keyed.write.parquet(path)
    keyed = spark.read.schema(keyed.schema).parquet(path)
    n = block_count(keyed.count(), spark.sparkContext.defaultParallelism, rows)
    s = keyed.withColumn("_bkt", F.shiftright(F.col("_key"), bits - (n - 1).bit_length()))
    counts = s.groupBy("_bkt").agg(F.count(F.lit(1)).alias("_c"))
    before = Window.orderBy("_bkt").rowsBetween(Window.unboundedPreceding, -1)  # one row a bucket
    offs = counts.select("_bkt", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_off"))
    local = F.row_number().over(Window.partitionBy("_bkt").orderBy("_key", *order)) - 1
    return (s.withColumn("_local", local).join(offs, "_bkt")
            .withColumn(name, (F.col("_off") + F.col("_local")).cast("long"))
            .drop("_key", "_bkt", "_local", "_off"))


def build_batches(windows: DataFrame, batch_size: int, seed: int = 0, part: str = "shard_id") -> DataFrame:
    """Seeded order over all windows, cut into batches of ``batch_size`` rows (only their keys are ranked)."""
    ranked = rank_by_hash(windows.select(part, "window_idx"), seeded_hash(F.lit(seed), F.col(part), F.col("window_idx")),
                          [part, "window_idx"])
    return (windows.join(ranked, [part, "window_idx"])
            .withColumn("batch_id", F.floor(F.col("rn") / batch_size).cast("long"))
            .withColumn("row_in_batch", (F.col("rn") % batch_size).cast("int")).drop("rn"))


def window_counts(docs: DataFrame, w: int, part: str = "shard_id", len_col: str = "n_tokens") -> DataFrame:
    """``part, n``: how many windows of ``w`` tokens each shard's stream has, from the documents' lengths."""
    return docs.groupBy(part).agg(F.sum(len_col).alias("_t")).select(part, F.ceil(F.col("_t") / w).alias("n"))


FEISTEL_ROUNDS = 4
WALKS = 64  # a walk goes on with probability 1/2 at most


def permuted(number: Column, n: Column | int, seed: Column | int) -> Column:
    """The place of ``number`` (0 to ``n - 1``) in a seeded permutation of the ``n`` numbers.

    A Feistel network over the bits that ``n`` needs permutes up to ``2^bits``; places that
    fall behind ``n`` walk on through it until one does not.  The halves' widths differ by
    one where the bits are odd and change places every round.
    """
    n = F.lit(n).cast("long") if isinstance(n, int) else n.cast("long")
    seed = F.lit(seed) if isinstance(seed, int) else seed
    bits = F.greatest(F.length(F.bin(n - 1)), F.lit(2))
    low = F.floor(bits / 2).cast("int")
    ones = F.lit(1).cast("long")

    def shift(x: Column, by: Column) -> Column:
        return F.call_function("shiftleft", x, by)

    def network(x: Column) -> Column:
        start = F.struct(F.call_function("shiftright", x, low).alias("l"), x.bitwiseAND(shift(ones, low) - 1).alias("r"))
        halves = F.aggregate(F.sequence(F.lit(0), F.lit(FEISTEL_ROUNDS - 1)), start, lambda s, i: F.struct(
            s["r"].alias("l"),
            s["l"].bitwiseXOR(seeded_hash(seed, i, s["r"]).bitwiseAND(shift(ones, F.when(i % 2 == 0, bits - low).otherwise(low)) - 1)).alias("r")))
        return F.aggregate(F.array(halves), F.lit(0).cast("long"), lambda _, h: shift(h["l"], low) + h["r"])

    place = F.aggregate(F.sequence(F.lit(1), F.lit(WALKS)), network(number.cast("long")), lambda y, _: F.when(y < n, y).otherwise(network(y)))
    return F.aggregate(F.array(place), F.lit(0).cast("long"), lambda _, y: F.when(y < n, y).otherwise(
        F.raise_error(F.lit("a permutation's walk did not end")).cast("long")))


def permuted_batches(windows: DataFrame, counts: DataFrame, batch_size: int, seed: int = 0, part: str = "shard_id") -> DataFrame:
    """W6 by arithmetic: batch and row of each window from a seeded permutation of all windows' numbers.

    A window's number is that of its shard's first window plus its own.  ``counts`` holds
    ``part, n`` (``window_counts``), a row a shard and at most ``MAX_BROADCAST_IDS``;
    ``windows`` are evaluated once, where they lie: no rank, no shuffle.
    """
    held = counts.select(part, "n").limit(MAX_BROADCAST_IDS + 1).collect()
    if len(held) > MAX_BROADCAST_IDS:
        raise ValueError("too many shards to number their windows from one table")
    rows, first = [], 0
    for shard, n in sorted((r[0], int(r[1])) for r in held):
        rows.append((shard, first))
        first += n
    bases = windows.sparkSession.createDataFrame(rows, f"{part} {counts.schema[part].dataType.simpleString()}, _first long")
    place = permuted(F.col("_first") + F.col("window_idx"), max(first, 1), seed)
    return (windows.join(F.broadcast(bases), part).withColumn("_at", place)
            .withColumn("batch_id", F.floor(F.col("_at") / batch_size).cast("long"))
            .withColumn("row_in_batch", (F.col("_at") % batch_size).cast("int")).drop("_first", "_at"))


def assign_device(batches: DataFrame, batch_size: int, n_devices: int) -> DataFrame:
    """Contiguous equal split of each batch over ``n_devices``."""
    if batch_size % n_devices:
        raise ValueError("batch size must divide evenly over devices")
    per = batch_size // n_devices
    return batches.withColumn("device_id", F.floor(F.col("row_in_batch") / per).cast("int"))


def preview_batch(batches: DataFrame, n: int = 512, col: str = "input_ids") -> DataFrame:
    """The first ``n`` ids of each batch, rows (of equal length) in order, flattened; later rows are not shuffled."""
    rows = batches.filter(F.col("row_in_batch") * F.size(col) < n).select("batch_id", "row_in_batch", F.col(col).alias("_ids"))
    pack = packable(rows, "_ids")
    if pack:
        ship_package(batches.sparkSession)
        rows = rows.withColumn("_text", packed("_ids")).withColumn("_ids", F.when(F.col("_text").isNull(), F.col("_ids")))
    held = ["_text", "_ids"] if pack else ["_ids"]
    g = rows.groupBy("batch_id").agg(F.sort_array(F.collect_list(F.struct("row_in_batch", *held))).alias("_r"))
    found = F.transform("_r", lambda x: unpacked(x["_text"], x["_ids"]) if pack else x["_ids"])
    return g.select("batch_id", F.slice(F.flatten(found), 1, n).alias("preview_ids"))


def sample_shards(steps: DataFrame, n_shards: int, batch_size: int, seed: int = 0,
                  replace: bool | None = None, by: str = "floyd") -> DataFrame:
    """Shard choices per step.

    Without replacement (``n_shards ≥ batch_size``) a uniform subset in a uniform order:
    by Floyd's algorithm, which draws ``batch_size`` times whatever the number of shards
    (the last candidate of a draw stands in for one that was drawn before), then ordered by
    a hash; or ``by="rank"``, the shards with the smallest seeded hashes of the step, all of
    which are hashed.  With replacement: an independent seeded shard per slot.  Narrow.
    Output ``step, slot, shard_id``.
    """
    if replace is None:
        replace = n_shards < batch_size
    if replace:
        slots = steps.select("step", F.explode(F.sequence(F.lit(0), F.lit(batch_size - 1))).alias("slot"))
        return slots.withColumn("shard_id", F.pmod(seeded_hash(F.lit(seed), F.col("step"), F.col("slot")), F.lit(n_shards)).cast("int"))
    if batch_size > n_shards:
        raise ValueError("more shards asked for than there are")
    if by == "rank":
        drawn = F.transform(F.sequence(F.lit(0), F.lit(n_shards - 1)), lambda s: F.struct(
            seeded_hash(F.lit(seed), F.col("step"), s).alias("h"), s.alias("shard_id")))
    else:
        chosen = F.aggregate(
            F.sequence(F.lit(n_shards - batch_size), F.lit(n_shards - 1)), F.array().cast("array<int>"),
            lambda have, last: F.aggregate(  # the draw is named once
                F.array(F.pmod(seeded_hash(F.lit(seed), F.col("step"), last), last + 1).cast("int")), have,
                lambda held, x: F.concat(held, F.array(F.when(F.array_contains(held, x), last).otherwise(x)))))
        drawn = F.transform(chosen, lambda s: F.struct(seeded_hash(F.lit(seed), F.col("step"), F.lit("order"), s).alias("h"), s.alias("shard_id")))
    return (steps.select("step", F.posexplode(F.slice(F.array_sort(drawn), 1, batch_size)).alias("slot", "s"))
            .select("step", "slot", F.col("s.shard_id").cast("int").alias("shard_id")))
