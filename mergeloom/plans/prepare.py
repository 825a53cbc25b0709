"""Corpus → encoded token shards (encode, end-of-text, shard, write, offsets)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.batches import assign_shards, ordered_blocks, stream_offsets, tokens_before
from ..operators.encode import encode
from ..session import shuffles_dropped
from ..sources.shards import read_token_shards, write_token_shards
from .train import BPEModel

TEXT_ROWS = 1 << 14  # texts of a range


def prepare_dataset(corpus: DataFrame, model: BPEModel, out_path: str, n_shards: int,
                    text_col: str = "text", id_col: str = "doc_id", mode: str = "rank") -> DataFrame:
    """Encode every document, append the end-of-text id (D16), write the shard
    table partitioned by shard, and return it read back with each document's
    ``offset`` in its shard's stream (W3).

    The texts are cut into ranges of shard and id first; the encoder then runs once, on
    the way into the files, and each shard has as many files as ranges touch it.  The
    stored ``block`` is what the two-level offsets are summed over, beside the tokens before
    each document in it: no ids are shuffled, and the texts' shuffle goes with the write.
    Compact ids are checked against the vocabulary's size before anything runs.
    """
    if len(model.vocab_rows()) > 1 << 16:
        raise ValueError("ids of this vocabulary do not fit 16 bits")
    docs = assign_shards(corpus.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), n_shards)
    ranged = ordered_blocks(docs, block_rows=TEXT_ROWS).sortWithinPartitions("shard_id", "doc_id")
    enc = encode(ranged, model, "text", mode=mode, append_eot=True).select("doc_id", "shard_id", "block", "ids")
    summed = tokens_before(enc.withColumn("n_tokens", F.size("ids").cast("long")))
    with shuffles_dropped(corpus.sparkSession):
        write_token_shards(summed, out_path, compact=False)
    return stream_offsets(read_token_shards(corpus.sparkSession, out_path))
