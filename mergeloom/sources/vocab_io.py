"""Vocabulary / merges interchange and the small tokenizer artifact.

* vocab JSON: one object ``{printable token: id}`` (bytes shown with the
  printable alias of :mod:`mergeloom.functions.display`);
* merges text: one ``A B`` line per merge, in rank order; lines without exactly
  two parts are skipped;
* artifact: ``vocab``, ``merges`` and ``config`` parquet tables.
"""

from __future__ import annotations

import json
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.display import display
from ..operators.vocab import byte_undisplay
from ..plans.train import BPEModel


def write_vocab_json(spark: SparkSession, model: BPEModel, path: str) -> None:
    """Write the vocabulary as one JSON object (a single small file)."""
    obj = {display(bytes.fromhex(h)): tid for tid, h, _, _ in model.vocab_rows()}
    spark.createDataFrame([(json.dumps(obj, ensure_ascii=False),)], "value string") \
        .coalesce(1).write.mode("overwrite").text(path)


def read_vocab(spark: SparkSession, path: str) -> DataFrame:
    """``(token_id, token_hex)`` from a vocab JSON object."""
    raw = spark.read.text(path, wholetext=True)
    m = F.from_json("value", "map<string,int>")
    return (raw.select(F.explode(m).alias("tok", "token_id"))
            .select(F.col("token_id").cast("int").alias("token_id"), byte_undisplay("tok").alias("token_hex")))


def write_merges_text(spark: SparkSession, model: BPEModel, path: str) -> None:
    lines = [f"{display(bytes.fromhex(l))} {display(bytes.fromhex(r))}" for l, r, _ in model.merges]
    # One row holding every line: the text writer appends the final newline.
    spark.createDataFrame([("\n".join(lines),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def read_merges(spark: SparkSession, path: str) -> DataFrame:
    """``(rank, left_hex, right_hex)`` in line order; malformed lines skipped.

    The file is one small text (bounded by the vocabulary), read whole; lines
    are filtered inside the array so the rank is the array position.
    """
    raw = spark.read.text(path, wholetext=True)
    lines = F.transform(F.split(F.col("value"), "\n"), lambda l: F.split(F.regexp_replace(l, r"\s+$", ""), " "))
    good = F.filter(lines, lambda p: F.size(p) == 2)
    return (raw.select(F.posexplode(good).alias("rank", "p"))
            .select(F.col("rank").cast("int").alias("rank"), byte_undisplay(F.col("p")[0]).alias("left_hex"),
                    byte_undisplay(F.col("p")[1]).alias("right_hex")))


def save_tokenizer(spark: SparkSession, model: BPEModel, path: str) -> None:
    """The small inference artifact: vocab, merges, config."""
    model.vocab_df(spark).write.mode("overwrite").parquet(os.path.join(path, "vocab"))
    model.merges_df(spark).write.mode("overwrite").parquet(os.path.join(path, "merges"))
    spark.createDataFrame([(json.dumps({"specials": model.specials, "vocab_size": model.n_base + len(model.merges)}),)],
                          "config string").write.mode("overwrite").parquet(os.path.join(path, "config"))


def load_tokenizer(spark: SparkSession, path: str) -> BPEModel:
    """Rebuild the model from the artifact (merges are ≤ vocab size rows)."""
    cfg = json.loads(spark.read.parquet(os.path.join(path, "config")).first()["config"])
    merges = spark.read.parquet(os.path.join(path, "merges")).orderBy("rank").select("left_hex", "right_hex", "pair_count").collect()
    vocab = spark.read.parquet(os.path.join(path, "vocab")).filter("token_id < 256").select("token_id", "token_freq").collect()
    return BPEModel(cfg["specials"], [(r.left_hex, r.right_hex, int(r.pair_count)) for r in merges],
                    {int(r.token_id): int(r.token_freq) for r in vocab})
