"""The corpus pipeline: five stages over ``documents``, each a Parquet table read by the next."""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from mergeloom.llm import decontaminate, langid, secret_scan, sentencepiece_codec, simhash  # noqa: E402
from mergeloom.llm.common import guarded, load  # noqa: E402
from mergeloom.llm.queries import PIECE_MODEL  # noqa: E402
from mergeloom.session import SCRATCH_PATHS, delete_path, ensure_checkpoint_dir, scratch_path  # noqa: E402


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents whose language is recognised; texts without a letter or null go.

    The model is fitted on a bounded sample of the stage's own labelled rows.  Where no
    row teaches a language, no text can be told from another: those with a letter stay.
    """
    ensure_checkpoint_dir(spark)
    model = langid.train(docs.select("doc_id", "text", "lang"))
    if not model.families:
        return langid.lettered(docs)
    return guarded(docs, ["lang_pred", "score"], lambda rows: langid.identify(rows, model).where(
        F.col("lang_pred") != langid.UNKNOWN))


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group (3-word shingles, 2 bits) stays.

    Null, empty and wordless texts have the fingerprint zero and are one group; of repeated
    rows one stays; texts of any length are read whole; an empty table stays empty; columns
    that clash with the operator's are set aside and come back.
    """
    ensure_checkpoint_dir(spark)
    return simhash.keep_one(docs, shingle=3, radius=2)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go.

    Null and empty texts hold none and stay, repeated rows share their fate, texts of any
    length are read whole; an empty benchmark or an empty table changes nothing; clashing
    columns are set aside and come back.
    """
    ensure_checkpoint_dir(spark)
    benchmark = load(spark, sf_dir, "benchmark")
    return guarded(docs, decontaminate.RESULT.names, lambda rows: decontaminate.decontaminate(
        rows, benchmark, n=10).where("n_hit = 0"))


def secret_redaction(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark in every text; all documents stay, ``n_chars`` follows the new text."""
    ensure_checkpoint_dir(spark)
    def clean(rows: DataFrame) -> DataFrame:
        out = secret_scan.redact(secret_scan.find_secrets(rows))
        return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in rows.columns else out

    return guarded(docs, secret_scan.ADDED, clean)


def sentencepiece_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every remaining document with its piece ids and whether they spell it again.

    Null texts have null ids, empty ones no id; texts of any length are encoded whole, with
    or without blanks; repeated rows get equal ids; an empty table stays empty; columns
    named like the new ones are replaced.
    """
    ensure_checkpoint_dir(spark)
    return sentencepiece_codec.encode_and_check(docs, sentencepiece_codec.read_model(PIECE_MODEL))


STAGES = [("language_id", language_id), ("simhash_dedup", simhash_dedup),
          ("benchmark_decontamination", benchmark_decontamination), ("secret_redaction", secret_redaction),
          ("sentencepiece_ids", sentencepiece_ids)]

ORACLE_SQL = None  # fingerprints, machines and segmentation have no SQL form; tests/llm compares with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again.

    Once a stage is written, what it read and the tables it made on the way are deleted:
    no more than two copies of the corpus are there at a time.
    """
    docs = load(spark, sf_dir, "documents")
    before: list[str] = []
    for name, stage in STAGES:
        first = len(SCRATCH_PATHS)
        out = stage(spark, docs, sf_dir)
        path = scratch_path(spark, name)
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        for old in before + [p for p in SCRATCH_PATHS[first:] if p != path]:
            delete_path(spark, old)
        before = [path]
    return docs
