"""The queries ``opN_*``: each operator on its whole table, with the digest columns of its contract."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (chat_format, decontaminate, embedding_dedup, filter_audit, langid, multi_index, oracles, secret_scan,
               sentencepiece_codec, sharding, simhash, toxicity, url_filter, vector_codes)
from .common import load

PIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"  # a public tokenizer's file, read by the driver

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def register(fn):
    QUERIES[fn.__name__] = fn
    return fn


def crc_of_id() -> Column:
    """Unsigned crc32 of the id's decimal text."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary"))


@register
def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sharding.shard(load(spark, sf_dir, "documents"), shards=8)
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return rows.select("doc_id", sharding.text_size(F.col("text")).alias("size"), F.crc32(raw).alias("text_crc32"),
                       F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@register
def op2_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(load(spark, sf_dir, "embeddings"), cosine=0.93)


BLOCK_RULES = ["net/", "example.com/de/"]
ALLOW_RULES = ["example.net/en/", "org/fr/"]


@register
def op3_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = load(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judge(pages, BLOCK_RULES, ALLOW_RULES).select("page_id", "host", "path", "rule", "verdict")


@register
def op4_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    rows = rows.unionByName(spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], rows.schema))
    members, packs = chat_format.format_conversations(rows)
    return members.join(chat_format.read_back(packs), "conversation").drop("conversation")


@register
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    held = F.coalesce(F.pmod(crc_of_id(), F.lit(5)) == 0, F.lit(False))
    labels = load(spark, sf_dir, "labels").select("doc_id", "toxic").where(~held)
    model = toxicity.train(docs.where(~held), labels)
    return toxicity.score(docs, model, keep=["doc_id"]).select("doc_id", held.alias("held_out"), "score", "predicted")


@register
def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document and whether they spell it again.

    The model's file is of the BPE kind; its scores are read as a unigram model's, so the ids
    are the best sum's and not those that the library gives.
    """
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    return sentencepiece_codec.encode_and_check(docs, sentencepiece_codec.read_model(PIECE_MODEL), keep=["doc_id"])


@register
def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    return simhash.simhash_components(docs, shingle=3, radius=2).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@register
def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    found = secret_scan.find_secrets(docs, keep=["doc_id"])
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return found.select("doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
                        F.sha2(secret_scan.spelled("base"), 256).alias("base_sha256"),
                        secret_scan.spelled("spans").alias("spans"))


@register
def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held = F.coalesce(F.pmod(crc_of_id(), F.lit(4)) == 2, F.lit(False))
    model = langid.train(docs.where(~held))
    return langid.identify(docs.select("doc_id", "text"), model, keep=["doc_id"]).select(
        "doc_id", held.alias("held_out"), "lang_pred", "score")


@register
def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.decontaminate(docs, load(spark, sf_dir, "benchmark"), n=10, keep=["doc_id"])
    return found.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
                        F.sha2(F.array_join(F.array_sort("item_ids"), ","), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


@register
def op11_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = filter_audit.filter_audit(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))
    return found.select("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost",
                        "toxic_lost", "shapley")


@register
def op12_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = vector_codes.compress(load(spark, sf_dir, "embeddings"), keep=["vec_id", "label"])
    return vector_codes.with_label_error(found).select(
        "vec_id", "code", "error", "label_error", F.lit(found.digest()).alias("codebooks_sha256"))


@register
def op13_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest rows found for every row whose id is divisible by 20."""
    index = multi_index.build(load(spark, sf_dir, "embeddings").select("vec_id", "embedding"), k=20, recall=0.95)
    if index is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    return multi_index.search(index, index.table.where("vec_id % 20 = 0"), k=20)


# The other queries have no SQL form: seeded permutations, XXH64 votes, learned models and
# Viterbi segmentation are compared with plain forms, round trips or held-out rows in tests/llm.
ORACLES |= {"op2_embeddings": oracles.embeddings(0.93), "op3_urls": oracles.urls(BLOCK_RULES, ALLOW_RULES),
            "op4_chat": oracles.chat(), "op8_secrets": oracles.secrets(200), "op10_decontaminate": oracles.decontamination(10),
            "op11_filters": oracles.filters("ABCDE"), "op12_codes": oracles.codes(4, 256, 4, 1024)}
