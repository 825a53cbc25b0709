"""Headline timings on ``documents`` at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Queries: word counting (A1), one pair-count round (A4), vocabulary training to
500 and 1000 ids (I1), training to 500 ids on a small corpus (133 kB of text, the size
of the only fixed-size timing published for this task), encoding with the 500-id
vocabulary and with one of 32,000 ids (I2), training windows over the encoded shards (W3/W4).  Every step is fully
materialised with the ``noop`` sink or a count (no driver collect) and starts from the
files, but for those that name the step before; JVM start-up and a warm-up are excluded.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from mergeloom.functions.patterns import END_OF_TEXT  # noqa: E402
from mergeloom.operators.batches import assign_shards, sequential_windows, stream_offsets  # noqa: E402
from mergeloom.operators.encode import encode  # noqa: E402
from mergeloom.operators.pairs import pair_counts  # noqa: E402
from mergeloom.operators.pretokenize import count_words, with_symbols  # noqa: E402
from mergeloom.plans.train import BPEModel, train_bpe  # noqa: E402
from mergeloom.session import get_spark  # noqa: E402
from mergeloom.sources.corpus import table  # noqa: E402

SMALL_CHARS = 133_000


def run(df):
    df.write.format("noop").mode("overwrite").save()


def prefix_vocabulary(docs, ids: int) -> BPEModel:
    """A vocabulary of production size without its training: the prefixes of frequent words, byte by byte."""
    rows = count_words(docs).orderBy(F.desc("freq"), "word").limit(ids).collect()
    seen, merges = set(), []
    for word in (r.word.encode() for r in rows):
        for i in range(1, len(word)):
            if word[:i + 1] not in seen and len(merges) < ids - 257:
                seen.add(word[:i + 1])
                merges.append((word[:i].hex().upper(), word[i:i + 1].hex().upper(), 0))
    return BPEModel([END_OF_TEXT], merges)


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = get_spark(f"local[{cpus}]", 2 * cpus, app="mergeloom-bench",
                      extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")})
    docs = table(spark, sf, "documents").select("doc_id", "text")
    run(count_words(docs.limit(100)))  # warm-up
    q: dict[str, float] = {}
    extra: dict[str, float] = {}

    t = time.time()
    words = with_symbols(count_words(docs)).persist()
    n_words = words.count()
    q["count_words"] = time.time() - t

    t = time.time()
    run(pair_counts(words))
    q["pair_counts_round"] = time.time() - t
    words.unpersist()

    small = docs.orderBy("doc_id").limit(200).agg(F.substring(F.array_join(F.collect_list("text"), "\n"), 1, SMALL_CHARS).alias("text"))
    small = small.withColumn("doc_id", F.lit(0)).persist()
    small.count()
    t = time.time()
    train_bpe(small, 500)
    q["train_bpe_500_small"] = time.time() - t

    for ids in (500, 1000):
        t = time.time()
        model = train_bpe(docs, ids)
        q[f"train_bpe_{ids}"] = time.time() - t
        extra[f"train_bpe_{ids}_rounds"] = model.rounds
        if ids == 500:
            m500 = model

    t = time.time()
    enc = encode(docs, m500, append_eot=True).select("doc_id", "ids").persist()
    n_tokens = enc.agg(F.sum(F.size("ids"))).first()[0]
    q["encode_500"] = time.time() - t
    extra["encode_tokens_per_sec"] = round(n_tokens / q["encode_500"], 1)

    m32k = prefix_vocabulary(docs, 32_000)
    t = time.time()
    run(encode(docs, m32k, append_eot=True).select("doc_id", "ids"))
    q["encode_32000"] = time.time() - t

    t = time.time()
    shards = stream_offsets(assign_shards(enc, 16).withColumn("n_tokens", F.size("ids").cast("long")))
    wins = sequential_windows(shards, 257).persist()
    n_windows = wins.count()
    q["windows_256"] = time.time() - t
    extra["windows_per_sec"] = round(n_windows / q["windows_256"], 1)

    out = {"metric": "total_sec", "value": round(sum(q.values()), 3), "unit": "sec",
           "queries": {k: round(v, 3) for k, v in q.items()}, "sf": os.path.basename(sf.rstrip("/")),
           "distinct_words": n_words, "tokens": int(n_tokens), "windows": n_windows,
           **{k: v for k, v in extra.items()}}
    print(json.dumps(out))


if __name__ == "__main__":
    main()
