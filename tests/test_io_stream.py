import os

import numpy as np
import pytest

from mergeloom.operators.encode import encode
from mergeloom.plans.train import train_bpe
from mergeloom.sources.corpus import read_corpus
from mergeloom.sources.shards import read_raw_shards, stream_digests, write_raw_shards
from mergeloom.sources.vocab_io import (load_tokenizer, read_merges, read_vocab, save_tokenizer, write_merges_text,
                                        write_vocab_json)
from mergeloom.streaming.streams import (batch_stream, count_words_stream, encode_lines_stream, encode_stream, joined_pieces,
                                         run_to_end, running_counts, stream_table)


def test_vocab_and_merges_round_trip(spark, small_docs, tmp_path):
    m = train_bpe(small_docs, 257 + 20)
    write_vocab_json(spark, m, str(tmp_path / "v"))
    write_merges_text(spark, m, str(tmp_path / "m"))
    v = {r.token_id: r.token_hex for r in read_vocab(spark, str(tmp_path / "v")).collect()}
    assert v == {i: h for i, h, _, _ in m.vocab_rows()}
    mm = [(r.left_hex, r.right_hex) for r in read_merges(spark, str(tmp_path / "m")).orderBy("rank").collect()]
    assert mm == [(l, r) for l, r, _ in m.merges]
    save_tokenizer(spark, m, str(tmp_path / "t"))
    assert load_tokenizer(spark, str(tmp_path / "t")).merges == m.merges


def test_read_corpus_separator_and_bad_bytes(spark, tmp_path):
    p = tmp_path / "c.txt"
    p.write_bytes(b"first doc\nline two<|endoftext|>sec\xffond<|endoftext|>third")
    texts = sorted(r.text for r in read_corpus(spark, str(p)).collect())
    assert texts == ["first doc\nline two", "second", "third"]


def test_raw_shards(spark, tmp_path):
    d = tmp_path / "shards"
    d.mkdir()
    np.arange(10, dtype="<u2").tofile(d / "a.data")
    (d / ".hidden.data").write_bytes(b"\x01\x00")
    (d / "b.txt").write_bytes(b"zz")
    rows = read_raw_shards(spark, str(d)).collect()
    assert len(rows) == 1 and rows[0].tokens == list(range(10))


def test_count_words_stream_adds_to_old_totals(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    schema = "doc_id long, text string"
    spark.createDataFrame([(0, "a b a")], schema).coalesce(1).write.parquet(str(src / "one"))
    out, ck = str(tmp_path / "out"), str(tmp_path / "ck")
    run_to_end(count_words_stream(stream_table(spark, str(src / "one"), schema), out, checkpoint=ck))
    assert {r.word: r.freq for r in running_counts(spark, out).collect()} == {"a": 1, " b": 1, " a": 1}
    # a new file arrives: only changed totals are appended, the read sees the sums
    spark.createDataFrame([(1, "a b")], schema).coalesce(1).write.mode("append").parquet(str(src / "one"))
    run_to_end(count_words_stream(stream_table(spark, str(src / "one"), schema), out, checkpoint=ck))
    assert {r.word: r.freq for r in running_counts(spark, out).collect()} == {"a": 2, " b": 2, " a": 1}


def test_digests_of_streams(spark, tmp_path):
    import hashlib

    from pyspark.sql import functions as F
    out, r = str(tmp_path / "raw"), np.random.default_rng(2)
    rows = [(d, d % 3, r.integers(0, 1 << 16, int(r.integers(0, 300))).tolist()) for d in range(40)] + [(40, 7, []), (41, 5, [9])]
    write_raw_shards(spark.createDataFrame(rows, "doc_id long, shard_id int, ids array<int>"), out)
    back = read_raw_shards(spark, out, split_bytes=200, row_tokens=16)
    found = stream_digests(back, F.regexp_extract("path", "shard=([0-9]+)", 1).cast("int"))
    want = {}
    for _, shard, ids in rows:
        want.setdefault(shard, []).extend(ids)
    assert {(x.shard_id, x.n_tokens, x.ids_md5) for x in found.collect()} == {
        (s, len(ids), hashlib.md5(" ".join(map(str, ids)).encode()).hexdigest()) for s, ids in want.items() if ids}
    assert "collect_list" not in found._jdf.queryExecution().toString()  # no row holds a shard's text


def test_a_table_of_several_files_is_streamed(spark, tmp_path):
    rows = [(i, f"text {i}") for i in range(6)]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(9, "another table")], "doc_id long, text string").write.parquet(str(tmp_path / "other.parquet"))
    spark.createDataFrame(rows[:2], "doc_id long, text string").coalesce(1).write.parquet(str(tmp_path / "one"))
    (name,) = [f for f in os.listdir(tmp_path / "one") if f.endswith(".parquet")]
    m = train_bpe(spark.createDataFrame(rows, "doc_id long, text string"), 257 + 3)
    for folder, glob, want in ((tmp_path, "documents.parquet", range(6)), (tmp_path / "one", name, range(2))):
        out = str(tmp_path / f"out-{len(want)}")
        run_to_end(encode_stream(stream_table(spark, str(folder), "doc_id long, text string", glob), m, out))
        assert sorted(r.doc_id for r in spark.read.schema("doc_id long, ids array<int>").parquet(out).collect()) == list(want)


def test_batch_stream_order(spark):
    df = spark.createDataFrame([(b, r, [b, r], [r]) for b in range(5) for r in range(3)],
                               "batch_id long, row_in_batch int, input_ids array<int>, target_ids array<int>")
    got = [(r.batch_id, r.row_in_batch) for r in batch_stream(df.repartition(4))]
    assert got == sorted(got) and len(got) == 15


# --- raw shards ------------------------------------------------------------------------------------

def raw_rows(spark, lists, shards=3):
    rows = [(i, i % shards, ids) for i, ids in enumerate(lists)]
    return spark.createDataFrame(rows, "doc_id long, shard_id int, ids array<int>")


def test_raw_shards_round_trip_by_byte_ranges(spark, tmp_path):
    lists = [[(i * 7 + k) % 65536 for k in range(200 * i)] for i in range(30)] + [None, []]
    out = str(tmp_path / "raw")
    write_raw_shards(raw_rows(spark, lists), out)
    back = read_raw_shards(spark, out, split_bytes=1000, row_tokens=64)
    assert back.rdd.getNumPartitions() > 30  # several tasks a file
    rows = sorted(back.collect(), key=lambda r: (r.path, r.offset))
    for s in range(3):
        want = [x for i, ids in enumerate(lists) if i % 3 == s for x in ids or []]
        own = [r for r in rows if f"shard={s:05d}" in r.path]
        assert [x for r in own for x in r.tokens] == want
    assert os.path.exists(f"{out}/_SUCCESS") and not os.path.exists(f"{out}/_temporary")
    whole = b"".join((tmp_path / "raw" / "shard=00001" / f).read_bytes() for f in sorted(os.listdir(f"{out}/shard=00001")) if f.endswith(".data"))
    assert np.frombuffer(whole, "<u2").tolist() == [x for i, ids in enumerate(lists) if i % 3 == 1 for x in ids or []]


def test_raw_shards_replace_an_older_table(spark, tmp_path):
    out = str(tmp_path / "raw")
    write_raw_shards(raw_rows(spark, [[1], [2], [3], [4]], 4), out)
    write_raw_shards(raw_rows(spark, [[9, 9]], 4), out)
    assert [(r.offset, r.tokens) for r in read_raw_shards(spark, out).collect()] == [(0, [9, 9])]


def test_raw_shards_reject_large_ids_and_keep_nothing(spark, tmp_path):
    out = str(tmp_path / "raw")
    for bad in (65536, -1):
        with pytest.raises(Exception, match="16 bits"):
            write_raw_shards(raw_rows(spark, [[1, 2], [bad]]), out)
    assert not os.path.exists(f"{out}/_SUCCESS")
    (tmp_path / "odd").mkdir()
    (tmp_path / "odd" / "x.data").write_bytes(b"abc")
    with pytest.raises(Exception, match="16-bit"):
        read_raw_shards(spark, str(tmp_path / "odd")).collect()
    (tmp_path / "none").mkdir()
    assert read_raw_shards(spark, str(tmp_path / "none")).count() == 0


# --- lines of texts --------------------------------------------------------------------------------

TEXTS = ["", "\n", "one line", "two\nlines", "a  \n\n  b\n", "don't\n'll we\n're", "x\n \n\t\n y\r\n z", "é \nü  x\n", "<|endoftext|>\n\na<|endoftext|> b\n<|endoftext|>",
         "\n\n\n\nword", "end   ", "l\n" * 40, "no 1 23\n4 5'\ns it"]


def test_settled_parts_are_pretokenized_like_the_whole(spark):
    from mergeloom.functions.patterns import END_OF_TEXT
    from mergeloom.operators.pretokenize import pretoken_array
    from mergeloom.streaming.streams import settled
    rows = []
    for i, t in enumerate(TEXTS + ["wide <| a b |> mark", "x <| a b"]):
        for n in range(len(t) + 1):
            cut = settled(t[:n], [END_OF_TEXT, "<| a b |>"])
            rows.append((i, n, t, t[:cut], t[cut:]))
    got = spark.createDataFrame(rows, "i int, n int, t string, x string, y string").select(
        "i", "n", *[pretoken_array(c, [END_OF_TEXT, "<| a b |>"]).alias(c) for c in ("t", "x", "y")]).collect()
    assert all(r.x + r.y == r.t for r in got)


def test_lines_encode_like_whole_texts(spark, small_docs, tmp_path):
    m = train_bpe(small_docs, 257 + 30)
    rows = [(i, n, line, n == t.count("\n")) for i, t in enumerate(TEXTS) for n, line in enumerate(t.split("\n"))]
    rows += [(0, 0, "again", True), (3, 0, "two", False), (99, 1, "never begins", True)]
    import random
    random.Random(4).shuffle(rows)
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    schema = "doc_id long, line_no long, line string, is_last boolean"
    first = [r for r in rows if not (r[0] == 0 and r[2] == "again") and not (r[0] == 3 and r[1] == 0)]
    for at in range(0, len(first), 17):  # out of order, over several micro-batches
        spark.createDataFrame(first[at:at + 17], schema).coalesce(1).write.mode("append").parquet(src)
    spark.createDataFrame([(3, 0, "two", False)], schema).coalesce(1).write.mode("append").parquet(src)
    stream = stream_table(spark, src, schema, max_files=1)
    run_to_end(encode_lines_stream(stream, m, out, checkpoint=str(tmp_path / "ck")))
    got = {r.doc_id: r.ids for r in joined_pieces(spark.read.parquet(out)).collect()}
    whole = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    assert got == {r.doc_id: r.ids for r in encode(whole, m).collect()}


def test_states_of_texts_are_a_table_that_a_later_run_goes_on_from(spark, small_docs, tmp_path):
    m = train_bpe(small_docs, 257 + 30)
    src, out, ck = (str(tmp_path / x) for x in ("in", "out", "ck"))
    schema = "doc_id string, line_no long, line string, is_last boolean"
    texts = {f"t{i}": "\n".join(f"word{i} {n} x" for n in range(9)) for i in range(40)} | {None: "of no\nkey"}
    rows = [(k, n, line, n == t.count("\n")) for k, t in texts.items() for n, line in enumerate(t.split("\n"))]
    for part in (0, 1, 2):  # each line in one of three runs, the last lines in the first
        some = [r for i, r in enumerate(rows) if (0 if r[3] else i % 3) == part] + [(None, None, "no number", None)]
        spark.createDataFrame(some, schema).coalesce(1).write.mode("append").parquet(src)
        query = encode_lines_stream(stream_table(spark, src, schema), m, out, checkpoint=ck)
        run_to_end(query)
        assert not query.lastProgress["stateOperators"]  # no group of a text is called in Python, none is held in memory
    assert sorted(d for d in os.listdir(f"{ck}/texts") if not d.startswith(".")) == ["epoch=1", "epoch=2"]
    assert spark.read.schema("t string").parquet(f"{ck}/texts/epoch=2/state=true").count() == 0
    got = {r.doc_id: r.ids for r in joined_pieces(spark.read.parquet(out)).collect()}
    whole = spark.createDataFrame(list(texts.items()), "doc_id string, text string")
    assert got == {r.doc_id: r.ids for r in encode(whole, m).collect()}
