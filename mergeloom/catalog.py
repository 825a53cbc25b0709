"""Registered queries: one Spark DataFrame per operator, each with its DuckDB oracle.

Every query reads the test tables (``documents``, ``conversations``,
``embeddings``) whole.  Array results are rendered as space-joined strings and
floats are rounded, so both engines produce comparable scalar columns.

The parameters below (merge count, shard count, window sizes, seeds) are
fixed values of the checks, not of the library.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.patterns import END_OF_TEXT, duckdb_pretokens_expr, sql_literal
from .functions.symbols import duckdb_syms_array, duckdb_to_syms
from .operators import encode as E
from .operators import pairs as PR
from .operators import pretokenize as PT
from .plans.train import BPEModel, train_bpe
from .sources.corpus import table

SPECIALS = [END_OF_TEXT]
K = 10                # merges of the checked tokenizer (vocabulary 257 + K)
SEED = 42

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


# --- shared Spark inputs -------------------------------------------------------------

def docs(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", "text", "lang")


_MODELS: dict[tuple, BPEModel] = {}


def _version(spark: SparkSession, path: str) -> tuple:
    """Names, sizes and times of a table's files: a kept model is used for the same files only."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = p.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(p)
    return tuple(sorted((f.getPath().toString(), f.getLen(), f.getModificationTime()) for f in files))


def model_k(spark: SparkSession, sf: str, k: int = K, specials: tuple[str, ...] = tuple(SPECIALS)) -> BPEModel:
    """The checked tokenizer: ``k`` merges trained on all documents (kept per process)."""
    key = (_version(spark, f"{sf.rstrip('/')}/documents.parquet"), k, specials)
    if key not in _MODELS:
        _MODELS[key] = train_bpe(docs(spark, sf), 256 + len(specials) + k, list(specials))
    return _MODELS[key]


def words(spark: SparkSession, sf: str) -> DataFrame:
    return PT.with_symbols(PT.count_words(docs(spark, sf)))


# --- shared SQL fragments ------------------------------------------------------------

def pre(text: str = "text", specials=None) -> str:
    return duckdb_pretokens_expr(text, specials)


def occ_sql(text: str = "text", specials=None, src: str = "documents") -> str:
    return (f"SELECT doc_id, CAST(generate_subscripts(t, 1) - 1 AS INTEGER) AS pos, unnest(t) AS pretoken "
            f"FROM (SELECT doc_id, {pre(text, specials)} AS t FROM {src})")


WORDS_SQL = f"SELECT pretoken AS word, CAST(count(*) AS BIGINT) AS freq FROM ({occ_sql()}) GROUP BY pretoken"
SYMS = duckdb_to_syms


def pair_rows_sql(src: str) -> str:
    return (f"SELECT freq, a[i] AS l, a[i + 1] AS r FROM (SELECT freq, {duckdb_syms_array('syms')} AS a FROM {src}) t, "
            f"unnest(generate_series(1, len(a) - 1)) AS g(i)")


def pairs_sql(src: str) -> str:
    return f"SELECT l, r, CAST(sum(freq) AS BIGINT) AS n FROM ({pair_rows_sql(src)}) GROUP BY l, r"


def with_ctes(ctes: list[tuple[str, str]], final: str) -> str:
    return "WITH " + ",\n".join(f"{n} AS MATERIALIZED ({q})" for n, q in ctes) + "\n" + final


def train_ctes(k: int = K, words_sql: str = WORDS_SQL) -> list[tuple[str, str]]:
    """Unrolled one-merge-per-step training: w0 → b0 → w1 → ... → merges."""
    ctes = [("words", words_sql), ("w0", f"SELECT word, freq, {SYMS('word')} AS syms FROM words")]
    for i in range(k):
        ctes.append((f"b{i}", f"SELECT l, r, n FROM ({pairs_sql(f'w{i}')}) ORDER BY n DESC, l DESC, r DESC LIMIT 1"))
        ctes.append((f"w{i + 1}", f"SELECT w.word, w.freq, replace(w.syms, '<' || b.l || '><' || b.r || '>', "
                                  f"'<' || b.l || b.r || '>') AS syms FROM w{i} w CROSS JOIN b{i} b"))
    ctes.append(("merges", " UNION ALL ".join(f"SELECT {i} AS rank, l, r, n FROM b{i}" for i in range(k))))
    return ctes


def vocab_ctes(n_specials_hex: list[str] | None = None) -> list[tuple[str, str]]:
    sp = n_specials_hex if n_specials_hex is not None else [END_OF_TEXT.encode().hex().upper()]
    special_rows = " ".join(f"UNION ALL SELECT {256 + i}, '{h}', CAST(0 AS BIGINT), true" for i, h in enumerate(sp))
    base = 256 + len(sp)
    return [
        ("bytefreq", f"SELECT h, CAST(sum(freq) AS BIGINT) AS f FROM (SELECT freq, unnest({duckdb_syms_array('syms')}) AS h FROM w0) GROUP BY h"),
        ("vocab", f"SELECT CAST(i AS INTEGER) AS token_id, printf('%02X', i) AS token_hex, CAST(coalesce(f, 0) AS BIGINT) AS token_freq, "
                  f"false AS is_special FROM range(256) t(i) LEFT JOIN bytefreq ON bytefreq.h = printf('%02X', i) "
                  f"{special_rows} "
                  f"UNION ALL SELECT CAST({base} + rank AS INTEGER), l || r, CAST(n AS BIGINT), false FROM merges"),
    ]


def encode_ctes(k: int = K) -> list[tuple[str, str]]:
    """Rank encoding of every document with the unrolled K-merge vocabulary."""
    nested = SYMS("word")
    for i in range(k):
        nested = f"replace({nested}, (SELECT pat FROM mp WHERE rank = {i}), (SELECT rep FROM mp WHERE rank = {i}))"
    return [
        ("occ", occ_sql()),
        ("mp", "SELECT rank, '<' || l || '><' || r || '>' AS pat, '<' || l || r || '>' AS rep FROM merges"),
        ("enc", f"SELECT word, {nested} AS s FROM (SELECT DISTINCT pretoken AS word FROM occ)"),
        ("vfirst", "SELECT token_hex, min(token_id) AS token_id FROM vocab GROUP BY token_hex"),
        ("wid", f"SELECT e.word, e.k, v.token_id FROM (SELECT word, generate_subscripts(a, 1) AS k, unnest(a) AS h "
                f"FROM (SELECT word, {duckdb_syms_array('s')} AS a FROM enc)) e JOIN vfirst v ON v.token_hex = e.h"),
        ("tok", "SELECT o.doc_id, o.pos, w.k, w.token_id FROM occ o JOIN wid w ON w.word = o.pretoken"),
        ("doc_ids", "SELECT doc_id, CAST(count(*) AS BIGINT) AS n_tokens, "
                    "string_agg(CAST(token_id AS VARCHAR), ' ' ORDER BY pos, k) AS ids_text FROM tok GROUP BY doc_id"),
    ]


ENCODE_FINAL = ("SELECT d.doc_id, CAST(coalesce(n_tokens, 0) AS BIGINT) AS n_tokens, coalesce(ids_text, '') AS ids_text "
                "FROM documents d LEFT JOIN doc_ids USING (doc_id)")
FULL_ENCODE = train_ctes() + vocab_ctes() + encode_ctes()


def encoded_view(df: DataFrame) -> DataFrame:
    return df.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.array_join("ids", " ").alias("ids_text"))


# --- pre-tokens and words (P1-P4, A1-A3, J7) -----------------------------------------

@register("count_words", WORDS_SQL)
def q_count_words(spark, sf):
    return PT.count_words(docs(spark, sf))


@register("top_words", WORDS_SQL + " ORDER BY freq DESC, word LIMIT 100")
def q_top_words(spark, sf):
    return PT.count_words(docs(spark, sf)).orderBy(F.col("freq").desc(), F.col("word")).limit(100)


@register("pretokenize", occ_sql())
def q_pretokenize(spark, sf):
    return PT.pretokenize(docs(spark, sf))


SPLIT_SPECIALS = [END_OF_TEXT, END_OF_TEXT + END_OF_TEXT]
SPLIT_SUFFIX = " " + END_OF_TEXT * 3


@register("split_specials",
          f"SELECT doc_id, pos, pretoken, pretoken IN ({', '.join(sql_literal(s) for s in SPLIT_SPECIALS)}) AS is_special "
          f"FROM ({occ_sql('text || ' + sql_literal(SPLIT_SUFFIX), SPLIT_SPECIALS)})")
def q_split_specials(spark, sf):
    d = docs(spark, sf).withColumn("text", F.concat("text", F.lit(SPLIT_SUFFIX)))
    return PT.split_specials(d, SPLIT_SPECIALS)


@register("drop_separators",
          f"SELECT pretoken AS word, CAST(count(*) AS BIGINT) AS freq FROM ({occ_sql('text || ' + sql_literal(END_OF_TEXT), SPECIALS)}) "
          f"WHERE pretoken <> {sql_literal(END_OF_TEXT)} GROUP BY pretoken")
def q_drop_separators(spark, sf):
    d = docs(spark, sf).withColumn("text", F.concat("text", F.lit(END_OF_TEXT)))
    return PT.drop_separators(PT.count_words(d, specials=SPECIALS, drop_specials=False), SPECIALS)


MISSING_CANDIDATES = [END_OF_TEXT, "<|pad|>"]


@register("missing_separators",
          f"SELECT s AS word FROM (VALUES {', '.join('(' + sql_literal(s) + ')' for s in MISSING_CANDIDATES)}) v(s) "
          f"WHERE s NOT IN (SELECT pretoken FROM ({occ_sql('text || ' + sql_literal(END_OF_TEXT), MISSING_CANDIDATES)}))")
def q_missing_separators(spark, sf):
    d = docs(spark, sf).withColumn("text", F.concat("text", F.lit(END_OF_TEXT)))
    counted = PT.count_words(d, specials=MISSING_CANDIDATES, drop_specials=False)
    return PT.missing_separators(spark, counted, MISSING_CANDIDATES)


@register("to_byte_symbols", f"SELECT word, freq, {SYMS('word')} AS syms FROM ({WORDS_SQL})")
def q_to_byte_symbols(spark, sf):
    return words(spark, sf)


@register("byte_frequencies", with_ctes(
    [("words", WORDS_SQL), ("w0", f"SELECT word, freq, {SYMS('word')} AS syms FROM words")] + vocab_ctes()[:1],
    "SELECT CAST(t.i AS INTEGER) AS byte, f AS freq FROM bytefreq JOIN range(256) t(i) ON printf('%02X', t.i) = bytefreq.h"))
def q_byte_frequencies(spark, sf):
    return PT.byte_frequencies(words(spark, sf))


@register("base_vocab", with_ctes(
    [("words", WORDS_SQL), ("w0", f"SELECT word, freq, {SYMS('word')} AS syms FROM words")] + vocab_ctes()[:1],
    f"SELECT CAST(i AS INTEGER) AS token_id, printf('%02X', i) AS token_hex, CAST(coalesce(f, 0) AS BIGINT) AS token_freq, false AS is_special "
    f"FROM range(256) t(i) LEFT JOIN bytefreq ON bytefreq.h = printf('%02X', i) "
    f"UNION ALL SELECT 256, '{END_OF_TEXT.encode().hex().upper()}', CAST(0 AS BIGINT), true"))
def q_base_vocab(spark, sf):
    from .operators.vocab import base_vocab
    return base_vocab(spark, SPECIALS, PT.byte_frequencies(words(spark, sf)))


@register("merge_counts",
          f"SELECT word, CAST(sum(freq) AS BIGINT) AS freq FROM ({WORDS_SQL} UNION ALL "
          f"SELECT pretoken AS word, CAST(count(*) AS BIGINT) AS freq FROM ({occ_sql(src='(SELECT conv_id * 1000 + turn AS doc_id, text FROM conversations)')}) GROUP BY pretoken) GROUP BY word")
def q_merge_counts(spark, sf):
    conv = table(spark, sf, "conversations").select("text")
    return PT.merge_counts(PT.count_words(docs(spark, sf)), PT.count_words(conv))


# --- pairs (A4-A7, T4, J5, W1) -------------------------------------------------------

W0 = [("words", WORDS_SQL), ("w0", f"SELECT word, freq, {SYMS('word')} AS syms FROM words")]
B0 = W0 + [("p0", pairs_sql("w0")), ("b0", "SELECT l, r, n FROM p0 ORDER BY n DESC, l DESC, r DESC LIMIT 1")]


@register("pair_counts", with_ctes(W0, pairs_sql("w0")))
def q_pair_counts(spark, sf):
    return PR.pair_counts(words(spark, sf))


@register("pair_postings", with_ctes(W0, f"SELECT DISTINCT l, r, word, freq FROM (SELECT word, freq, a[i] AS l, a[i + 1] AS r FROM "
                                         f"(SELECT word, freq, {duckdb_syms_array('syms')} AS a FROM w0) t, unnest(generate_series(1, len(a) - 1)) AS g(i))"))
def q_pair_postings(spark, sf):
    return PR.pair_postings(words(spark, sf))


@register("best_pair", with_ctes(B0, "SELECT l, r, n FROM b0"))
def q_best_pair(spark, sf):
    return PR.best_pair(PR.pair_counts(words(spark, sf)))


@register("top_pairs", with_ctes(W0, f"SELECT l, r, n FROM ({pairs_sql('w0')}) ORDER BY n DESC, l DESC, r DESC LIMIT 50"))
def q_top_pairs(spark, sf):
    return PR.top_pairs(PR.pair_counts(words(spark, sf)), 50)


@register("adjacent_pairs", with_ctes(W0, f"SELECT word, pos, sym, lead(sym) OVER (PARTITION BY word ORDER BY pos) AS next_sym FROM "
                                          f"(SELECT word, CAST(generate_subscripts(a, 1) - 1 AS INTEGER) AS pos, unnest(a) AS sym FROM "
                                          f"(SELECT word, {duckdb_syms_array('syms')} AS a FROM w0))"))
def q_adjacent_pairs(spark, sf):
    return PR.adjacent_pairs(words(spark, sf))


def _best(spark, sf):
    b = PR.best_pair(PR.pair_counts(words(spark, sf))).first()
    return b.l, b.r


@register("words_with_pair", with_ctes(B0, "SELECT word, freq, syms FROM w0 "
                                           "WHERE contains(syms, (SELECT '<' || l || '><' || r || '>' FROM b0))"))
def q_words_with_pair(spark, sf):
    l, r = _best(spark, sf)
    return PR.words_with_pair(words(spark, sf), l, r).select("word", "freq", "syms")


@register("update_pair_counts", with_ctes(B0 + [("w1", "SELECT w.word, w.freq, replace(w.syms, '<' || b.l || '><' || b.r || '>', "
                                                       "'<' || b.l || b.r || '>') AS syms FROM w0 w CROSS JOIN b0 b")],
                                          pairs_sql("w1")))
def q_update_pair_counts(spark, sf):
    w = words(spark, sf)
    pc = PR.pair_counts(w)
    l, r = _best(spark, sf)
    return PR.update_pair_counts(pc, w, [(l, r)])


# --- training (I1, I4, W2) and vocabularies (U1, U2, T5, P6, J3, J4) --------------

MERGES_FINAL = ("SELECT CAST(rank AS INTEGER) AS rank, l AS left_hex, r AS right_hex, CAST(257 + rank AS INTEGER) AS merged_id, "
                "CAST(n AS BIGINT) AS pair_count FROM merges")


def merges_view(m: BPEModel, spark) -> DataFrame:
    return m.merges_df(spark).select("rank", "left_hex", "right_hex", "merged_id", "pair_count")


@register("train_bpe_merges", with_ctes(train_ctes(), MERGES_FINAL))
def q_train_bpe_merges(spark, sf):
    return merges_view(model_k(spark, sf), spark)


K_DEEP = 40  # merges of the second training check: several batches and cuts


@register("train_bpe_deep", with_ctes(train_ctes(K_DEEP), MERGES_FINAL))
def q_train_bpe_deep(spark, sf):
    from .plans.train import TrainOptions
    m = train_bpe(docs(spark, sf), 256 + len(SPECIALS) + K_DEEP, SPECIALS, options=TrainOptions(checkpoint_every=3))
    return merges_view(m, spark)


@register("train_bpe_vocab", with_ctes(train_ctes() + vocab_ctes(), "SELECT token_id, token_hex, token_freq, is_special FROM vocab"))
def q_train_bpe_vocab(spark, sf):
    return model_k(spark, sf).vocab_df(spark).drop("token_bytes")


K_LARGE = 2000 - 256 - len(SPECIALS)  # merges of a vocabulary of 2,000 ids, with the trainer's default options


@register("train_bpe_2000")
def q_train_bpe_2000(spark, sf):
    """1,743 merges: too many steps to write out in SQL; the tests compare with a plain counter."""
    return merges_view(model_k(spark, sf, K_LARGE), spark)


@register("encode_2000")
def q_encode_2000(spark, sf):
    """Every document in ids of the 2,000-id vocabulary, and whether they decode to its text."""
    m = model_k(spark, sf, K_LARGE)
    enc = E.encode(docs(spark, sf), m)
    return enc.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.array_join("ids", " ").alias("ids_text"),
                      (E.decode_ids("ids", m) == F.col("text")).alias("round_trip"))


# --- encoding (I2, I3, J6, P7-P10, A8, A11, J3, J4) ------------------------------------

def encoded(spark, sf, append_eot: bool = False) -> DataFrame:
    return E.encode(docs(spark, sf), model_k(spark, sf), append_eot=append_eot)


@register("encode", with_ctes(FULL_ENCODE, ENCODE_FINAL))
def q_encode(spark, sf):
    return encoded_view(encoded(spark, sf))


@register("dictionary_encode", with_ctes(FULL_ENCODE, ENCODE_FINAL))
def q_dictionary_encode(spark, sf):
    return encoded_view(E.dictionary_encode(docs(spark, sf), model_k(spark, sf)))


@register("encode_words", with_ctes(FULL_ENCODE,
          "SELECT d.doc_id, coalesce(word_text, '') AS word_text FROM documents d LEFT JOIN "
          "(SELECT doc_id, string_agg(w, '|' ORDER BY pos) AS word_text FROM (SELECT doc_id, pos, string_agg(CAST(token_id AS VARCHAR), ' ' ORDER BY k) AS w "
          "FROM tok GROUP BY doc_id, pos) GROUP BY doc_id) USING (doc_id)"))
def q_encode_words(spark, sf):
    enc = E.encode_words(docs(spark, sf), model_k(spark, sf))
    return enc.select("doc_id", F.array_join(F.transform("word_ids", lambda w: F.array_join(w, " ")), "|").alias("word_text"))


# One sweep folds a word's pieces from the left: a piece joins the one before it if
# both together are a token.  Sweeps recur until the number of pieces stays the same.
GREEDY_SWEEP = ("list_reduce(list_transform(parts, lambda x: [x]), lambda done, x: CASE WHEN list_contains(known, done[-1] || x[1]) "
                "THEN list_concat(done[1:len(done) - 1], [done[-1] || x[1]]) ELSE list_concat(done, x) END)")
GREEDY_CTES = train_ctes() + vocab_ctes() + [
    ("occ", occ_sql()),
    ("vfirst", "SELECT token_hex, min(token_id) AS token_id FROM vocab GROUP BY token_hex"),
    ("vlist", "SELECT list(token_hex) AS known FROM vfirst WHERE length(token_hex) > 2"),
    ("start", "SELECT word, CASE WHEN list_contains(known, hex(encode(word))) THEN [hex(encode(word))] "
              f"ELSE {duckdb_syms_array('syms')} END AS parts FROM w0, vlist")]
GREEDY_ENDS = [
    ("ends", "SELECT word, arg_max(parts, sweep) AS parts FROM sweeps GROUP BY word"),
    ("wid", "SELECT e.word, e.k, v.token_id FROM (SELECT word, generate_subscripts(parts, 1) AS k, unnest(parts) AS h FROM ends) e "
            "JOIN vfirst v ON v.token_hex = e.h"),
    ("tok", "SELECT o.doc_id, o.pos, w.k, w.token_id FROM occ o JOIN wid w ON w.word = o.pretoken"),
    ("doc_ids", "SELECT doc_id, CAST(count(*) AS BIGINT) AS n_tokens, string_agg(CAST(token_id AS VARCHAR), ' ' ORDER BY pos, k) AS ids_text "
                "FROM tok GROUP BY doc_id")]
GREEDY_SQL = ("WITH RECURSIVE " + ",\n".join(f"{n} AS MATERIALIZED ({q})" for n, q in GREEDY_CTES)
              + f""",\nsweeps AS (SELECT word, parts, 0 AS sweep, -1 AS before FROM start UNION ALL
SELECT word, next AS parts, sweep + 1, len(parts) FROM (SELECT word, parts, sweep, {GREEDY_SWEEP} AS next FROM sweeps, vlist WHERE len(parts) <> before AND len(parts) > 1)),\n"""
              + ",\n".join(f"{n} AS MATERIALIZED ({q})" for n, q in GREEDY_ENDS) + "\n" + ENCODE_FINAL)


@register("encode_greedy", GREEDY_SQL)
def q_encode_greedy(spark, sf):
    return encoded_view(E.encode(docs(spark, sf), model_k(spark, sf), mode="greedy"))


@register("decode", "SELECT doc_id, text FROM documents")
def q_decode(spark, sf):
    m = model_k(spark, sf)
    return encoded(spark, sf).select("doc_id", E.decode_ids("ids", m).alias("text"))


@register("token_display", with_ctes(FULL_ENCODE,
          "SELECT t.token_id, v.token_hex, v.token_freq, CAST(count(*) AS BIGINT) AS n, try(decode(unhex(v.token_hex))) AS token_text "
          "FROM tok t JOIN vocab v USING (token_id) GROUP BY t.token_id, v.token_hex, v.token_freq"))
def q_token_display(spark, sf):
    m = model_k(spark, sf)
    td = E.token_display(encoded(spark, sf), m)
    vocab = m.vocab_df(spark).select("token_id", "token_hex")
    return (td.groupBy("token_id", "is_valid", "token_text", "token_freq").agg(F.count(F.lit(1)).alias("n"))
            .join(vocab, "token_id")
            .select("token_id", "token_hex", "token_freq", "n", F.when(F.col("is_valid"), F.col("token_text")).alias("token_text")))


@register("token_stats", with_ctes(FULL_ENCODE,
          "SELECT d.lang, CAST(sum(strlen(d.text)) AS BIGINT) AS n_bytes, CAST(sum(x.n_tokens) AS BIGINT) AS n_tokens, "
          "round(sum(strlen(d.text)) / sum(x.n_tokens), 9) AS bytes_per_token FROM documents d JOIN doc_ids x USING (doc_id) GROUP BY d.lang"))
def q_token_stats(spark, sf):
    return E.token_stats(encoded(spark, sf), by=["lang"])


@register("num_tokens", with_ctes(FULL_ENCODE, "SELECT CAST(count(*) AS BIGINT) AS n_tokens, "
                                               "CAST(count(DISTINCT token_id) AS BIGINT) AS n_distinct_ids FROM tok"))
def q_num_tokens(spark, sf):
    return E.num_tokens(encoded(spark, sf))


@register("check_id_range", with_ctes(FULL_ENCODE, "SELECT CAST(count(*) FILTER (WHERE token_id < 0 OR token_id > 65535) AS BIGINT) "
                                                   "AS out_of_range, max(token_id) AS max_id FROM tok"))
def q_check_id_range(spark, sf):
    return E.check_id_range(encoded(spark, sf))


VFIRST = [("vfirst", "SELECT token_hex, min(token_id) AS token_id FROM vocab GROUP BY token_hex")]


@register("vocab_membership", with_ctes(train_ctes() + vocab_ctes() + VFIRST,
          "SELECT w.word, w.freq, v.token_id FROM words w LEFT JOIN vfirst v ON v.token_hex = hex(encode(w.word))"))
def q_vocab_membership(spark, sf):
    m = model_k(spark, sf)
    return E.vocab_membership(PT.count_words(docs(spark, sf)), m.vocab_df(spark)).select("word", "freq", "token_id")


@register("merge_lookup", with_ctes(train_ctes(),
          f"SELECT p.l, p.r, p.n, CAST(m.rank AS INTEGER) AS rank, CAST(257 + m.rank AS INTEGER) AS merged_id "
          f"FROM ({pairs_sql('w0')}) p LEFT JOIN merges m ON m.l = p.l AND m.r = p.r"))
def q_merge_lookup(spark, sf):
    m = model_k(spark, sf)
    return E.merge_lookup(PR.pair_counts(words(spark, sf)), m.merges_df(spark)).select("l", "r", "n", "rank", "merged_id")


# --- vocabulary tables and artifacts (U1, U2, T5, P6, I/O, I4) ------------------------

UNION_SPECIALS = [END_OF_TEXT, "!", "<|pad|>"]


@register("vocab_union", with_ctes(train_ctes(),
          "SELECT CAST(i AS INTEGER) AS token_id, printf('%02X', i) AS token_hex, false AS is_special FROM range(256) t(i) "
          f"UNION ALL SELECT 256, '{END_OF_TEXT.encode().hex().upper()}', true "
          f"UNION ALL SELECT 257, '{'<|pad|>'.encode().hex().upper()}', true "
          "UNION ALL SELECT CAST(258 + rank AS INTEGER), l || r, false FROM merges"))
def q_vocab_union(spark, sf):
    from .operators.vocab import base_vocab, vocab_union
    m = model_k(spark, sf)
    base = base_vocab(spark, UNION_SPECIALS)
    n_sp = len(BPEModel(UNION_SPECIALS).special_ids())
    merged = m.merges_df(spark).select((F.col("rank") + 256 + n_sp).cast("int").alias("token_id"),
                                       F.concat("left_hex", "right_hex").alias("token_hex"),
                                       F.lit(0).cast("long").alias("token_freq"), F.lit(False).alias("is_special"))
    return vocab_union(base, merged).select("token_id", "token_hex", "is_special")


@register("vocab_diff", with_ctes(train_ctes(),
          f"SELECT CAST(257 + rank AS INTEGER) AS token_id, l || r AS token_hex, 'only_a' AS side FROM merges WHERE rank >= {K - 2}"))
def q_vocab_diff(spark, sf):
    from .operators.vocab import vocab_diff
    m = model_k(spark, sf)
    shorter = BPEModel(m.specials, m.merges[:K - 2], m.byte_freq)
    return vocab_diff(m.vocab_df(spark), shorter.vocab_df(spark))


DISPLAY_CTE = [("disp", "SELECT b, CASE WHEN vis THEN chr(b) ELSE chr(CAST(256 + row_number() OVER (PARTITION BY vis ORDER BY b) - 1 AS INTEGER)) END AS c "
                        "FROM (SELECT CAST(i AS INTEGER) AS b, (i BETWEEN 33 AND 126) OR (i BETWEEN 161 AND 172) OR (i BETWEEN 174 AND 255) AS vis FROM range(256) t(i))")]


@register("vocab_listing", with_ctes(train_ctes() + vocab_ctes() + DISPLAY_CTE,
          "SELECT v.token_id, string_agg(d.c, '' ORDER BY x.k) AS token_display FROM vocab v, "
          "(SELECT token_hex, generate_subscripts(hs, 1) AS k, unnest(hs) AS h FROM (SELECT token_hex, regexp_extract_all(token_hex, '..') AS hs FROM vocab)) x, disp d "
          "WHERE x.token_hex = v.token_hex AND printf('%02X', d.b) = x.h GROUP BY v.token_id"))
def q_vocab_listing(spark, sf):
    from .operators.vocab import byte_display, vocab_listing
    return vocab_listing(model_k(spark, sf).vocab_df(spark)).select("token_id", byte_display("token_hex").alias("token_display"))


@register("read_vocab", with_ctes(train_ctes() + vocab_ctes(), "SELECT token_id, token_hex FROM vocab"))
def q_read_vocab(spark, sf):
    from .session import scratch_path
    from .sources.vocab_io import read_vocab, write_vocab_json
    path = scratch_path(spark, "vocab-json")
    write_vocab_json(spark, model_k(spark, sf), path)
    return read_vocab(spark, path)


@register("read_merges", with_ctes(train_ctes(), "SELECT CAST(rank AS INTEGER) AS rank, l AS left_hex, r AS right_hex FROM merges"))
def q_read_merges(spark, sf):
    from .session import scratch_path
    from .sources.vocab_io import read_merges, write_merges_text
    path = scratch_path(spark, "merges-txt")
    write_merges_text(spark, model_k(spark, sf), path)
    return read_merges(spark, path)


@register("save_load_tokenizer", with_ctes(train_ctes(), MERGES_FINAL))
def q_save_load_tokenizer(spark, sf):
    from .session import scratch_path
    from .sources.vocab_io import load_tokenizer, save_tokenizer
    path = scratch_path(spark, "tokenizer")
    save_tokenizer(spark, model_k(spark, sf), path)
    return merges_view(load_tokenizer(spark, path), spark)


@register("resume_train_bpe", with_ctes(train_ctes(), MERGES_FINAL))
def q_resume_train_bpe(spark, sf):
    from .plans.train import TrainOptions, resume_train_bpe
    from .session import scratch_path
    state = scratch_path(spark, "bpe-state")
    train_bpe(docs(spark, sf), 257 + K // 2, SPECIALS, options=TrainOptions(state_dir=state, save_every=2))
    return merges_view(resume_train_bpe(spark, state, 257 + K), spark)


@register("read_corpus", "SELECT text FROM documents")
def q_read_corpus(spark, sf):
    from .session import scratch_path
    from .sources.corpus import read_corpus, write_corpus
    path = scratch_path(spark, "corpus-txt")
    write_corpus(docs(spark, sf), path)
    return read_corpus(spark, path).select("text")


@register("cache_word_counts", WORDS_SQL)
def q_cache_word_counts(spark, sf):
    from .session import scratch_path
    from .sources.corpus import cache_word_counts
    path = scratch_path(spark, "word-counts")
    cache_word_counts(spark, path, lambda: PT.count_words(docs(spark, sf)))
    return cache_word_counts(spark, path, lambda: None)  # second call reads the stored table


# --- shards, windows, batches (I5, W3-W6, P11-P14, U3, U4) -----------------------------

N_SHARDS = 8
WINDOW = 65           # sequence length 64 + 1
RAND_LEN = 32
BATCH = 8
DEVICES = 2

STREAM_CTES = FULL_ENCODE + [
    ("stream", f"SELECT doc_id, doc_id % {N_SHARDS} AS shard_id, row_number() OVER (PARTITION BY doc_id ORDER BY pos, k) - 1 AS j, token_id FROM tok "
               f"UNION ALL SELECT doc_id, doc_id % {N_SHARDS}, n_tokens, 256 FROM doc_ids"),
    ("offs", f"SELECT doc_id, coalesce(sum(n_tokens + 1) OVER (PARTITION BY doc_id % {N_SHARDS} ORDER BY doc_id "
             f"ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS off FROM doc_ids"),
    ("gpos", "SELECT s.shard_id, o.off + s.j AS gp, s.token_id FROM stream s JOIN offs o USING (doc_id)"),
    ("wins", f"SELECT shard_id, window_idx, n_real, list_concat(l, list_transform(range({WINDOW} - n_real), lambda x: 0)) AS p FROM "
             f"(SELECT CAST(shard_id AS INTEGER) AS shard_id, CAST(gp // {WINDOW} AS BIGINT) AS window_idx, CAST(count(*) AS INTEGER) AS n_real, "
             f"list(token_id ORDER BY gp) AS l FROM gpos GROUP BY ALL)"),
    ("bat", f"SELECT CAST(rn // {BATCH} AS BIGINT) AS batch_id, CAST(rn % {BATCH} AS INTEGER) AS row_in_batch, shard_id, window_idx, p FROM "
            f"(SELECT shard_id, window_idx, p, row_number() OVER (ORDER BY ('0x' || substr(md5('{SEED}|' || shard_id || '|' || window_idx), 1, 15))::BIGINT, "
            f"shard_id, window_idx) - 1 AS rn FROM wins)"),
]


def shards_table(spark, sf) -> DataFrame:
    """Encode with end-of-text, shard, write the shard table, read it back, add offsets."""
    from .plans.prepare import prepare_dataset
    from .session import scratch_path
    return prepare_dataset(docs(spark, sf), model_k(spark, sf), scratch_path(spark, "token-shards"), N_SHARDS)


@register("token_shards", with_ctes(FULL_ENCODE,
          f"SELECT doc_id, CAST(doc_id % {N_SHARDS} AS INTEGER) AS shard_id, n_tokens + 1 AS n_tokens, "
          f"CAST(coalesce(sum(n_tokens + 1) OVER (PARTITION BY doc_id % {N_SHARDS} ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS offset "
          f"FROM ({ENCODE_FINAL})"))
def q_token_shards(spark, sf):
    return shards_table(spark, sf).select("doc_id", F.col("shard_id").cast("int").alias("shard_id"), "n_tokens", "offset")


@register("corpus_to_shards", with_ctes(FULL_ENCODE,
          f"SELECT n_tokens + 1 AS n_tokens, trim(ids_text || ' 256') AS ids_text, CAST(count(*) AS BIGINT) AS n_docs FROM ({ENCODE_FINAL}) GROUP BY ALL"))
def q_corpus_to_shards(spark, sf):
    """From separator-terminated text files to shards and back; document ids are places in the files, so texts are counted."""
    from .plans.prepare import prepare_dataset
    from .session import scratch_path
    from .sources.corpus import read_corpus, write_corpus
    path = scratch_path(spark, "corpus-files")
    write_corpus(docs(spark, sf), path)
    stored = prepare_dataset(read_corpus(spark, path), model_k(spark, sf), scratch_path(spark, "corpus-shards"), N_SHARDS)
    return stored.groupBy("n_tokens", F.array_join("ids", " ").alias("ids_text")).agg(F.count(F.lit(1)).alias("n_docs"))


@register("raw_shards", with_ctes(STREAM_CTES,
          "SELECT shard_id, CAST(count(*) AS BIGINT) AS n_tokens, md5(string_agg(CAST(token_id AS VARCHAR), ' ' ORDER BY gp)) AS ids_md5 "
          "FROM (SELECT CAST(shard_id AS INTEGER) AS shard_id, gp, token_id FROM gpos) GROUP BY shard_id"))
def q_raw_shards(spark, sf):
    """Shards written as 16-bit files and read back by byte ranges: each shard's stream, whole."""
    from .session import scratch_path
    from .sources.shards import read_raw_shards, stream_digests, write_raw_shards
    path = scratch_path(spark, "raw-shards")
    enc = E.encode(docs(spark, sf), model_k(spark, sf), append_eot=True)
    write_raw_shards(enc.select("doc_id", F.pmod("doc_id", F.lit(N_SHARDS)).cast("int").alias("shard_id"), "ids"), path)
    rows = read_raw_shards(spark, path, split_bytes=1 << 18, row_tokens=1 << 14)
    return stream_digests(rows, F.regexp_extract("path", "shard=([0-9]+)", 1).cast("int"))


def windows_df(spark, sf) -> DataFrame:
    from .operators.batches import sequential_windows, training_pairs
    return training_pairs(sequential_windows(shards_table(spark, sf), WINDOW), WINDOW)


@register("sequential_windows", with_ctes(STREAM_CTES,
          f"SELECT shard_id, window_idx, n_real, array_to_string(p[1:{WINDOW - 1}], ' ') AS input_text, "
          f"array_to_string(p[2:{WINDOW}], ' ') AS target_text FROM wins"))
def q_sequential_windows(spark, sf):
    w = windows_df(spark, sf)
    return w.select(F.col("shard_id").cast("int").alias("shard_id"), F.col("window_idx").cast("long").alias("window_idx"), "n_real",
                    F.array_join("input_ids", " ").alias("input_text"), F.array_join("target_ids", " ").alias("target_text"))


@register("random_windows", with_ctes(STREAM_CTES + [
    ("tot", f"SELECT shard_id, sum(n_tokens + 1) AS n FROM (SELECT doc_id % {N_SHARDS} AS shard_id, n_tokens FROM doc_ids) GROUP BY shard_id"),
    ("spans", f"SELECT shard_id, j AS sample_idx, ('0x' || substr(md5('{SEED}|' || shard_id || '|' || j), 1, 15))::BIGINT % (n - {RAND_LEN}) AS start "
              f"FROM tot, unnest(generate_series(0, CAST(n // {RAND_LEN} AS BIGINT) - 1)) AS g(j) WHERE n > {RAND_LEN}")],
    f"SELECT CAST(s.shard_id AS INTEGER) AS shard_id, CAST(s.sample_idx AS BIGINT) AS sample_idx, CAST(s.start AS BIGINT) AS start, "
    f"array_to_string(list(g.token_id ORDER BY g.gp) FILTER (WHERE g.gp < s.start + {RAND_LEN}), ' ') AS input_text, "
    f"array_to_string(list(g.token_id ORDER BY g.gp) FILTER (WHERE g.gp > s.start), ' ') AS target_text "
    f"FROM spans s JOIN gpos g ON g.shard_id = s.shard_id AND g.gp BETWEEN s.start AND s.start + {RAND_LEN} "
    f"GROUP BY s.shard_id, s.sample_idx, s.start"))
def q_random_windows(spark, sf):
    from .operators.batches import random_windows
    r = random_windows(shards_table(spark, sf), RAND_LEN, seed=SEED)
    return r.select(F.col("shard_id").cast("int").alias("shard_id"), "sample_idx", "start",
                    F.array_join("input_ids", " ").alias("input_text"), F.array_join("target_ids", " ").alias("target_text"))


def batches_df(spark, sf) -> DataFrame:
    from .operators.batches import assign_device, build_batches
    return assign_device(build_batches(windows_df(spark, sf), BATCH, seed=SEED), BATCH, DEVICES)


@register("build_batches", with_ctes(STREAM_CTES,
          f"SELECT batch_id, row_in_batch, shard_id, window_idx, CAST(row_in_batch // {BATCH // DEVICES} AS INTEGER) AS device_id FROM bat"))
def q_build_batches(spark, sf):
    b = batches_df(spark, sf)
    return b.select("batch_id", "row_in_batch", F.col("shard_id").cast("int").alias("shard_id"),
                    F.col("window_idx").cast("long").alias("window_idx"), "device_id")


def feistel_sql(x: str, n: str, rounds: int = 4) -> list[str]:
    """Select lists, each over the one before, that put ``x`` through the network: the halves, the rounds, the place."""
    low = f"(greatest(length(bin({n} - 1)), 2) // 2)"
    high = f"(greatest(length(bin({n} - 1)), 2) - {low})"
    steps = [f"*, {x} >> {low} AS l, {x} & ((1::BIGINT << {low}) - 1) AS r"]
    for i in range(rounds):
        steps.append(f"* EXCLUDE (l, r), r AS l, xor(l, ('0x' || substr(md5('{SEED}|{i}|' || r), 1, 15))::BIGINT & ((1::BIGINT << {high if i % 2 == 0 else low}) - 1)) AS r")
    return steps + [f"* EXCLUDE (l, r), (l << {low}) + r AS place"]


def nested(selects: list[str], src: str) -> str:
    for s in selects:
        src = f"(SELECT {s} FROM {src})"
    return src


PERMUTED_CTES = [("walled", "SELECT CAST(shard_id AS INTEGER) AS shard_id, window_idx, row_number() OVER (ORDER BY shard_id, window_idx) - 1 AS num, "
                            "CAST(count(*) OVER () AS BIGINT) AS n FROM wins")]


@register("permuted_batches", "WITH RECURSIVE " + ",\n".join(f"{n} AS MATERIALIZED ({q})" for n, q in STREAM_CTES[:-1] + PERMUTED_CTES) + f""",
walk AS (SELECT shard_id, window_idx, num, n, place FROM {nested(feistel_sql("num", "n"), "walled")} UNION ALL
SELECT shard_id, window_idx, num, n, place FROM {nested(feistel_sql("old", "n"), "(SELECT shard_id, window_idx, num, n, place AS old FROM walk WHERE place >= n)")})
SELECT CAST(place // {BATCH} AS BIGINT) AS batch_id, CAST(place % {BATCH} AS INTEGER) AS row_in_batch, shard_id, CAST(window_idx AS BIGINT) AS window_idx FROM walk WHERE place < n""")
def q_permuted_batches(spark, sf):
    from .operators.batches import permuted_batches, sequential_windows, window_counts
    shards = shards_table(spark, sf)
    b = permuted_batches(sequential_windows(shards, WINDOW), window_counts(shards, WINDOW), BATCH, SEED)
    return b.select("batch_id", "row_in_batch", F.col("shard_id").cast("int").alias("shard_id"), F.col("window_idx").cast("long").alias("window_idx"))


PREVIEW = 512


@register("preview_batch", with_ctes(STREAM_CTES,
          f"SELECT batch_id, array_to_string(flatten(list(p[1:{WINDOW - 1}] ORDER BY row_in_batch))[1:{PREVIEW}], ' ') AS preview_text FROM bat GROUP BY batch_id"))
def q_preview_batch(spark, sf):
    from .operators.batches import preview_batch
    return preview_batch(batches_df(spark, sf), PREVIEW).select("batch_id", F.array_join("preview_ids", " ").alias("preview_text"))


def steps_df(spark, sf) -> DataFrame:
    """A step per document of the corpus (the step series grows with the data)."""
    return table(spark, sf, "documents").select(F.col("doc_id").alias("step"))


STEPS_SQL = "SELECT doc_id AS step FROM documents"


SUBSET = 5  # shards drawn per step, fewer than there are


@register("sample_shards",
          f"SELECT step, CAST(rn - 1 AS INTEGER) AS slot, shard_id FROM (SELECT step, CAST(s AS INTEGER) AS shard_id, row_number() OVER "
          f"(PARTITION BY step ORDER BY ('0x' || substr(md5('{SEED}|' || step || '|' || s), 1, 15))::BIGINT, s) AS rn "
          f"FROM ({STEPS_SQL}), unnest(generate_series(0, {N_SHARDS - 1})) AS g(s)) WHERE rn <= {SUBSET}")
def q_sample_shards(spark, sf):
    from .operators.batches import sample_shards
    return sample_shards(steps_df(spark, sf), N_SHARDS, SUBSET, SEED, by="rank")


def _drawn(i: int) -> str:
    """Draw ``i`` of Floyd's algorithm: the draw itself, or the last candidate where it was drawn before."""
    last = N_SHARDS - SUBSET + i
    x = f"('0x' || substr(md5('{SEED}|' || step || '|{last}'), 1, 15))::BIGINT % {last + 1}"
    return f"*, list_append(have, CASE WHEN list_contains(have, {x}) THEN {last} ELSE {x} END) AS next"


def _floyd_sql() -> str:
    src = f"(SELECT step, []::BIGINT[] AS have FROM ({STEPS_SQL}))"
    for i in range(SUBSET):
        src = f"(SELECT step, next AS have FROM (SELECT {_drawn(i)} FROM {src}))"
    return src


@register("sample_shards_floyd",
          f"SELECT step, CAST(row_number() OVER (PARTITION BY step ORDER BY ('0x' || substr(md5('{SEED}|' || step || '|order|' || s), 1, 15))::BIGINT, s) - 1 AS INTEGER) AS slot, "
          f"CAST(s AS INTEGER) AS shard_id FROM (SELECT step, unnest(have) AS s FROM {_floyd_sql()})")
def q_sample_shards_floyd(spark, sf):
    from .operators.batches import sample_shards
    return sample_shards(steps_df(spark, sf), N_SHARDS, SUBSET, SEED)


@register("sample_shards_replace",
          f"SELECT step, CAST(slot AS INTEGER) AS slot, CAST(('0x' || substr(md5('{SEED}|' || step || '|' || slot), 1, 15))::BIGINT % {N_SHARDS} AS INTEGER) AS shard_id "
          f"FROM ({STEPS_SQL}), unnest(generate_series(0, {BATCH + 4 - 1})) AS g(slot)")
def q_sample_shards_replace(spark, sf):
    from .operators.batches import sample_shards
    return sample_shards(steps_df(spark, sf), N_SHARDS, BATCH + 4, SEED)


# --- score tables (M1-M3, M6, A9, A10, T6, J8) ------------------------------------------

def emb(spark, sf) -> DataFrame:
    from .operators.scores import as_double_array
    return table(spark, sf, "embeddings").select("vec_id", "label", as_double_array("embedding").alias("x"))


def _long(df: DataFrame, arr: str, val: str = "p") -> DataFrame:
    return df.select("vec_id", F.posexplode(arr).alias("idx", val)).withColumn(val, F.round(val, 9))


EMB_SQL = "SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings"


def long_sql(list_expr: str, val: str = "p", src: str = EMB_SQL) -> str:
    return (f"SELECT vec_id, CAST(generate_subscripts(v, 1) - 1 AS INTEGER) AS idx, round(unnest(v), 9) AS {val} "
            f"FROM (SELECT vec_id, {list_expr} AS v FROM ({src}))")


SOFTMAX_SQL = "list_transform(x, lambda a: exp(a - list_max(x)) / list_sum(list_transform(x, lambda b: exp(b - list_max(x)))))"
TEMP = 0.7


@register("softmax", long_sql(SOFTMAX_SQL))
def q_softmax(spark, sf):
    from .operators.scores import softmax
    return _long(emb(spark, sf).select("vec_id", softmax(F.col("x")).alias("p")), "p")


@register("temperature_softmax", long_sql(SOFTMAX_SQL, src=f"SELECT vec_id, list_transform(y, lambda a: a - list_max(y)) AS x FROM "
                                                            f"(SELECT vec_id, list_transform(x, lambda a: a / {TEMP}) AS y FROM ({EMB_SQL}))"))
def q_temperature_softmax(spark, sf):
    from .operators.scores import softmax, temperature
    return _long(emb(spark, sf).select("vec_id", softmax(temperature(F.col("x"), TEMP)).alias("p")), "p")


LSE_SQL = "(list_max(x) + ln(list_sum(list_transform(x, lambda a: exp(a - list_max(x))))))"


@register("target_log_prob", f"SELECT vec_id, label, round(x[label + 1] - {LSE_SQL}, 9) AS log_prob FROM ({EMB_SQL})")
def q_target_log_prob(spark, sf):
    from .operators.scores import target_log_prob
    return emb(spark, sf).select("vec_id", "label", F.round(target_log_prob(F.col("x"), F.col("label")), 9).alias("log_prob"))


@register("cross_entropy", f"SELECT round(avg({LSE_SQL} - x[label + 1]), 9) AS mean_loss FROM ({EMB_SQL})")
def q_cross_entropy(spark, sf):
    from .operators.scores import cross_entropy
    return cross_entropy(emb(spark, sf), "x", "label")


VAL_BATCH, VAL_EVERY, VAL_GRID = 32, 10, 5


@register("mean_val_loss",
          f"WITH l AS (SELECT (vec_id // {VAL_BATCH}) * {VAL_EVERY} AS step, {LSE_SQL} - x[label + 1] AS loss FROM ({EMB_SQL})), "
          f"s AS (SELECT CAST(g AS BIGINT) AS step FROM range(0, (SELECT max(step) FROM l) + 1, {VAL_GRID}) t(g)) "
          f"SELECT s.step, round(coalesce(avg(l.loss), 0.0), 9) AS val_loss FROM s LEFT JOIN l USING (step) GROUP BY s.step")
def q_mean_val_loss(spark, sf):
    from .operators.scores import logsumexp, mean_val_loss
    e = emb(spark, sf)
    losses = e.select((F.floor(F.col("vec_id") / VAL_BATCH) * VAL_EVERY).cast("long").alias("step"),
                      (logsumexp(F.col("x")) - F.element_at("x", F.col("label") + 1)).alias("loss"))
    last = losses.agg(F.max("step")).first()[0]
    steps = spark.range(0, (last if last is not None else -1) + 1, VAL_GRID).select(F.col("id").alias("step"))
    return mean_val_loss(losses, steps)


@register("rms_normalize", long_sql("list_transform(x, lambda a: a / (sqrt(list_sum(list_transform(x, lambda b: b * b)) / len(x)) + 1e-6))", "value"))
def q_rms_normalize(spark, sf):
    from .operators.scores import rms_normalize
    return _long(emb(spark, sf).select("vec_id", rms_normalize(F.col("x")).alias("v")), "v", "value")


TOPK_VEC = 5


@register("topk_per_vector",
          f"SELECT vec_id, rk, idx, round(value, 9) AS value FROM (SELECT vec_id, CAST(i - 1 AS INTEGER) AS idx, value, "
          f"CAST(row_number() OVER (PARTITION BY vec_id ORDER BY value DESC, i) AS INTEGER) AS rk FROM "
          f"(SELECT vec_id, generate_subscripts(x, 1) AS i, unnest(x) AS value FROM ({EMB_SQL}))) WHERE rk <= {TOPK_VEC}")
def q_topk_per_vector(spark, sf):
    from .operators.scores import topk_per_vector
    t = emb(spark, sf).select("vec_id", F.posexplode(topk_per_vector(F.col("x"), TOPK_VEC)).alias("pos", "s"))
    return t.select("vec_id", (F.col("pos") + 1).cast("int").alias("rk"), F.col("s.idx").cast("int").alias("idx"),
                    F.round("s.value", 9).alias("value"))


@register("embedding_lookup", with_ctes(FULL_ENCODE,
          "SELECT t.token_id, t.n, e.label, round(sqrt(list_sum(list_transform(CAST(e.embedding AS DOUBLE[]), lambda a: a * a))), 9) AS norm "
          "FROM (SELECT token_id, CAST(count(*) AS BIGINT) AS n FROM tok GROUP BY token_id) t JOIN embeddings e ON e.vec_id = t.token_id"))
def q_embedding_lookup(spark, sf):
    from .operators.scores import embedding_lookup
    counts = encoded(spark, sf).select(F.explode("ids").alias("token_id")).groupBy("token_id").agg(F.count(F.lit(1)).alias("n"))
    e = emb(spark, sf)
    j = embedding_lookup(counts, e)
    return j.select("token_id", "n", "label", F.round(F.sqrt(F.aggregate("x", F.lit(0.0), lambda a, v: a + v * v)), 9).alias("norm"))


# --- next-token candidates (W7, W8, T1, T2, T3, U5) -------------------------------------

TOPK, TOP_P = 20, 0.5
BIGRAM_SQL = (f"SELECT context, token, CAST(count(*) AS BIGINT) AS n FROM (SELECT t[i] AS context, t[i + 1] AS token FROM "
              f"(SELECT {pre('text')} AS t FROM documents) d, unnest(generate_series(1, len(t) - 1)) AS g(i)) GROUP BY context, token")
CANDS = [("bi", BIGRAM_SQL),
         ("pr", "SELECT context, token, n, sum(n) OVER (PARTITION BY context) AS n_total, n / sum(n) OVER (PARTITION BY context) AS p, "
                "CAST(row_number() OVER (PARTITION BY context ORDER BY n DESC, token) AS INTEGER) AS rk FROM bi")]


def cands(spark, sf) -> DataFrame:
    from .operators.scores import bigram_counts
    return bigram_counts(docs(spark, sf))


def ranged_cands(spark, sf) -> DataFrame:
    """The candidates in blocks: counted and written once, for every step that follows."""
    from .operators.scores import in_blocks
    return in_blocks(cands(spark, sf))


def probs(spark, sf) -> DataFrame:
    from .operators.scores import candidate_probs
    return candidate_probs(ranged_cands(spark, sf))


@register("candidate_probs", with_ctes(CANDS, "SELECT context, token, n, round(p, 9) AS p FROM pr"))
def q_candidate_probs(spark, sf):
    return probs(spark, sf).select("context", "token", "n", F.round("p", 9).alias("p"))


@register("rank_candidates", with_ctes(CANDS, "SELECT context, token, rk FROM pr"))
def q_rank_candidates(spark, sf):
    from .operators.scores import rank_candidates
    return rank_candidates(ranged_cands(spark, sf)).select("context", "token", "rk")


@register("cumulative_mass", with_ctes(CANDS, "SELECT context, token, rk, round(sum(p) OVER (PARTITION BY context ORDER BY rk "
                                             "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 9) AS mass FROM pr"))
def q_cumulative_mass(spark, sf):
    from .operators.scores import cumulative_mass, rank_candidates
    r = cumulative_mass(rank_candidates(probs(spark, sf)))
    return r.select("context", "token", "rk", F.round("mass", 9).alias("mass"))


@register("topk_candidates", with_ctes(CANDS, f"SELECT context, token, rk, round(p, 9) AS p FROM pr WHERE rk <= {TOPK}"))
def q_topk_candidates(spark, sf):
    from .operators.scores import topk_candidates
    return topk_candidates(probs(spark, sf), TOPK).select("context", "token", F.col("rk").cast("int").alias("rk"), F.round("p", 9).alias("p"))


@register("nucleus", with_ctes(CANDS + [
    ("tk", f"SELECT context, token, rk, n, n_total, coalesce(sum(n) OVER (PARTITION BY context ORDER BY rk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS nb "
           f"FROM pr WHERE rk <= {TOPK}"),
    ("kept", f"SELECT * FROM tk WHERE nb / n_total < {TOP_P}")],
    "SELECT context, token, rk, round(n / sum(n) OVER (PARTITION BY context), 9) AS p_norm FROM kept"))
def q_nucleus(spark, sf):
    from .operators.scores import nucleus, topk_candidates
    n = nucleus(topk_candidates(probs(spark, sf), TOPK), TOP_P)
    return n.select("context", "token", F.col("rk").cast("int").alias("rk"), F.round("p_norm", 9).alias("p_norm"))


CHAIN_CTES = CANDS[:1] + [
    ("pw", f"SELECT context, token, n, pow(CAST(n AS DOUBLE), {1.0 / TEMP!r}) AS w FROM bi"),
    ("rkd", "SELECT *, sum(w) OVER (PARTITION BY context) AS wt, row_number() OVER (PARTITION BY context ORDER BY n DESC, token) AS rk FROM pw"),
    ("best", f"SELECT *, coalesce(sum(w) OVER (PARTITION BY context ORDER BY rk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS wb FROM rkd WHERE rk <= {TOPK}"),
    ("kept", f"SELECT * FROM best WHERE wb / wt < {TOP_P}")]


@register("candidate_probs_t", with_ctes(CHAIN_CTES[:3], "SELECT context, token, n, round(w / wt, 9) AS p FROM rkd"))
def q_candidate_probs_t(spark, sf):
    from .operators.scores import candidate_probs
    return candidate_probs(ranged_cands(spark, sf), TEMP).select("context", "token", "n", F.round("p", 9).alias("p"))


@register("cumulative_mass_t", with_ctes(CHAIN_CTES[:3],
          "SELECT context, token, CAST(rk AS INTEGER) AS rk, round(sum(w) OVER (PARTITION BY context ORDER BY rk ROWS BETWEEN UNBOUNDED PRECEDING "
          "AND CURRENT ROW) / wt, 9) AS mass FROM rkd"))
def q_cumulative_mass_t(spark, sf):
    from .operators.scores import candidate_probs, cumulative_mass, rank_candidates
    r = cumulative_mass(rank_candidates(candidate_probs(ranged_cands(spark, sf), TEMP)))
    return r.select("context", "token", "rk", F.round("mass", 9).alias("mass"))


@register("sample_next", with_ctes(CHAIN_CTES,
          f"SELECT context, arg_max(token, (round(ln(w) - ln(-ln((('0x' || substr(md5('{SEED}|' || context || '|' || token), 1, 15))::BIGINT + 0.5) "
          f"/ {float(1 << 60)})), 9), token)) AS token FROM kept GROUP BY context"))
def q_sample_next(spark, sf):
    from .operators.scores import sample_next
    return sample_next(cands(spark, sf), SEED, TEMP, TOPK, TOP_P)


@register("argmax_token", with_ctes(CANDS, "SELECT context, token, n FROM pr WHERE rk = 1"))
def q_argmax_token(spark, sf):
    from .operators.scores import argmax_token
    return argmax_token(cands(spark, sf))


@register("weighted_sample", with_ctes(CANDS,
          f"SELECT context, arg_max(token, (round(ln(n) - ln(-ln((('0x' || substr(md5('{SEED}|' || context || '|' || token), 1, 15))::BIGINT + 0.5) "
          f"/ {float(1 << 60)})), 9), token)) AS token FROM bi GROUP BY context"))
def q_weighted_sample(spark, sf):
    from .operators.scores import weighted_sample
    return weighted_sample(cands(spark, sf), SEED)


# --- schedules and step series (M4, M5, J10, P15, P16) --------------------------------

CHAIN = [(0, 0.0), (200, 1e-4), (400, 5e-5), (800, 1e-5)]
COS = dict(max_lr=1e-3, min_lr=1e-4, warmup=100, cycle=600)
ACCUM, SEQ = 4, 64


def _chain_sql() -> str:
    rows = []
    n = len(CHAIN) - 1
    for i in range(n):
        (s0, l0), (s1, l1) = CHAIN[i], CHAIN[i + 1]
        rows.append(f"({i}, {'NULL' if i == 0 else s0}, {s1}, {s0}, {s1}, {l0!r}, {l1!r}, '{'cosine' if i == n - 1 else 'linear'}')")
    sl, ll = CHAIN[-1]
    rows.append(f"({n}, {sl}, NULL, {sl}, {sl}, {ll!r}, {ll!r}, 'constant')")
    return ("SELECT * FROM (VALUES " + ", ".join(rows) + ") v(seg, lo, hi, s0, s1, lr0, lr1, kind)")


ANNOT_SQL = (f"SELECT s.step, CAST(g.seg AS INTEGER) AS seg, g.s0, g.s1, g.lr0, g.lr1, g.kind FROM ({STEPS_SQL}) s JOIN ({_chain_sql()}) g "
             f"ON (g.lo IS NULL OR s.step >= g.lo) AND (g.hi IS NULL OR s.step < g.hi)")


@register("annotate_lr", f"SELECT step, seg FROM ({ANNOT_SQL})")
def q_annotate_lr(spark, sf):
    from .operators.schedule import annotate_lr, segments
    return annotate_lr(steps_df(spark, sf), segments(spark, CHAIN)).select("step", "seg")


@register("lr_schedule",
          f"SELECT step, seg, round(CASE WHEN kind = 'constant' THEN lr0 WHEN s1 = s0 THEN lr0 "
          f"WHEN kind = 'linear' THEN lr0 + (step - s0) / (s1 - s0) * (lr1 - lr0) "
          f"ELSE lr1 + 0.5 * (lr0 - lr1) * (1 + cos((step - s0) / (s1 - s0) * pi())) END, 12) AS lr FROM ({ANNOT_SQL})")
def q_lr_schedule(spark, sf):
    from .operators.schedule import lr_schedule
    return lr_schedule(steps_df(spark, sf), CHAIN)


@register("lr_cosine_warmup",
          f"SELECT step, round(CASE WHEN step < {COS['warmup']} THEN step / {float(COS['warmup'])} * {COS['max_lr']} "
          f"WHEN step <= {COS['cycle']} THEN {COS['min_lr']} + 0.5 * (1 + cos((step - {COS['warmup']}) / {float(COS['cycle'] - COS['warmup'])} * pi())) "
          f"* ({COS['max_lr']} - {COS['min_lr']}) ELSE {COS['min_lr']} END, 12) AS lr FROM ({STEPS_SQL})")
def q_lr_cosine_warmup(spark, sf):
    from .operators.schedule import lr_cosine_with_warmup
    s = steps_df(spark, sf)
    return s.select("step", F.round(lr_cosine_with_warmup(F.col("step"), **COS), 12).alias("lr"))


@register("step_metrics",
          f"SELECT step, CAST((step + 1) * {BATCH} * {SEQ} AS BIGINT) AS tokens_seen, CAST((step + 1) // {ACCUM} AS BIGINT) AS effective_steps, "
          f"CAST({BATCH * ACCUM} AS BIGINT) AS effective_batch FROM ({STEPS_SQL}) WHERE (step + 1) % {ACCUM} = 0")
def q_step_metrics(spark, sf):
    from .operators.schedule import step_metrics
    return step_metrics(steps_df(spark, sf), BATCH, SEQ, ACCUM)


@register("periodic",
          f"SELECT step, (step + 1) % 50 = 0 AS is_checkpoint, (step + 1) % 20 = 0 AS is_validation FROM ({STEPS_SQL}) "
          f"WHERE (step + 1) % 50 = 0 OR (step + 1) % 20 = 0")
def q_periodic(spark, sf):
    from .operators.schedule import periodic
    return periodic(steps_df(spark, sf), 50, 20)


# --- streams (ST1, ST2) -------------------------------------------------------------

DOC_SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@register("count_words_stream", WORDS_SQL)
def q_count_words_stream(spark, sf):
    from .session import scratch_path
    from .streaming.streams import count_words_stream, run_to_end, running_counts, stream_table
    out = scratch_path(spark, "st2-out")
    run_to_end(count_words_stream(stream_table(spark, sf, DOC_SCHEMA, "documents.parquet"), out))
    return running_counts(spark, out)


@register("encode_stream", with_ctes(FULL_ENCODE, ENCODE_FINAL))
def q_encode_stream(spark, sf):
    from .session import scratch_path
    from .streaming.streams import encode_stream, run_to_end, stream_table
    out = scratch_path(spark, "st1-out")
    m = model_k(spark, sf)
    run_to_end(encode_stream(stream_table(spark, sf, DOC_SCHEMA, "documents.parquet"), m, out))
    return encoded_view(spark.read.schema("doc_id bigint, ids array<int>").parquet(out))


@register("encode_lines_stream", with_ctes(FULL_ENCODE, ENCODE_FINAL))
def q_encode_lines_stream(spark, sf):
    """Every document as a stream of its lines, several files of them, encoded as the whole texts are."""
    from .session import scratch_path
    from .streaming.streams import encode_lines_stream, joined_pieces, run_to_end, stream_table
    src, out = scratch_path(spark, "st1-lines"), scratch_path(spark, "st1-lines-out")
    held = docs(spark, sf).select("doc_id", F.split("text", "\n", -1).alias("parts"))
    lines = held.select("doc_id", F.posexplode("parts").alias("line_no", "line"), F.size("parts").alias("n"))
    (lines.select("doc_id", F.col("line_no").cast("long").alias("line_no"), "line", (F.col("line_no") == F.col("n") - 1).alias("is_last"))
     .repartition(16, "doc_id", "line_no").write.parquet(src))
    stream = stream_table(spark, src, "doc_id bigint, line_no bigint, line string, is_last boolean", max_files=6)
    run_to_end(encode_lines_stream(stream, model_k(spark, sf), out))
    return encoded_view(joined_pieces(spark.read.schema("doc_id bigint, piece_no bigint, ids array<int>").parquet(out)))


# --- lookups by id and by bytes (J1, J2) -----------------------------------------------

@register("ids_to_bytes", with_ctes(FULL_ENCODE,
          "SELECT t.token_id, v.token_hex, CAST(count(*) AS BIGINT) AS n FROM tok t JOIN vocab v USING (token_id) "
          "GROUP BY t.token_id, v.token_hex"))
def q_ids_to_bytes(spark, sf):
    m = model_k(spark, sf)
    counts = encoded(spark, sf).select(F.explode("ids").alias("token_id")).groupBy("token_id").agg(F.count(F.lit(1)).alias("n"))
    return E.ids_to_bytes(counts, m.vocab_df(spark)).select("token_id", "token_hex", "n")


@register("bytes_to_ids", with_ctes(FULL_ENCODE,
          f"SELECT DISTINCT x.h AS token_hex, v.token_id FROM (SELECT unnest({duckdb_syms_array('s')}) AS h FROM enc) x "
          f"LEFT JOIN vfirst v ON v.token_hex = x.h"))
def q_bytes_to_ids(spark, sf):
    from .functions.symbols import syms_array
    m = model_k(spark, sf)
    syms = E.rank_fold_syms(PT.count_words(docs(spark, sf)), m)
    hexes = syms.select(F.explode(syms_array("syms")).alias("token_hex")).distinct()
    return E.bytes_to_ids(hexes, m.vocab_df(spark)).select("token_hex", "token_id")
