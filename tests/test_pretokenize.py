import regex
from pyspark.sql import functions as F

from mergeloom.functions.patterns import END_OF_TEXT
from mergeloom.operators.pretokenize import count_words, pretoken_array, pretokenize

# The pre-token rule written for Python's `regex` module, used as brute force.
PY_PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

SAMPLES = ["", "s", "🙃", "Hello, how are you?", "Héllò hôw are ü? 🙃", "a  b\n\n c\t\td  ", "it's 1234 don't we'll",
           "x  \n", "  leading", "tail   ", "ümlaut straße 42!!!"]


def py_split_with_specials(text, specials):
    if not specials:
        return regex.findall(PY_PATTERN, text)
    sp = "|".join(regex.escape(s) for s in sorted(specials, key=len, reverse=True))
    out, pos = [], 0
    for m in regex.finditer(sp, text):
        out += regex.findall(PY_PATTERN, text[pos:m.start()])
        out.append(m.group())
        pos = m.end()
    return out + regex.findall(PY_PATTERN, text[pos:])


def _split(spark, texts, specials=None):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    return [r.t for r in df.select(pretoken_array("text", specials).alias("t")).orderBy("doc_id").collect()]


def test_literals_match_python_regex(spark):
    got = _split(spark, SAMPLES)
    assert got == [regex.findall(PY_PATTERN, t) for t in SAMPLES]


def test_specials_isolated_longest_first(spark):
    specials = [END_OF_TEXT, END_OF_TEXT + END_OF_TEXT]
    texts = ["Hello, how <|endoftext|><|endoftext|> are you?<|endoftext|>",
             "<|endoftext|>\n\n", "testing!<|endoftext|>\n\n", "a <|endoftext|><|endoftext|><|endoftext|> b"]
    got = _split(spark, texts, specials)
    assert got == [py_split_with_specials(t, specials) for t in texts]
    assert got[0][-4:-1] == [" you", "?", END_OF_TEXT] or END_OF_TEXT in got[0]
    assert END_OF_TEXT + END_OF_TEXT in got[0]


def test_lossless_and_counts_on_documents(spark, small_docs):
    rows = small_docs.select("doc_id", "text", pretoken_array("text").alias("t")).collect()
    for r in rows:
        assert "".join(r.t) == r.text
        assert r.t == regex.findall(PY_PATTERN, r.text)
    total = sum(len(r.t) for r in rows)
    wc = count_words(small_docs)
    assert wc.agg(F.sum("freq")).first()[0] == total


def test_pretokenize_positions(spark, small_docs):
    occ = pretokenize(small_docs)
    assert occ.columns == ["doc_id", "pos", "pretoken"]
    first = occ.filter("pos = 0").count()
    assert first == small_docs.count()
