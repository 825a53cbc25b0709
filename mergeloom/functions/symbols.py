"""Symbol strings: a word's current tokens as delimited upper-case hex bytes.

``"the"`` starts as ``<74><68><65>``.  Merging the pair (74, 68) is one literal
``replace(syms, '<74><68>', '<7468>')``: left-to-right, non-overlapping, no UDF.
Upper-case hex order equals unsigned byte order (shorter prefix first), so the
tie rule on byte pairs is plain string order on the hex of each side.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_syms(word: Column | str) -> Column:
    """Word → ``<b1><b2>...`` over its UTF-8 bytes."""
    w = F.col(word) if isinstance(word, str) else word
    return F.regexp_replace(F.hex(F.encode(w, "UTF-8")), "(..)", "<$1>")


def syms_array(syms: Column | str) -> Column:
    """``<a><b>`` → ``['a', 'b']`` (hex of each symbol)."""
    s = F.col(syms) if isinstance(syms, str) else syms
    return F.split(F.substring(s, F.lit(2), F.length(s) - 2), "><")


def n_symbols(syms: Column | str) -> Column:
    s = F.col(syms) if isinstance(syms, str) else syms
    return F.size(syms_array(s))


def pair_structs(arr: Column) -> Column:
    """Array of adjacent ``struct(l, r)`` of a hex-symbol array (empty for one symbol)."""
    n = F.greatest(F.size(arr) - 1, F.lit(0))
    return F.arrays_zip(F.slice(arr, 1, n).alias("l"), F.slice(arr, 2, n).alias("r"))


def merge_pattern(l_hex: str, r_hex: str) -> tuple[str, str]:
    return f"<{l_hex}><{r_hex}>", f"<{l_hex}{r_hex}>"


def apply_merges(syms: Column, merges: Iterable[tuple[str, str]]) -> Column:
    """Fold of literal replaces, in the given order (exact BPE merge semantics)."""
    out = syms
    for l_hex, r_hex in merges:
        old, new = merge_pattern(l_hex, r_hex)
        out = F.replace(out, F.lit(old), F.lit(new))
    return out


def string_array(items: Sequence[str]) -> Column:
    """ARRAY<STRING> constant from one string literal (one expression, not one per item)."""
    if not items:
        return F.array().cast("array<string>")
    return F.split(F.lit("\t".join(items)), "\t")


def apply_merges_data(syms: Column, merges: Sequence[tuple[str, str]]) -> Column:
    """Same result as :func:`apply_merges`, but the merge list is data: two array
    constants folded by ``aggregate``.  The generated code is the same for every
    merge list and the plan stays small however many merges are applied."""
    steps = [merge_pattern(l, r) for l, r in merges]
    olds = string_array([o for o, _ in steps])
    news = string_array([n for _, n in steps])
    return F.aggregate(F.arrays_zip(olds.alias("o"), news.alias("n")), syms,
                       lambda acc, m: F.replace(acc, m["o"], m["n"]))


# --- DuckDB forms used by the oracle ---------------------------------------------

def duckdb_to_syms(word_sql: str) -> str:
    return rf"regexp_replace(hex(encode({word_sql})), '(..)', '<\1>', 'g')"


def duckdb_syms_array(syms_sql: str) -> str:
    return f"string_split(substr({syms_sql}, 2, length({syms_sql}) - 2), '><')"
