"""Pre-token split pattern, for Spark (Java regex) and for the DuckDB oracle (RE2).

Special tokens are isolated *before* the pattern runs: the text is cut at every
special (longest first), each piece is split by the pattern, and the specials
are put back between the pieces.  A special therefore never loses a leading
space or punctuation to a neighbouring pre-token.
"""

from __future__ import annotations

from collections.abc import Sequence

# The pre-token rule that results must agree with. Alternatives
# are tried in this order.
CONTRACTIONS = r"'(?:[sdmt]|ll|ve|re)"
LETTERS = r" ?\p{L}+"
NUMBERS = r" ?\p{N}+"
OTHER = r" ?[^\s\p{L}\p{N}]+"
TRAILING_SPACE = r"\s+(?!\S)"
SPACE = r"\s+"

# Fixed value: the default document separator / end-of-text special token.
END_OF_TEXT = "<|endoftext|>"


def quote(literal: str) -> str:
    """Quote a literal for both Java regex and RE2 (``\\Q...\\E``)."""
    return r"\Q" + literal.replace(r"\E", r"\E\\E\Q") + r"\E"


def ordered_specials(specials: Sequence[str] | None) -> list[str]:
    """Distinct non-empty specials, longest first, so an overlapping longer one wins."""
    seen: list[str] = []
    for s in specials or []:
        if s and s not in seen:
            seen.append(s)
    return sorted(seen, key=lambda s: (-len(s), s))


def spark_pattern() -> str:
    """Java pattern; ``(?U)`` makes ``\\s`` match Unicode white space as well."""
    return "(?U)" + "|".join([CONTRACTIONS, LETTERS, NUMBERS, OTHER, TRAILING_SPACE, SPACE])


def special_pattern(specials: Sequence[str]) -> str:
    """Alternation of the specials only (longest first)."""
    return "|".join(quote(s) for s in ordered_specials(specials))


def sql_literal(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


# --- DuckDB / RE2 form (no look-ahead) -------------------------------------------
# A white-space run that is followed by a non-space gives up its last character
# to the next pre-token.  RE2 cannot look ahead, so the oracle first inserts a
# marker U+0001 before that last character; the marker matches no alternative
# and is skipped by regexp_extract_all.  Valid for text without U+0001 and with
# ASCII white space only (RE2's \s is ASCII).

DUCKDB_PATTERN = "|".join([CONTRACTIONS, LETTERS, NUMBERS, r" ?[^\s\p{L}\p{N}\x01]+", SPACE])


def duckdb_piece_tokens(piece_sql: str) -> str:
    marked = rf"regexp_replace({piece_sql}, '(\s+)(\s)(\S)', '\1' || chr(1) || '\2\3', 'g')"
    return f"regexp_extract_all({marked}, {sql_literal(DUCKDB_PATTERN)})"


def duckdb_pretokens_expr(text_sql: str, specials: Sequence[str] | None = None) -> str:
    """DuckDB list expression of the pre-tokens of ``text_sql``."""
    if not specials:
        return duckdb_piece_tokens(text_sql)
    sp = sql_literal(special_pattern(specials))
    pieces = f"string_split_regex({text_sql}, {sp})"
    found = f"regexp_extract_all({text_sql}, {sp})"
    return (
        f"flatten(list_transform(range(1, len({pieces}) + 1), lambda i: "
        f"list_concat({duckdb_piece_tokens(f'{pieces}[i]')}, "
        f"CASE WHEN i <= len({found}) THEN [{found}[i]] ELSE [] END)))"
    )
