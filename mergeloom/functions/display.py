"""Printable one-character alias per byte (P6) for vocab / merges interchange files.

Rule: bytes whose Latin-1 character is visible keep it; the other 68 bytes
take, in increasing byte order, the characters U+0100, U+0101, ...
"""

from __future__ import annotations

from functools import lru_cache

# The byte ranges that are printed as their own Latin-1 character.
VISIBLE_RANGES = [(0x21, 0x7E), (0xA1, 0xAC), (0xAE, 0xFF)]


# The other ranges, in byte order, and the first character that each is shown as.
HIDDEN_RANGES = [(0x00, 0x20, 0x100), (0x7F, 0xA0, 0x121), (0xAD, 0xAD, 0x143)]


@lru_cache(maxsize=1)
def byte_to_char() -> dict[int, str]:
    shown = [(lo, hi, lo) for lo, hi in VISIBLE_RANGES] + HIDDEN_RANGES
    return {b: chr(first + b - lo) for lo, hi, first in sorted(shown) for b in range(lo, hi + 1)}


@lru_cache(maxsize=1)
def char_to_byte() -> dict[str, int]:
    return {c: b for b, c in byte_to_char().items()}


def display(b: bytes) -> str:
    m = byte_to_char()
    return "".join(m[x] for x in b)


def undisplay(s: str) -> bytes:
    m = char_to_byte()
    return bytes(m[c] for c in s)
