"""Ids on their way through a shuffle: arrays of ints as strings, a character an id.

An id is its code point in UTF-8, so that the small ids, the frequent ones, take one byte or
two instead of four.  Packed in Python, unpacked by built-ins, which keep a plan's
partitioning.  Ids that are no code point of one character (null, below 0, from ``MOST`` on)
leave their array as it is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

MOST = 0xD800  # the first code point that is no character
SLICE_IDS = 1 << 19  # ids of the rows that are packed together, unless one row has more


def pack_ids(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of ``ids`` (from 0, below ``MOST``) and where each id begins and the last ends in them."""
    sizes = 1 + (ids >= 0x80).view(np.int8) + (ids >= 0x800).view(np.int8)
    places = np.zeros(len(ids) + 1, np.int64)
    np.cumsum(sizes, out=places[1:])
    out = np.repeat(ids.astype(np.uint8), sizes)
    for size, lead in ((2, 0xC0), (3, 0xE0)):
        rows = np.flatnonzero(sizes == size)
        value, begin = ids[rows], places[rows]
        for k in range(size - 1, 0, -1):
            out[begin + k] = 0x80 | value & 0x3F
            value = value >> 6
        out[begin] = lead | value
    return out, places


def _offsets(rows: pa.Array) -> np.ndarray:
    """Where the rows of a list array begin and the last ends."""
    if not len(rows):
        return np.zeros(1, np.int64)
    return np.asarray(rows.offsets).astype(np.int64)


def row_slices(rows: pa.Array, most: int) -> Iterator[pa.Array]:
    """``rows`` (lists) in order, in slices of ``most`` entries at most, one row at least."""
    ends = np.cumsum(np.asarray(pc.list_value_length(rows).fill_null(0)), dtype=np.int64)
    a = 0
    while a < len(rows) or a == 0:  # an empty batch is one slice
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + most, side="right")))
        yield rows.slice(a, b - a)
        a = b


def packed_rows(rows: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of lists of ints: each row's first id and number of ids, the bytes of all ids, where the
    ids begin (and the last ends) in them, and which ids have no packed form."""
    at = _offsets(rows)
    flat = rows.values.slice(at[0], at[-1] - at[0])
    ids = np.asarray(flat.fill_null(-1))
    odd = (ids < 0) | (ids >= MOST)
    data, places = pack_ids(np.where(odd, 0, ids) if odd.any() else ids)
    return at[:-1] - at[0], np.diff(at), data, places, odd


def text_slices(data: np.ndarray, low: np.ndarray, high: np.ndarray, odd: np.ndarray) -> pa.Array:
    """``data[low:high]`` of each pair as a string, null where ``odd``."""
    ends = np.append(0, np.cumsum(high - low))
    if len(low) and not (ends[:-1] + low[0] == low).all():
        data = data[np.repeat(low - ends[:-1], high - low) + np.arange(ends[-1])]
    else:
        data = data[low[0]:high[-1]] if len(low) else data[:0]
    made = pa.Array.from_buffers(pa.string(), len(low), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))])
    return pc.if_else(pa.array(odd), pa.scalar(None, pa.string()), made) if odd.any() else made


def any_odd(odd: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Whether one of the ids from ``first`` to before ``last`` has no packed form."""
    if not odd.any():
        return np.zeros(len(first), bool)
    upto = np.append(0, np.cumsum(odd))
    return upto[last] > upto[first]


def pack_rows(rows: pa.Array) -> pa.Array:
    first, n, data, places, odd = packed_rows(rows)
    return text_slices(data, places[first], places[first + n], any_odd(odd, first, first + n) | np.asarray(rows.is_null()))


def packable(df: DataFrame, col: str) -> bool:
    """Whether ``col`` is an array of ints; other arrays go as they are."""
    return df.schema[col].dataType.simpleString() == "array<int>"


def packed(ids: Column | str) -> Column:
    """``ids ARRAY<INT>`` as a string, null where that cannot be."""
    @F.arrow_udf(StringType())
    def pack(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            for rows in row_slices(batch, SLICE_IDS):
                yield pack_rows(rows)

    return pack(ids)


def unpacked(text: Column, ids: Column) -> Column:
    """The ids of ``text``, or ``ids`` where there is none."""
    return F.when(text.isNull(), ids).when(text == "", F.array().cast("array<int>")).otherwise(
        F.transform(F.split(text, ""), lambda c: F.ascii(c)))
