"""Helpers shared by the operators of this subpackage: scratch tables, Arrow row functions."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir, scratch_path

CHUNK_CHARS = 1 << 20  # characters a Python task holds in its numpy arrays at once


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the data folder, as its files are split."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read again (cuts the lineage)."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def cut(df: DataFrame) -> DataFrame:
    """A reliable checkpoint of a thin table in the shared checkpoint folder."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def without(df: DataFrame, names) -> DataFrame:
    """``df`` less the columns that an operator is about to add (its results win a clash)."""
    taken = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])


def guarded(df: DataFrame, names, body: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``body(df)`` on rows whose columns named like ``names`` are set aside; exactly the columns of ``df`` come back."""
    taken = {n.lower() for n in names}
    hidden = {c: f"__own{i}" for i, c in enumerate(df.columns) if c.lower() in taken}
    out = body(df.withColumnsRenamed(hidden))
    return out.select(*[F.col(f"`{hidden.get(c, c)}`").alias(c) for c in df.columns])


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once a row, also where ``body`` holds lambdas."""
    return F.transform(F.array(value), body)[0]


def add_columns(df: DataFrame, fn: Callable[[pa.RecordBatch], list[pa.Array]], added: T.StructType,
                keep: list[str] | None = None) -> DataFrame:
    """Append the columns that ``fn`` computes from each Arrow batch; narrow, no shuffle.

    ``keep`` names the input columns that stay (default all but those clashing with
    ``added``).  ``fn`` returns one array a field of ``added``, in its order.
    """
    taken = {f.name.lower() for f in added.fields}
    kept = [f for f in df.schema.fields
            if (f.name in keep if keep is not None else True) and f.name.lower() not in taken]
    names = [f.name for f in kept]
    out_names = names + [f.name for f in added.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            arrays = [batch.column(n) for n in names] + fn(batch)
            yield pa.RecordBatch.from_arrays(arrays, names=out_names)

    return df.mapInArrow(run, T.StructType(kept + list(added.fields)))


def spans_of(lengths, limit: int) -> Iterator[tuple[int, int]]:
    """Consecutive row ranges holding at most ``limit`` units, one row at least."""
    start, held = 0, 0
    for i, n in enumerate(lengths):
        if i > start and held + n > limit:
            yield start, i
            start, held = i, 0
        held += n
    if len(lengths) > start:
        yield start, len(lengths)


def cuts_before(text: str, limit: int, border: str) -> Iterator[tuple[int, int]]:
    """Ranges of a text of about ``limit`` characters, each but the last ending where the pattern ``border`` matches.

    A stretch without a border stays whole.
    """
    at, mark = 0, re.compile(border)
    while at < len(text):
        found = mark.search(text, at + limit) if at + limit < len(text) else None
        end = found.start() if found and found.start() > at else (found.end() if found else len(text))
        yield at, end
        at = end


def text_chunks(batch: pa.RecordBatch, column: str, limit: int = CHUNK_CHARS) -> Iterator[tuple[int, list]]:
    """``(first row, texts)`` in pieces of about ``limit`` bytes; null texts stay None."""
    col = batch.column(column)
    lengths = np.asarray(pc.binary_length(col).fill_null(0))
    for a, b in spans_of(lengths.tolist(), limit):
        yield a, col.slice(a, b - a).to_pylist()
