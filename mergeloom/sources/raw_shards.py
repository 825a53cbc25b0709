"""Raw token shards: files of little-endian uint16 ids, as a Python data source.

Writing: every task streams its rows into files of its own below ``_temporary``; a shard
or a block that begins starts a new file.  The commit moves the files of the attempts
that won into place (``shard=SSSSS/part-BBBBBBBB.data``, in stream order by name) and
then writes ``_SUCCESS``, so a lost executor or a second attempt leaves nothing behind that
is read.  Reading: files are split by byte range, a split gives rows of at most
``rows_tokens`` ids with their place in the file.

Paths are opened with ``pyarrow.fs``: a mounted folder, or any store that Arrow knows, in
reach of driver and executors alike.
"""

from __future__ import annotations

import hashlib
import os
import posixpath
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition,
                                    WriterCommitMessage)
from pyspark.sql.types import StructType

SUFFIX = ".data"
SPLIT_BYTES = 64 << 20
ROW_TOKENS = 1 << 16
FORMAT = "uint16shards"


def located(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path and the path inside it."""
    if path.startswith("file:") and not path.startswith("file://"):  # as Hadoop spells it
        path = path[len("file:"):]
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def visible_files(path: str) -> list[fs.FileInfo]:
    """Data files below a folder (or the file itself), by name; hidden and unfinished ones are passed over."""
    store, inside = located(path)
    info = store.get_file_info(inside)
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    found = [info] if info.type == fs.FileType.File else store.get_file_info(fs.FileSelector(inside, recursive=True))
    root = inside.rstrip("/")

    def shown(f: fs.FileInfo) -> bool:
        steps = f.path[len(root):].strip("/").split("/") if f.path != inside else [f.base_name]
        return f.type == fs.FileType.File and f.base_name.endswith(SUFFIX) and not any(s.startswith((".", "_")) for s in steps)

    return sorted(filter(shown, found), key=lambda f: f.path)


@dataclass
class ByteRange(InputPartition):
    path: str
    start: int
    stop: int

    def __init__(self, path: str, start: int, stop: int):
        super().__init__((path, start, stop))
        self.path, self.start, self.stop = path, start, stop


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.split = max(2, int(options.get("splitbytes", SPLIT_BYTES)) // 2 * 2)
        self.row = max(1, int(options.get("rowtokens", ROW_TOKENS)))

    def partitions(self) -> list[InputPartition]:
        out = []
        for f in visible_files(self.path):
            if f.size % 2:
                raise ValueError(f"{f.path} holds {f.size} bytes: no whole number of 16-bit ids")
            out += [ByteRange(f.path, at, min(f.size, at + self.split)) for at in range(0, f.size, self.split)]
        return out

    def read(self, part: ByteRange) -> Iterator[pa.RecordBatch]:
        if part is None:  # no file at all
            return
        store, _ = located(self.path)
        with store.open_input_file(part.path) as f:
            at = part.start
            while at < part.stop:
                raw = f.read_at(min(2 * self.row, part.stop - at), at)
                tokens = pa.array(np.frombuffer(raw, "<u2").astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part.path]), pa.array([at // 2], pa.int64()),
                     pa.ListArray.from_arrays(pa.array([0, len(tokens)], pa.int32()), tokens)], names=["path", "offset", "tokens"])
                at += len(raw)


@dataclass
class _Written(WriterCommitMessage):
    files: list[tuple[str, str]]  # temporary name, final name


class _Writer(DataSourceArrowWriter):
    """Rows ``(shard_id, block, ids)``, those of a shard and block together and in stream order."""

    def __init__(self, options: dict, overwrite: bool):
        self.path, self.overwrite, self.job = options["path"], overwrite, uuid.uuid4().hex
        store, inside = located(self.path)
        if not overwrite and store.get_file_info(inside).type != fs.FileType.NotFound:
            raise FileExistsError(f"{self.path} is there already; write with mode overwrite")

    def _temporary(self) -> str:
        return posixpath.join(located(self.path)[1], "_temporary", self.job)

    def write(self, batches: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        store, _ = located(self.path)
        attempt = posixpath.join(self._temporary(), uuid.uuid4().hex)
        store.create_dir(attempt, recursive=True)
        files: dict[tuple[int, int], str] = {}
        out, key = None, None
        try:
            for batch in batches:
                keys = np.stack([batch.column("shard_id").to_numpy().astype(np.int64), batch.column("block").to_numpy().astype(np.int64)], axis=1)
                edges = np.flatnonzero(np.append(True, (keys[1:] != keys[:-1]).any(axis=1))) if len(keys) else []
                for a, b in zip(edges, [*edges[1:], len(keys)]):
                    if (own := tuple(keys[a].tolist())) != key:
                        if own in files:
                            raise ValueError(f"the rows of shard {own[0]}, block {own[1]} do not lie together")
                        if out is not None:
                            out.close()
                        key, files[own] = own, posixpath.join(attempt, f"{own[0]}-{own[1]}")
                        out = store.open_output_stream(files[own])
                    ids = np.asarray(batch.column("ids").slice(a, b - a).flatten())
                    if len(ids) and (ids.min() < 0 or ids.max() > 0xFFFF):
                        raise ValueError("an id does not fit 16 bits")
                    out.write(ids.astype("<u2").tobytes())
        finally:
            if out is not None:
                out.close()
        return _Written([(held, f"shard={s:05d}/part-{b:08d}{SUFFIX}") for (s, b), held in files.items()])

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        store, inside = located(self.path)
        done = [pair for m in messages if m is not None for pair in m.files]
        if len({final for _, final in done}) != len(done):
            self._clear()
            raise ValueError("rows of a shard and block were written by several tasks")
        if self.overwrite:
            for f in visible_files(self.path):
                store.delete_file(f.path)
        for folder in sorted({posixpath.dirname(final) for _, final in done}):
            store.create_dir(posixpath.join(inside, folder), recursive=True)
        for held, final in done:
            store.move(held, posixpath.join(inside, final))
        self._clear()
        with store.open_output_stream(posixpath.join(inside, "_SUCCESS")):
            pass

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        self._clear()

    def _clear(self) -> None:
        store, inside = located(self.path)
        for folder in (self._temporary(), posixpath.join(inside, "_temporary")):
            if store.get_file_info(folder).type == fs.FileType.Directory and (
                    folder == self._temporary() or not store.get_file_info(fs.FileSelector(folder))):
                store.delete_dir(folder)


class Uint16Shards(DataSource):
    """``spark.read.format("uint16shards")``: ``path, offset, tokens``; writing takes ``shard_id, block, ids``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "path string, offset bigint, tokens array<int>"

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader(self.options)

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        return _Writer(self.options, overwrite)


def register(spark: SparkSession) -> None:
    """Make the format known to a session and its executors."""
    from ..session import ship_package
    ship_package(spark)
    spark.dataSource.register(Uint16Shards)


def write_raw_shards(df: DataFrame, path: str, ids_col: str = "ids", arranged: bool = False) -> None:
    """Write ``(shard_id, block, doc_id, ids)`` as raw files, one a shard and block, documents in order.

    ``arranged`` rows lie by shard, block and document in their partitions already, no
    block in two of them (as ``prepare_dataset`` makes them); others are brought together
    first.  Rows without a ``block`` are cut into ranges.  Null ids write nothing; an id
    above 16 bits raises.  An older table at ``path`` is replaced when all files are written.
    """
    from ..operators.batches import ordered_blocks
    from ..session import scratch_path
    register(df.sparkSession)
    if "block" not in df.columns:
        held = scratch_path(df.sparkSession, "raw-rows")  # the rows are made once; counting and ranging read them
        df.write.parquet(held)
        rows = df.sparkSession.read.schema(df.schema).parquet(held)
        df, arranged = ordered_blocks(rows).sortWithinPartitions("shard_id", "doc_id"), True
    if not arranged:
        df = df.repartition("shard_id", "block").sortWithinPartitions("shard_id", "block", "doc_id")
    none = F.array().cast("array<int>")
    df.select(F.col("shard_id").cast("int").alias("shard_id"), F.col("block").cast("int").alias("block"),
              F.coalesce(F.col(ids_col).cast("array<int>"), none).alias("ids")).write.format(FORMAT).mode("overwrite").save(path)


def read_raw_shards(spark: SparkSession, path: str, split_bytes: int = SPLIT_BYTES, row_tokens: int = ROW_TOKENS) -> DataFrame:
    """Raw shard files as ``(path, offset, tokens ARRAY<INT>)``: runs of ids with their place in the file.

    Files end in ``.data``; names that begin with ``.`` or ``_`` are passed over.  Large files
    are read by several tasks.
    """
    register(spark)
    return (spark.read.format(FORMAT).option("splitBytes", split_bytes).option("rowTokens", row_tokens)
            .load(path if ":" in path.split("/")[0] else os.path.abspath(path)))


def stream_digests(rows: DataFrame, shard: Column) -> DataFrame:
    """``shard_id, n_tokens, ids_md5``: length and digest of each shard's ids, space-joined, from ``path, offset, tokens``.

    A digest follows its stream from the first id to the last, so a shard is one task's.  Its
    rows are sorted outside memory and run through the digest: no task holds a shard.
    """
    from ..session import ship_package
    ship_package(rows.sparkSession)
    said = rows.select(shard.alias("shard_id"), "path", "offset", F.size("tokens").cast("long").alias("n"), F.array_join("tokens", " ").alias("said"))
    ordered = said.where("shard_id is not null").repartition("shard_id").sortWithinPartitions("shard_id", "path", "offset")
    return ordered.select("shard_id", "n", "said").mapInArrow(_digests, "shard_id int, n_tokens long, ids_md5 string")


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    key, n, digest = None, 0, hashlib.md5()

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([key], pa.int32()), pa.array([n], pa.int64()), pa.array([digest.hexdigest()])],
                                          names=["shard_id", "n_tokens", "ids_md5"])

    for batch in batches:
        for own, size, text in zip(batch.column(0), batch.column(1), batch.column(2)):  # one text at a time
            if own.as_py() != key:
                if key is not None:
                    yield row()
                key, n, digest = own.as_py(), 0, hashlib.md5()
            elif size.as_py():
                digest.update(b" ")
            n += size.as_py()
            digest.update(text.as_buffer())
    if key is not None:
        yield row()
