"""Structured Streaming forms (ST1, ST2, ST3).

* ST1 ``encode_stream``: stateless and narrow, the same JVM pre-tokenizer and
  Arrow encoder as batch encoding; rows of a stream are documents.
  ``encode_lines_stream`` encodes texts that arrive line by line: the state of a text is
  the white space and the unfinished word at its end, a row of a table beside the checkpoint.
* ST2 ``count_words_stream``: running pre-token counts (update / complete mode);
  new files add to the old totals in the state store.
* ST3 ``batch_stream``: the batch table pulled in ``batch_id`` order, one
  partition at a time, with prefetch (a consumer's iterator: rows reach the driver).

Sinks are parquet folders (or a ``foreachBatch`` writer) in the session's shared
checkpoint folder, never the driver.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.encode import encode
from ..operators.pretokenize import pretoken_array
from ..plans.train import BPEModel
from ..session import delete_path, scratch_path


def stream_table(spark: SparkSession, folder: str, schema: str, glob: str = "*.parquet", max_files: int | None = None) -> DataFrame:
    """A streaming scan of the parquet files of ``folder`` that match ``glob``; new files are picked
    up as they land.  ``max_files`` bounds the files of a micro-batch (default: all that are there).
    Where ``glob`` names a folder, as a table of several files is one, its files are scanned."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder, glob)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(path) and fs.getFileStatus(path).isDirectory():
        folder, glob = path.toString(), "*.parquet"
    reader = spark.readStream.schema(schema).option("pathGlobFilter", glob)
    return (reader.option("maxFilesPerTrigger", max_files) if max_files else reader).parquet(folder)


def encode_stream(stream: DataFrame, model: BPEModel, out_path: str, text_col: str = "text",
                  keep: Sequence[str] = ("doc_id",), checkpoint: str | None = None, available_now: bool = True):
    """ST1: encode every arriving document and append ``(keep…, ids)`` to ``out_path``."""
    spark = stream.sparkSession
    enc = encode(stream.select(*keep, text_col), model, text_col).select(*keep, "ids")
    w = (enc.writeStream.format("parquet").option("path", out_path)
         .option("checkpointLocation", checkpoint or scratch_path(spark, "st1-ckpt")).outputMode("append"))
    w = w.trigger(availableNow=True) if available_now else w
    return w.start()


# A pre-token holds white space only at its start (one blank) or nowhere else, so a place
# with white space behind it and none before ends a pre-token whatever follows.  The last
# such place of a text is looked for from its end.
BORDER = re.compile(r"(?s:.*)(?<=[^\s\x00-\x20\x7f-\xa0\u1680\u180e\u2000-\u200f\u2028-\u202f\u205f\u3000\ufeff])[ \t\n\r\x0b\x0c]")


def last_border(text: str, most: int) -> int:
    """The last place up to ``most`` that ends a pre-token, or 0."""
    found = BORDER.match(text, 0, max(most + 1, 0))
    return found.end() - 1 if found else 0


def settled(text: str, specials: Sequence[str]) -> int:
    """Length of the longest known-final part of a text that may go on: its pre-tokens can change no more.

    Specials that hold white space are neither cut nor, at the end, begun.
    """
    wide = [s for s in specials if any(c.isspace() for c in s)]
    at = last_border(text, len(text) - max((len(s) - 1 for s in wide), default=0))
    while at > 0 and wide:
        over = [i for s in wide for i in range(max(0, at - len(s) + 1), at) if text.startswith(s, i)]
        if not over:
            break
        at = last_border(text, min(over))
    return at


class _Text:
    """A text between two micro-batches: its unsettled end, the number of the line that comes next, its pieces so far, the lines that wait."""

    def __init__(self, key):
        self.key, self.grown, self.due, self.pieces, self.done = key, [""], 0, 0, False
        self.waiting: list[tuple] = []

    def add(self, n, t, z, due, pieces) -> None:
        """The state row first (``n`` is null), then lines by number; of equal numbers the first counts."""
        if n is None:
            self.grown, self.due, self.pieces = [t], due, pieces
        elif self.done or n < self.due or (self.waiting and self.waiting[-1][0] == n):
            return
        elif n > self.due:
            self.waiting.append((n, t, z))
        else:
            self.grown += ["\n", t] if n else [t]
            self.due, self.done = n + 1, z

    def rows(self, specials: Sequence[str]) -> Iterator[tuple]:
        """``state, n, t, z, due, pieces`` of the piece that is settled now, if any, and of what the text keeps."""
        end = "".join(self.grown)
        cut = len(end) if self.done else settled(end, specials)
        if cut or (self.done and not self.pieces):
            yield False, None, end[:cut], None, None, self.pieces
        if not self.done:
            yield True, None, end[cut:], None, self.due, self.pieces + (cut > 0)
            for n, t, z in self.waiting:
                yield True, n, t, z, None, None


SETTLED_CHARS = 1 << 22  # characters of the rows that a task gives back at once


def settle_lines(rows: DataFrame, specials: Sequence[str], key: str = "doc_id") -> DataFrame:
    """``key, state, n, t, z, due, pieces``: what is settled of each text (``state`` false) and what it keeps.

    ``rows`` are the lines of a micro-batch (``key, n, t, z``) and the state rows of the one
    before.  They meet sorted by text and number, so that a task goes over them once, holds
    one text and calls nothing for each text; rows may repeat, order and keys may be anything.
    """
    from ..session import ship_package
    ship_package(rows.sparkSession)
    named, fields = tuple(specials), ("state", "n", "t", "z", "due", "pieces")
    kind = rows.schema[key].dataType

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        text, made, size, like = None, [], 0, None

        def batch() -> pa.RecordBatch:
            keys = pa.array([r[0] for r in made], like)
            rest = [pa.array([r[i + 1] for r in made], t) for i, t in enumerate((pa.bool_(), pa.int64(), pa.string(), pa.bool_(), pa.int64(), pa.int64()))]
            return pa.RecordBatch.from_arrays([keys, *rest], names=[key, *fields])

        def end() -> int:
            before = len(made)
            made.extend((text.key, *r) for r in text.rows(named))
            return sum(len(r[3]) + 64 for r in made[before:])

        for b in batches:
            like = b.schema.field(key).type
            for k, n, t, z, due, pieces in zip(*(b.column(c).to_pylist() for c in (key, "n", "t", "z", "due", "pieces"))):
                if text is None or not (k == text.key or (k != k and text.key != text.key)):
                    if text is not None:
                        size += end()
                        if size > SETTLED_CHARS:
                            yield batch()
                            made, size = [], 0
                    text = _Text(k)
                text.add(n, t, z, due, pieces)
        if text is not None:
            end()
            yield batch()

    ordered = rows.repartition(key).sortWithinPartitions(key, "n", F.col("state").desc(), "t", "z").select(key, "n", "t", "z", "due", "pieces")
    return ordered.mapInArrow(settle, f"{key} {kind.simpleString()}, state boolean, n long, t string, z boolean, due long, pieces long")


def encode_lines_stream(lines: DataFrame, model: BPEModel, out_path: str, key: str = "doc_id", order: str = "line_no",
                        line: str = "line", last: str = "is_last", checkpoint: str | None = None, available_now: bool = True):
    """ST1 on lines: append ``(key, piece_no, ids)`` of texts that arrive line by line.

    ``lines`` (a stream) holds a text's lines without their ends, numbered from 0; ``last``
    marks its last one.  Lines may come in any order and in any micro-batch: those that
    run ahead wait.  The state of a text is its unsettled end, the number of the line that
    comes next and the lines that wait; it goes with the last line.  Repeated lines and
    lines behind the last are passed over; a null line is an empty one.  The ids of a
    text's pieces, in order, are those of the whole text: it is cut only where the
    pre-tokens on both sides stand alone.

    The states are a table beside the query's checkpoint, written anew by each micro-batch
    (at the cost of the unfinished texts), not held in memory.  A micro-batch writes its
    pieces into a folder of its own; one that runs again reads the same state and replaces both.
    """
    spark, place = lines.sparkSession, checkpoint or scratch_path(lines.sparkSession, "st1-lines-ckpt")
    texts = f"{place}/texts"
    kind = lines.schema[key].dataType.simpleString()
    table = f"{key} {kind}, n long, t string, z boolean, due long, pieces long"
    empty = F.lit(None).cast("long")
    rows = lines.select(key, F.col(order).cast("long").alias("n"), F.coalesce(F.col(line), F.lit("")).alias("t"),
                        F.coalesce(F.col(last), F.lit(False)).alias("z"), empty.alias("due"), empty.alias("pieces"), F.lit(False).alias("state"))

    def sink(batch: DataFrame, epoch: int) -> None:
        rows = batch.where("n is not null")
        if epoch:
            if epoch - 1 not in _epochs(spark, texts, upto=epoch - 1):
                raise RuntimeError(f"the states of the micro-batch before are not in {texts}")
            before = batch.sparkSession.read.schema(table).parquet(f"{texts}/epoch={epoch - 1}/state=true")
            rows = rows.unionByName(before.withColumn("state", F.lit(True)))
        settle_lines(rows, model.specials, key).write.mode("overwrite").partitionBy("state").parquet(f"{texts}/epoch={epoch}")
        for part in ("state=true", "state=false"):  # also where there are none
            _folder(spark, f"{texts}/epoch={epoch}/{part}")
        pieces = spark.read.schema(table).parquet(f"{texts}/epoch={epoch}/state=false").select(key, F.col("pieces").alias("piece_no"), F.col("t").alias("text"))
        encode(pieces, model, "text").select(key, "piece_no", "ids").write.mode("overwrite").parquet(f"{out_path}/epoch={epoch}")
        for old in _epochs(spark, texts, upto=epoch - 1):
            delete_path(spark, f"{texts}/epoch={old}/state=false" if old == epoch - 1 else f"{texts}/epoch={old}")

    _folder(spark, out_path)
    w = rows.writeStream.foreachBatch(sink).option("checkpointLocation", place)
    w = w.trigger(availableNow=True) if available_now else w
    return w.start()


def _folder(spark: SparkSession, path: str) -> None:
    """Make ``path`` if it is not there."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(p)


def joined_pieces(pieces: DataFrame, key: str = "doc_id") -> DataFrame:
    """``key, ids``: the ids of each text's pieces, in order."""
    return pieces.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("piece_no", "ids"))).alias("_p")).select(
        key, F.flatten(F.transform("_p", lambda p: p["ids"])).alias("ids"))


def count_words_stream(stream: DataFrame, out_path: str, text_col: str = "text",
                       specials: Sequence[str] | None = None, checkpoint: str | None = None,
                       available_now: bool = True, compact_every: int = 32):
    """ST2: running ``(word, freq)`` kept in the state store (update mode).

    Each micro-batch writes only the words whose totals changed, into a folder of its own
    (a replayed batch replaces it); every ``compact_every`` batches the folders so far
    become one table of totals.  :func:`running_counts` reads the newest such table and
    the batches after it.
    """
    spark = stream.sparkSession
    counts = (stream.select(F.explode(pretoken_array(text_col, specials)).alias("word"))
              .groupBy("word").agg(F.count(F.lit(1)).alias("freq")))

    def sink(batch: DataFrame, epoch: int) -> None:
        batch.select("word", "freq").write.mode("overwrite").parquet(f"{out_path}/changed/epoch={epoch}")
        if (epoch + 1) % compact_every == 0:
            running_counts(spark, out_path, upto=epoch).write.mode("overwrite").parquet(f"{out_path}/totals/epoch={epoch}")
            base = _epochs(spark, f"{out_path}/totals", upto=epoch)[-1]
            for kind in ("changed", "totals"):
                for old in _epochs(spark, f"{out_path}/{kind}", upto=base - (kind == "totals")):
                    delete_path(spark, f"{out_path}/{kind}/epoch={old}")

    w = (counts.writeStream.outputMode("update").foreachBatch(sink)
         .option("checkpointLocation", checkpoint or scratch_path(spark, "st2-ckpt")))
    w = w.trigger(availableNow=True) if available_now else w
    return w.start()


def _epochs(spark: SparkSession, folder: str, upto: int | None = None) -> list[int]:
    """Complete batch folders below ``folder``, in order."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    path = hadoop.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    done = [int(s.getPath().getName().partition("=")[2]) for s in fs.listStatus(path)
            if fs.exists(hadoop.Path(s.getPath(), "_SUCCESS"))]
    return sorted(e for e in done if upto is None or e <= upto)


def running_counts(spark: SparkSession, out_path: str, upto: int | None = None) -> DataFrame:
    """Latest total of every word written by :func:`count_words_stream`."""
    base = _epochs(spark, f"{out_path}/totals", upto)[-1:]
    later = [e for e in _epochs(spark, f"{out_path}/changed", upto) if not base or e > base[0]]
    parts = [(f"{out_path}/totals/epoch={e}", e) for e in base] + [(f"{out_path}/changed/epoch={e}", e) for e in later]
    rows = None
    for path, epoch in parts:  # at most compact_every of them
        part = spark.read.schema("word string, freq bigint").parquet(path).withColumn("epoch", F.lit(epoch).cast("long"))
        rows = part if rows is None else rows.unionByName(part)
    if rows is None:
        return spark.createDataFrame([], "word string, freq bigint")
    return rows.groupBy("word").agg(F.max_by("freq", "epoch").alias("freq"))


def batch_stream(batches: DataFrame, cols: Sequence[str] = ("batch_id", "row_in_batch", "input_ids", "target_ids")) -> Iterator:
    """ST3: rows of the batch table in (batch_id, row) order, streamed to the consumer
    a partition at a time with the next partition prefetched."""
    ordered = batches.select(*cols).repartitionByRange("batch_id").sortWithinPartitions("batch_id", "row_in_batch")
    return ordered.toLocalIterator(prefetchPartitions=True)


def run_to_end(query) -> None:
    """Wait for an ``availableNow`` query and surface its error, if any."""
    query.awaitTermination()
    exc = query.exception()
    if exc is not None:
        raise RuntimeError(str(exc))
