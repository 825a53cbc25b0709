"""Chat formatting with a prefix tree.

Conversations that share their initial turns are merged: sorted by the hashes of their
turns, equal beginnings are neighbours, and a walk in that order emits every turn that
the previous conversation does not share - the tree's nodes, depth first, each once.
Every node carries the position of its first token (the length of its ancestors) and
the intervals of its ancestors in the emitted stream, the only ones its tokens attend
to besides those before them in the node itself.  A token is one code point.

The order is a range partitioning, so a first turn that many conversations share is
spread over tasks.  A stream ends at the first conversation that reaches ``pack_chars``;
the next one repeats the turns on its path, marked as not ``fresh``, since attention
needs them in the same stream while their loss has been counted.

Template: ``<<SYS>>text<</SYS>>``, ``[INST] text [/INST]`` and ``text</s>`` for system,
user and assistant turns, ``<<ROLE>>role<</ROLE>>text<<END>>`` for others.  Inside texts
a backslash is set before every backslash and control string, which the reader takes
off again, so no text can be mistaken for a mark.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import takewhile

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import written

# --- fixed values of the template --------------------------------------------------------
CONTROL = ["<<SYS>>", "<</SYS>>", "[INST]", "[/INST]", "<s>", "</s>", "<<ROLE>>", "<</ROLE>>", "<<END>>"]
_MARKS = "|".join(re.escape(c) for c in CONTROL)
_ESCAPE = re.compile(rf"\\|{_MARKS}")
_READ = re.compile(rf"\\(?:\\|{_MARKS})|{_MARKS}|[^\\<\[]+|.", re.S)

PACK = T.StructType([
    T.StructField("text", T.StringType()),
    T.StructField("nodes", T.ArrayType(T.StructType([
        T.StructField("parent", T.IntegerType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType()),
        T.StructField("position", T.LongType()), T.StructField("loss_start", T.LongType()),
        T.StructField("loss_end", T.LongType()), T.StructField("fresh", T.BooleanType()),
        T.StructField("attends", T.ArrayType(T.StructType([T.StructField("start", T.LongType()),
                                                           T.StructField("end", T.LongType())])))]))),
    T.StructField("leaves", T.ArrayType(T.StructType([T.StructField("conversation", T.StringType()),
                                                      T.StructField("node", T.IntegerType())])))])


def escape(text: str) -> str:
    return _ESCAPE.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return "".join(t[1:] if len(t) > 1 and t[0] == "\\" else t for t in _READ.findall(text))


def format_turn(role: str, text: str) -> tuple[str, int, int]:
    """The turn between its marks, and where its text stands under the loss mask (0, 0: nowhere)."""
    body = escape(text)
    if role == "system":
        return f"<<SYS>>{body}<</SYS>>", 0, 0
    if role == "user":
        return f"[INST] {body} [/INST]", 0, 0
    if role == "assistant":
        return f"{body}</s>", 0, len(body)
    return f"<<ROLE>>{escape(role)}<</ROLE>>{body}<<END>>", 0, 0


def parse(formatted: str) -> list[tuple[str, str]]:
    """Roles and texts of a formatted conversation."""
    turns, role, held = [], "", []
    for t in _READ.findall(formatted):
        if t not in CONTROL:
            held.append(t[1:] if len(t) > 1 and t[0] == "\\" else t)
            continue
        said = "".join(held)
        if t == "<</ROLE>>":
            role = said
        elif t == "<</SYS>>":
            turns.append(("system", said))
        elif t == "[/INST]":
            turns.append(("user", said[1:-1]))
        elif t == "<<END>>":
            turns.append((role, said))
        elif t == "</s>":
            turns.append(("assistant", said))
        held = []
    return turns


class _Stream:
    """One emitted stream: text, nodes and the path of the conversation emitted last."""

    def __init__(self):
        self.parts, self.length, self.nodes, self.leaves, self.path = [], 0, [], [], []

    def add(self, name: str, turns: list[tuple[str, str]], known: int) -> None:
        """Emit a conversation; its first ``known`` turns have been emitted in an earlier stream."""
        shared = 0
        while shared < min(len(turns), len(self.path)) and self.path[shared][0] == turns[shared]:
            shared += 1
        del self.path[shared:]
        for depth in range(shared, len(turns)):
            segment, a, b = format_turn(*turns[depth])
            parent = self.path[-1][1] if self.path else -1
            attends, position = [], 0
            if parent >= 0:
                up = self.nodes[parent]
                position = up["position"] + up["end"] - up["start"]
                attends = list(up["attends"])
                if attends and attends[-1]["end"] == up["start"]:
                    attends[-1] = {"start": attends[-1]["start"], "end": up["end"]}
                else:
                    attends.append({"start": up["start"], "end": up["end"]})
            start = self.length
            self.nodes.append({"parent": parent, "start": start, "end": start + len(segment), "position": position,
                               "loss_start": start + a, "loss_end": start + b, "fresh": depth >= known, "attends": attends})
            self.parts.append(segment)
            self.length += len(segment)
            self.path.append((turns[depth], len(self.nodes) - 1))
        self.leaves.append({"conversation": name, "node": self.path[-1][1] if self.path else -1})

    def row(self) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([{"text": "".join(self.parts), "nodes": self.nodes, "leaves": self.leaves}],
                                          schema=_pack_schema())


def _pack_schema() -> pa.Schema:
    span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
    node = pa.struct([("parent", pa.int32()), ("start", pa.int64()), ("end", pa.int64()), ("position", pa.int64()),
                      ("loss_start", pa.int64()), ("loss_end", pa.int64()), ("fresh", pa.bool_()), ("attends", pa.list_(span))])
    leaf = pa.struct([("conversation", pa.string()), ("node", pa.int32())])
    return pa.schema([("text", pa.string()), ("nodes", pa.list_(node)), ("leaves", pa.list_(leaf))])


def conversations_of(rows: DataFrame) -> DataFrame:
    """``(conv_id, conversation, turns)``: turns in order, ``conversation`` the digest of roles and texts.

    Rows are ordered by turn, then role, then text (null turns first); null roles and
    texts count as empty; rows with a null ``conv_id`` form one conversation.  One
    conversation is one record, held by one task, as its formatted text has to be.
    """
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    grouped = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("all"))
    turns = F.transform("all", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    return grouped.select("conv_id", turns.alias("turns")).select(
        "conv_id", F.sha2(F.to_json("turns"), 256).alias("conversation"), "turns")


def pack(convs: DataFrame, pack_chars: int = 1 << 18) -> DataFrame:
    """Streams (``text``, ``nodes``, ``leaves``) of the distinct conversations of ``conversations_of``, a written table.

    A task does not see where the range before its own ends: it notes the digests of its
    first and last paths, and the turns that the two paths at a border share are marked as
    not fresh when the table is read.
    """
    distinct = convs.groupBy("conversation").agg(F.first("turns").alias("turns"))
    path = F.transform("turns", lambda t: F.xxhash64(t["role"], t["text"]))
    ordered = distinct.withColumn("path", path).repartitionByRange("path", "conversation").sortWithinPartitions("path", "conversation")

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream, last, number = _Stream(), [], 0
        part, head = TaskContext.get().partitionId(), None
        for batch in batches:
            for name, turns in zip(batch.column("conversation").to_pylist(), batch.column("turns").to_pylist()):
                turns = [(t["role"], t["text"]) for t in turns]
                known, head = 0, turns if head is None else head
                if stream.length >= pack_chars:
                    yield _numbered(stream, part, number, head, None)
                    stream, number = _Stream(), number + 1
                    while known < min(len(last), len(turns)) and last[known] == turns[known]:
                        known += 1
                stream.add(name, turns, known)
                last = turns
        if stream.leaves:
            yield _numbered(stream, part, number, head, last)

    kind = T.StructType([*PACK.fields, *_PLACE.fields])
    packs = written(ordered.select("conversation", "turns").mapInArrow(walk, kind), "packs")
    ends = packs.where("head is not null or tail is not null").select("part", "head", "tail").collect()  # two rows a task
    heads, tails = ({r["part"]: r[c] for r in ends if r[c] is not None} for c in ("head", "tail"))
    parts = sorted(heads)
    known = [(p, sum(1 for _ in takewhile(lambda x: x[0] == x[1], zip(tails[q], heads[p])))) for q, p in zip(parts, parts[1:])]
    border = packs.sparkSession.createDataFrame([x for x in known if x[1]], "part int, known int")
    nodes = F.transform("nodes", lambda n, i: n.withField("fresh", n["fresh"] & ~((F.col("number") == 0) & (i < F.col("known")))))
    return packs.join(F.broadcast(border), "part", "left").select(
        "text", F.when(F.col("known").isNull(), F.col("nodes")).otherwise(nodes).alias("nodes"), "leaves")


_PLACE = T.StructType([T.StructField("part", T.IntegerType()), T.StructField("number", T.IntegerType()),
                       T.StructField("head", T.ArrayType(T.StringType())), T.StructField("tail", T.ArrayType(T.StringType()))])


def _numbered(stream: _Stream, part: int, number: int, head: list[tuple], tail: list[tuple] | None) -> pa.RecordBatch:
    """The stream with its place: its task, its number there, and the digests of the task's first and last paths."""
    row, text_list = stream.row(), pa.list_(pa.string())
    digests = lambda turns: None if turns is None else [hashlib.sha256(repr(t).encode("utf-8", "surrogatepass")).hexdigest() for t in turns]
    return pa.RecordBatch.from_arrays(
        [*row.columns, pa.array([part], pa.int32()), pa.array([number], pa.int32()),
         pa.array([digests(head if number == 0 else None)], text_list), pa.array([digests(tail)], text_list)],
        names=[*row.schema.names, *_PLACE.names])


def position_ids(packs: DataFrame) -> DataFrame:
    """``packs`` with ``position_ids``, one a token of the stream."""
    ids = F.flatten(F.transform(F.filter("nodes", lambda n: n["end"] > n["start"]), lambda n: F.sequence(
        n["position"], n["position"] + n["end"] - n["start"] - 1)))
    return packs.withColumn("position_ids", ids)


def read_back(packs: DataFrame) -> DataFrame:
    """What each packed conversation says, read from the streams alone.

    One row a distinct conversation: ``conversation, n_turns, turns_sha256, loss_chars,
    loss_sha256, formatted_chars``.  A conversation's text is what its last node attends
    to and the node itself.
    """
    kind = T.StructType([T.StructField("conversation", T.StringType()), T.StructField("n_turns", T.LongType()),
                         T.StructField("turns_sha256", T.StringType()), T.StructField("loss_chars", T.LongType()),
                         T.StructField("loss_sha256", T.StringType()), T.StructField("formatted_chars", T.LongType())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for i in range(batch.num_rows):
                text, nodes = batch.column("text")[i].as_py(), batch.column("nodes")[i].as_py()
                for leaf in batch.column("leaves")[i].as_py():
                    at, own, losses = leaf["node"], [], []
                    if at >= 0:
                        own = [*nodes[at]["attends"], nodes[at]]
                    while at >= 0:
                        losses.append(text[nodes[at]["loss_start"]:nodes[at]["loss_end"]])
                        at = nodes[at]["parent"]
                    formatted = "".join(text[s["start"]:s["end"]] for s in own)
                    turns = parse(formatted)
                    loss = "".join(unescape(x) for x in reversed(losses))
                    said = "".join(f"{r}\n{t}\n" for r, t in turns)
                    out.append((leaf["conversation"], len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss),
                                hashlib.sha256(loss.encode()).hexdigest(), len(formatted)))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=kind.names)

    return packs.mapInArrow(read, kind)


def format_conversations(rows: DataFrame, pack_chars: int = 1 << 18) -> tuple[DataFrame, DataFrame]:
    """``(members, packs)``: every conversation's id and digest, and the streams of the distinct ones.

    ``rows`` has ``conv_id, turn, role, text``; other columns are not carried.  Both
    results are written tables.  An empty table gives empty results.
    """
    convs = written(conversations_of(rows.select("conv_id", "turn", "role", "text")), "conversations")
    return convs.select("conv_id", "conversation"), pack(convs, pack_chars)
