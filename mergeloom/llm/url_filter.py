"""URL filters with Bloom filter cascades, in DataFrame operations only.

A rule is a host and a path prefix; it fits that host and its subdomains.  The keys that
a URL can match are the suffixes of its host, at label borders, joined to the prefixes of
its path, for the pairs of lengths that listed rules have: as many as there are such pairs,
however long the URL is.  Level 0 of a cascade encodes the listed keys; level 1 the
keys of the whole corpus that level 0 passes by mistake; level 2 the listed keys that
level 1 passes by mistake, and so on until a level makes no mistakes.  For every key of
that corpus the first level that does not hold it decides, so membership is exact and a
page is judged by bit tests alone: no join and no shuffle on the way of the rows.

Only the keys that pass level 0 are ever gathered, as a distributed table; the levels
themselves are bit arrays.  Lists for which a level would need more than ``max_bits`` are
too large to be sent to every task: their rules meet the pages' keys in an equi-join.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, let, written

WORD = 64
SALTS = 16


def _literal(longs: list[int]) -> Column:
    """A constant array of longs, folded once by the optimizer."""
    return F.split(F.lit(",".join(map(str, longs))), ",").cast("array<bigint>")


@dataclass
class Level:
    bits: int
    hashes: int
    words: list[int]

    def holds(self, key: Column, level: int) -> Column:
        """Whether the filter passes ``key``."""
        def all_bits(table: Column) -> Column:
            def bit(i: int) -> Column:
                at = F.pmod(F.xxhash64(F.lit(level), F.lit(i), key), F.lit(self.bits))
                word = F.get(table, F.floor(at / WORD).cast("int"))
                return F.getbit(word, F.pmod(at, F.lit(WORD)).cast("int")) == 1
            out = bit(0)
            for i in range(1, self.hashes):
                out = out & bit(i)
            return out

        return let(_literal(self.words), all_bits)  # the constant stands in the plan once


class TooLarge(ValueError):
    """A level would not fit ``max_bits``."""


def _build(keys: DataFrame, n: int, rate: float, level: int, max_bits: int) -> Level:
    """One Bloom filter over the distinct keys of ``keys`` (column ``key``)."""
    rate = min(0.5, max(rate, 1e-9))
    bits = WORD * max(1, math.ceil(n * -math.log(rate) / math.log(2) ** 2 / WORD))
    if bits > max_bits:
        raise TooLarge(f"a cascade level needs {bits} bits; the bound is {max_bits}")
    hashes = max(1, round(bits / max(1, n) * math.log(2)))
    hashes = min(hashes, 30)
    at = F.array(*[F.pmod(F.xxhash64(F.lit(level), F.lit(i), F.col("key")), F.lit(bits)) for i in range(hashes)])
    words = (keys.select(F.explode(at).alias("at"))
             .groupBy(F.floor(F.col("at") / WORD).cast("int").alias("word"))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(pmod(at, 64) as int))")).alias("held")).collect())  # bits / 64 rows
    out = [0] * (bits // WORD)
    for r in words:
        out[r["word"]] = r["held"]
    return Level(bits, hashes, out)


@dataclass
class Cascade:
    """Exact membership in a listed set for every key of the corpus it was built over."""
    levels: list[Level]

    def member(self, key: Column) -> Column:
        out = F.lit(len(self.levels) % 2 == 1)
        for i in range(len(self.levels) - 1, -1, -1):
            out = F.when(self.levels[i].holds(key, i), out).otherwise(F.lit(i % 2 == 1))
        return out


def build_cascade(listed: DataFrame, universe: DataFrame, max_bits: int = 1 << 26, max_levels: int = 40) -> Cascade:
    """A cascade for the keys of ``listed`` over the keys of ``universe`` (both: one column ``key``).

    Listed keys outside the universe are harmless.  An empty list gives a cascade without
    members.  Null keys are members of nothing.
    """
    listed = cut(listed.where("key is not null").distinct())
    n = listed.count()
    if n == 0:
        return Cascade([])
    total = universe.agg(F.approx_count_distinct("key").alias("n")).first()["n"]
    levels = [_build(listed, n, math.sqrt(0.5) * n / max(total, 2 * n), 0, max_bits)]
    passed = universe.where(F.col("key").isNotNull() & levels[0].holds(F.col("key"), 0)).distinct()
    wrong = cut(passed.join(listed, "key", "left_anti"))  # keys that only level 0 takes for listed
    inside, outside = listed, wrong
    for i in range(1, max_levels):
        n_out = outside.count()
        if n_out == 0:
            return Cascade(levels)
        levels.append(_build(outside, n_out, 0.5, i, max_bits))
        mistaken = cut(inside.where(levels[i].holds(F.col("key"), i)))
        inside, outside = outside, mistaken
    raise RuntimeError("the cascade did not end")


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty for null and where ``://`` is missing."""
    has = F.coalesce(F.contains(url, F.lit("://")), F.lit(False))
    rest = F.regexp_replace(url, "(?s)^.*?://", "")
    host = F.regexp_extract(rest, "(?s)^[^/?#]*", 0)
    path = F.regexp_extract(rest, "(?s)^[^/?#]*([^?#]*)", 1)
    low = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.when(has, low).otherwise(F.lit("")), F.when(has, path).otherwise(F.lit(""))


def candidate_keys(host: Column, path: Column, lengths: list[tuple[int, int]]) -> Column:
    """All rules that could fit: the host's suffixes at label borders joined to path prefixes, by the given lengths of both."""
    pairs = F.array(*[F.struct(F.lit(h).alias("h"), F.lit(p).alias("p")) for h, p in lengths])

    def fitting(host: Column, path: Column) -> Column:
        size, room = F.length(host), F.length(path)
        fits = F.filter(pairs, lambda x: (x["p"] <= room) & ((x["h"] == size) | ((x["h"] < size) & (F.substring(host, size - x["h"], F.lit(1)) == "."))))
        return F.transform(fits, lambda x: F.concat(F.substring(host, size - x["h"] + 1, x["h"]), F.substring(path, F.lit(1), x["p"])))

    return let(host, lambda h: let(path, lambda p: fitting(h, p)))


def rule_table(rules: list[str] | DataFrame, spark) -> DataFrame:
    """``key`` of a list of rules, or of a table of them (column ``rule``); nulls and rules without ``/`` are none."""
    if not isinstance(rules, DataFrame):
        rules = spark.range(1).select(F.explode(F.array(*[F.lit(r) for r in rules]).cast("array<string>")).alias("rule"))
    return rules.select(F.col("rule").alias("key")).where("instr(key, '/') > 0").distinct()


def judge(pages: DataFrame, block: list[str] | DataFrame, allow: list[str] | DataFrame, default: str = "allow",
          url: str = "url", max_bits: int = 1 << 26) -> DataFrame:
    """Every page with ``host``, ``path``, ``rule`` and ``verdict`` (``allow`` or ``block``).

    ``block`` and ``allow`` are rules ``host/path-prefix``, as lists or as tables with a
    column ``rule``, of any size: where a cascade does not fit ``max_bits``, an equi-join
    with the rules takes its place, with equal results.  The longest fitting rule
    decides (of equally long ones a blocking one, then the one with the longer host).
    Where no rule fits, ``rule`` is null and the verdict is ``default``: no cascade has
    the page.  Null URLs and URLs without ``://`` have empty parts and fit no rule that
    names a host.  URLs of any length and any number of labels are read whole.
    Repeated rows get equal verdicts, an empty table an empty result; clashing columns
    are replaced.
    """
    spark = pages.sparkSession
    blocking, allowing = cut(rule_table(block, spark)), cut(rule_table(allow, spark))
    shape = F.struct((F.instr("key", "/") - 1).alias("h"), (F.length("key") - F.instr("key", "/") + 1).alias("p"))
    # pairs of lengths: few, whatever the number of rules
    shapes = [(r.h, r.p) for r in blocking.union(allowing).select(shape.alias("s")).distinct().select("s.*").collect()]
    taken = {"host", "path", "rule", "verdict"}
    host, path = url_parts(F.col(f"`{url}`"))
    parts = pages.select(*[f"`{c}`" for c in pages.columns if c.lower() not in taken],
                         host.alias("host"), path.alias("path"))
    if not shapes:
        return parts.withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit(default)})
    keys = candidate_keys(F.col("host"), F.col("path"), sorted(shapes))
    universe = parts.select(F.explode(keys).alias("key"))
    try:
        blocked, allowed = (build_cascade(rules, universe, max_bits) for rules in (blocking, allowing))
    except TooLarge:
        return _verdicts(_joined_best(parts, keys, blocking, allowing), default)
    fits = F.filter(F.transform(keys, lambda k: F.struct(
        F.length(k).alias("n"), blocked.member(k).alias("block"), F.length(F.substring_index(k, "/", 1)).alias("host"),
        k.alias("rule"), allowed.member(k).alias("allow"))), lambda s: s["block"] | s["allow"])
    return _verdicts(parts.withColumn("__best", F.array_max(fits)), default)


def _verdicts(judged: DataFrame, default: str) -> DataFrame:
    return judged.withColumn("rule", F.col("__best.rule")).withColumn(
        "verdict", F.when(F.col("__best").isNull(), F.lit(default)).when(F.col("__best.block"), "block").otherwise("allow")
    ).drop("__best")


def _joined_best(parts: DataFrame, keys: Column, blocking: DataFrame, allowing: DataFrame) -> DataFrame:
    """``parts`` with the deciding rule as ``__best``, from a join of the pages' keys with the rules.

    A key that a third of the pages share is spread over ``SALTS`` copies of its rule, and
    only keys that are rules go on.
    """
    rows = written(parts.withColumn("__row", F.monotonically_increasing_id()), "url-rows")
    rules = blocking.withColumn("block", F.lit(True)).unionByName(allowing.withColumn("block", F.lit(False)))
    rules = rules.groupBy("key").agg(F.max("block").alias("block")).withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    asked = rows.select("__row", F.explode(keys).alias("key")).withColumn("__salt", F.pmod(F.xxhash64("__row"), F.lit(SALTS)).cast("int"))
    best = asked.join(rules, ["key", "__salt"]).groupBy("__row").agg(F.max(F.struct(
        F.length("key").alias("n"), "block", F.length(F.substring_index("key", "/", 1)).alias("host"), F.col("key").alias("rule"))).alias("__best"))
    return rows.join(best, "__row", "left").drop("__row")
