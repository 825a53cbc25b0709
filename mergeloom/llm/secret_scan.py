"""Secret scans with multipart credential linking, in DataFrame operations only.

Strong findings stand by themselves: assignments to secret-like names, access
identifiers, long hexadecimal runs.  Weak candidates say nothing alone: a mixed-case
token of key length may be any identifier, an endpoint is no secret.  They are reported
only where complementary parts meet within a scope of ``reach`` code points: a secret
near an access identifier, an endpoint near both an access identifier and a secret.
The scopes are met in an interval join: spans are dealt to cells of ``reach`` code
points of their document and equal cells are joined under the exact distance.

Positions are code points, ends exclusive.  They come from the pieces between matches,
so each text is read by each pattern once, and a second time only where it matches.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, without, written


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


# --- fixed values: the kinds, in the order in which equal starts are listed -----------
NAMES = ["password", "passwd", "secret", "token", "api_key", "apikey"]
KINDS = ["assign", "access", "hex", "secret", "endpoint"]
ASSIGN = ("(?:" + "|".join(_either_case(w) for w in NAMES)
          + ")[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
ACCESS = "AKIA[A-Z0-9]+"
HEX = "[0-9a-f]+"
WEAK_SECRET = "[A-Za-z0-9+/]{32,}"
ENDPOINT = "[a-z][a-z0-9+]*://[A-Za-z0-9.:_/@-]+"
MIN_ASSIGN, MIN_ACCESS, MIN_HEX = 12, 18, 16
BLOCK = 256
ADDED = ["strong", "weak", "ends", "k1", "k2", "base", "spans"]
SPAN = "array<struct<start:bigint,kind:int,end:bigint>>"


def running(values: Column, combine: Callable[[Column, Column], Column]) -> Column:
    """Running sums or maxima of an array of longs from 0 up, in blocks, so that long arrays cost no square."""
    zero, none = F.lit(0).cast("bigint"), F.array().cast("array<bigint>")

    def fold(part: Column, first: Column) -> Column:
        init = F.struct(first.alias("now"), none.alias("out"))
        return F.aggregate(part, init, lambda acc, x: F.struct(
            combine(acc["now"], x).alias("now"), F.concat(acc["out"], F.array(combine(acc["now"], x))).alias("out")),
            lambda acc: acc["out"])

    def blocked(a: Column) -> Column:
        places = F.sequence(F.lit(0), F.floor((F.size(a) - 1) / BLOCK).cast("int"))
        part = lambda j: F.slice(a, j * BLOCK + 1, F.lit(BLOCK))
        whole = F.transform(places, lambda j: F.aggregate(part(j), zero, combine))
        return let(fold(whole, zero), lambda upto: F.flatten(
            F.transform(places, lambda j: fold(part(j), F.when(j > 0, F.get(upto, j - 1)).otherwise(zero)))))

    return let(values, lambda a: F.when(F.size(a) == 0, none).when(
        F.size(a) <= BLOCK, fold(a, zero)).otherwise(blocked(a)))


def matches(text: Column, pattern: str, kind: int, passes) -> Column:
    """Spans of the leftmost non-overlapping matches of ``pattern`` for which ``passes(match)`` holds."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    def located(m: Column) -> Column:
        between = F.split(text, pattern, -1)
        steps = F.zip_with(F.transform(between, lambda p: F.length(p).cast("bigint")),
                           F.concat(F.array(F.lit(0).cast("bigint")), F.transform(m, lambda x: F.length(x).cast("bigint"))),
                           lambda p, x: p + x)
        spans = F.zip_with(m, running(F.slice(steps, 1, F.size(m)), lambda x, y: x + y), lambda x, s: F.struct(
            s.alias("start"), F.lit(kind).alias("kind"), (s + F.length(x)).alias("end"), passes(x).alias("ok")))
        return F.transform(F.filter(spans, lambda s: s["ok"]),
                           lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))

    return let(found, lambda m: F.when(F.exists(m, passes), located(m)).otherwise(F.array().cast(SPAN))).cast(SPAN)


def scan(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Each row with the arrays ``strong``, ``weak`` and ``ends`` of spans, and the key pair of its text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    none = F.array().cast(SPAN)
    strong = F.concat(
        matches(text, ASSIGN, 0, lambda m: F.length(F.regexp_extract(m, ASSIGN, 1)) >= MIN_ASSIGN),
        F.when(F.contains(text, F.lit("AKIA")), matches(text, ACCESS, 1, lambda m: F.length(m) >= MIN_ACCESS)).otherwise(none),
        matches(text, "[0-9a-f]{%d,}" % MIN_HEX, 2, lambda m: F.lit(True)))
    has_access = F.exists(F.col("strong"), lambda s: s["kind"] == 1)
    mixed = lambda m: m.rlike("[A-Z]") & m.rlike("[a-z]") & m.rlike("[0-9]") & ~m.startswith("AKIA")
    kept = without(docs, ADDED)
    kept = kept.select(*[f"`{c}`" for c in kept.columns if keep is None or c in keep], text.alias("__text"),
                       F.array_sort(strong).alias("strong"))
    return kept.select(
        *[f"`{c}`" for c in kept.columns if c != "__text"],
        F.when(has_access, matches(F.col("__text"), WEAK_SECRET, 3, mixed)).otherwise(none).alias("weak"),
        F.when(has_access & F.contains("__text", F.lit("://")),
               matches(F.col("__text"), ENDPOINT, 4, lambda m: F.lit(True))).otherwise(none).alias("ends"),
        F.xxhash64(F.lit(1), "__text").alias("k1"),
        (F.xxhash64(F.lit(2), F.col("doc_id"), F.col("__text")) if "doc_id" in docs.columns
         else F.xxhash64(F.lit(2), "__text")).alias("k2"))


def _cells(spans: DataFrame, reach: int, margin: int) -> DataFrame:
    """One row for every cell of ``reach`` code points that a span, widened by ``margin``, touches.

    A neighbour at a gap of exactly ``margin`` may lie just outside the widened span, so one code point more is taken.
    """
    first = F.floor((F.col("start") - margin - 1) / reach)
    last = F.floor((F.col("end") + margin) / reach)
    return spans.withColumn("cell", F.explode(F.sequence(first, last)))


def _near(left: DataFrame, right: DataFrame, reach: int, how: str, gap: int) -> DataFrame:
    """Rows of ``left`` with (or, ``left_anti``, without) a row of ``right`` at most ``gap`` code points away."""
    a = _cells(left, reach, 0).alias("a")
    b = _cells(right.select("k1", "k2", "start", "end"), reach, gap).alias("b")
    close = (F.col("a.start") <= F.col("b.end") + gap) & (F.col("a.end") >= F.col("b.start") - gap)
    on = [F.col(f"a.{c}") == F.col(f"b.{c}") for c in ("k1", "k2", "cell")] + [close]
    if how == "left_anti":  # every cell of a span has to be free
        bad = a.join(b, on, "left_semi").select("k1", "k2", "kind", "start", "end").distinct()
        return left.join(bad, ["k1", "k2", "kind", "start", "end"], "left_anti")
    return a.join(b, on, "left_semi").select("k1", "k2", "kind", "start", "end").distinct()


def link(scanned: DataFrame, reach: int = 200) -> DataFrame:
    """Weak candidates that complementary parts confirm: ``k1, k2, kind, start, end``, one row each."""
    able = scanned.where((F.size("weak") > 0) | (F.size("ends") > 0))
    rows = lambda c: able.select("k1", "k2", F.explode(c).alias("s")).select("k1", "k2", "s.kind", "s.start", "s.end").distinct()
    strong, weak, ends = rows("strong"), rows("weak"), rows("ends")
    access = strong.where("kind = 1")
    secrets = _near(_near(weak, strong.where("kind < 2"), reach, "left_anti", -1), access, reach, "left_semi", reach)
    sure = strong.where("kind = 0").unionByName(secrets)
    points = _near(_near(ends, access, reach, "left_semi", reach), sure, reach, "left_semi", reach)
    return secrets.unionByName(points)


def find_secrets(docs: DataFrame, reach: int = 200, keep: list[str] | None = None) -> DataFrame:
    """Every row with ``base`` (strong spans) and ``spans`` (those and the confirmed weak ones).

    Both are arrays of ``(start, kind, end)`` in order of start, then kind (numbers into
    ``KINDS``).  A null text counts as empty; empty texts have no spans; repeated rows get
    equal spans; an empty table gives an empty result; clashing columns are replaced;
    texts of any length are scanned whole.
    Only rows that hold an access identifier beside weak candidates meet a shuffle.
    """
    scanned = written(scan(docs, keep), "secrets")
    able = (F.size("weak") > 0) | (F.size("ends") > 0)
    own = [f"`{c}`" for c in scanned.columns if c not in ("strong", "weak", "ends", "k1", "k2")]
    plain = scanned.where(~able).select(*own, F.col("strong").alias("base"), F.col("strong").alias("spans"))
    added = link(scanned, reach).groupBy("k1", "k2").agg(
        F.collect_list(F.struct("start", "kind", "end")).alias("added"))  # of one text
    rest = scanned.where(able).join(added, ["k1", "k2"], "left").select(
        *own, F.col("strong").alias("base"),
        F.when(F.col("added").isNull(), F.col("strong")).otherwise(
            F.array_sort(F.concat("strong", F.col("added").cast(SPAN)))).alias("spans"))
    return plain.unionByName(rest)


def spelled(spans: Column | str) -> Column:
    """Spans as ``kind:start:end``, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    spans = F.col(spans) if isinstance(spans, str) else spans
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(found: DataFrame, mark: str = "[REDACTED]") -> DataFrame:
    """Rows of ``find_secrets`` with every span of the text replaced by ``mark``; ``base`` and ``spans`` go.

    Overlapping and touching spans become one mark.  Texts without spans, null ones too,
    stay as they are.  The text is cut into blocks once and each kept piece is taken from
    the blocks that it touches, so the work grows with the text and not with text times spans.
    """
    size = 1 << 12

    def piece(blocks: Column, a: Column, b: Column) -> Column:
        of_block = lambda j: F.get(blocks, j.cast("int")).substr(
            F.greatest(a - j * size, F.lit(0)).cast("int") + 1,
            (F.least(b - j * size, F.lit(size)) - F.greatest(a - j * size, F.lit(0))).cast("int"))
        places = F.sequence(F.floor(a / size), F.floor((b - 1) / size))
        return F.when(b > a, F.array_join(F.transform(places, of_block), "")).otherwise(F.lit(""))

    def joined(blocks: Column, upto: Column) -> Column:
        before = F.concat(F.array(F.lit(-1).cast("bigint")), F.slice(upto, 1, F.size(upto) - 1))
        parts = F.zip_with("spans", before, lambda s, p: F.when(s["start"] > p, F.concat(
            piece(blocks, F.greatest(p, F.lit(0).cast("bigint")), s["start"]), F.lit(mark))).otherwise(F.lit("")))
        return F.concat(F.array_join(parts, ""), piece(blocks, F.element_at(upto, -1), F.length("text").cast("bigint")))

    done = let(F.regexp_extract_all("text", F.lit("(?s).{1,%d}" % size), F.lit(0)), lambda blocks: let(
        running(F.transform("spans", lambda s: s["end"]), lambda x, y: F.greatest(x, y)), lambda upto: joined(blocks, upto)))
    return found.withColumn("text", F.when(F.size("spans") > 0, done).otherwise(F.col("text"))).drop("base", "spans")
