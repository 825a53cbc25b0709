"""Learning-rate schedules and step series.

A schedule is a table of breakpoints: steps find their interval by a binary search
over them plus an equi-join on its index (J10), and the rate is plain column maths.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import MAX_BROADCAST_IDS, small

ROUND = 12


def lr_cosine_with_warmup(step: Column, max_lr: float, min_lr: float, warmup: int, cycle: int) -> Column:
    """M5: linear warm-up to ``max_lr``, cosine down to ``min_lr`` at ``cycle``, then flat."""
    t = step.cast("double")
    warm = t / F.lit(float(warmup)) * F.lit(max_lr) if warmup > 0 else F.lit(max_lr)
    frac = (t - F.lit(float(warmup))) / F.lit(float(max(cycle - warmup, 1)))
    cos = F.lit(min_lr) + F.lit(0.5) * (F.lit(1.0) + F.cos(frac * F.lit(math.pi))) * F.lit(max_lr - min_lr)
    return (F.when(t < F.lit(float(warmup)), warm)
            .when(t <= F.lit(float(cycle)), cos)
            .otherwise(F.lit(min_lr)))


def segments(spark: SparkSession, points: list[tuple[int, float]]) -> DataFrame:
    """Chain intervals: linear ones, the last one cosine, then a constant tail.

    The first interval is open below and the tail open above, as in the chain
    schedule: ``lo``/``hi`` are null there.
    """
    if len(points) < 2:
        raise ValueError("a schedule takes two breakpoints or more")
    rows = []
    n = len(points) - 1
    for i in range(n):
        (s0, l0), (s1, l1) = points[i], points[i + 1]
        kind = "cosine" if i == n - 1 else "linear"
        rows.append((i, None if i == 0 else s0, s1, s0, s1, float(l0), float(l1), kind))
    s_last, l_last = points[-1]
    rows.append((n, s_last, None, s_last, s_last, float(l_last), float(l_last), "constant"))
    return spark.createDataFrame(rows, "seg int, lo long, hi long, s0 long, s1 long, lr0 double, lr1 double, kind string")


def interval_index(step: Column, bounds: list[int]) -> Column:
    """Index of the interval holding ``step`` for increasing upper bounds (open below and above).

    A binary search over a constant array; a null step lies behind all bounds.
    """
    if not bounds:
        return F.lit(0)
    held = F.split(F.lit(" ".join(map(str, bounds))), " ").cast("array<bigint>")
    halvings = len(bounds).bit_length()

    def halve(at: Column, _) -> Column:  # the first bound above ``step`` lies in [lo, hi]
        mid = F.floor((at["lo"] + at["hi"]) / 2).cast("int")
        above = (at["lo"] < at["hi"]) & (step < F.get(held, mid))
        below = (at["lo"] < at["hi"]) & ~(step < F.get(held, mid))
        return F.struct(F.when(below, mid + 1).otherwise(at["lo"]).alias("lo"), F.when(above, mid).otherwise(at["hi"]).alias("hi"))

    found = F.aggregate(F.sequence(F.lit(1), F.lit(halvings)), F.struct(F.lit(0).alias("lo"), F.lit(len(bounds)).alias("hi")), halve, lambda at: at["hi"])
    return F.when(step.isNull(), F.lit(len(bounds))).otherwise(found).cast("int")


def annotate_lr(steps: DataFrame, segs: DataFrame, step_col: str = "step") -> DataFrame:
    """Each step with its interval of the breakpoint table.

    The range condition becomes an interval index, found by binary search over the upper
    bounds, then an equi-join on it: no nested-loop join.  The bounds are a constant of the
    plan, ``MAX_BROADCAST_IDS`` at most; the table itself is broadcast up to that size.
    """
    held = segs.filter(F.col("hi").isNotNull()).select("seg", "hi").limit(MAX_BROADCAST_IDS + 1).collect()
    if len(held) > MAX_BROADCAST_IDS:
        raise ValueError(f"more than {MAX_BROADCAST_IDS} breakpoints")
    bounds = [int(r.hi) for r in sorted(held, key=lambda r: r.seg)]
    return steps.withColumn("seg", interval_index(F.col(step_col), bounds)).join(small(segs), "seg")


def lr_at(step: Column) -> Column:
    """M4 over an annotated row: linear / cosine / constant of the interval."""
    t = step.cast("double")
    span = (F.col("s1") - F.col("s0")).cast("double")
    lin = F.col("lr0") + (t - F.col("s0")) / span * (F.col("lr1") - F.col("lr0"))
    cos = F.col("lr1") + F.lit(0.5) * (F.col("lr0") - F.col("lr1")) * (F.lit(1.0) + F.cos((t - F.col("s0")) / span * F.lit(math.pi)))
    return (F.when(F.col("kind") == "constant", F.col("lr0"))
            .when(span == 0, F.col("lr0"))
            .when(F.col("kind") == "linear", lin)
            .otherwise(cos))


def lr_schedule(steps: DataFrame, points: list[tuple[int, float]], step_col: str = "step") -> DataFrame:
    """M4: chain schedule rate for each step."""
    spark = steps.sparkSession
    a = annotate_lr(steps, segments(spark, points), step_col)
    return a.select(*steps.columns, "seg", F.round(lr_at(F.col(step_col)), ROUND).alias("lr"))


def step_metrics(steps: DataFrame, batch_size: int, seq_len: int, accum: int, step_col: str = "step") -> DataFrame:
    """Optimizer-update steps only, with tokens seen and effective sizes."""
    s1 = F.col(step_col) + 1
    return (steps.filter(s1 % accum == 0)
            .select(step_col,
                    (s1 * batch_size * seq_len).cast("long").alias("tokens_seen"),
                    F.floor(s1 / accum).cast("long").alias("effective_steps"),
                    F.lit(batch_size * accum).cast("long").alias("effective_batch")))


def periodic(steps: DataFrame, checkpoint_every: int, validate_every: int, step_col: str = "step") -> DataFrame:
    """Steps where a checkpoint and / or a validation falls due."""
    s1 = F.col(step_col) + 1
    return (steps.select(step_col, (s1 % checkpoint_every == 0).alias("is_checkpoint"),
                         (s1 % validate_every == 0).alias("is_validation"))
            .filter(F.col("is_checkpoint") | F.col("is_validation")))
