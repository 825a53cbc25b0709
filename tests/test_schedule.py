import numpy as np
from pyspark.sql import functions as F

from mergeloom.operators.schedule import lr_cosine_with_warmup, lr_schedule, periodic, step_metrics

# The 25 learning rates expected for max 1, min 0.1, warm-up 7, cycle 21.
EXPECTED_LRS = [0, 0.14285714285714285, 0.2857142857142857, 0.42857142857142855, 0.5714285714285714,
                0.7142857142857143, 0.8571428571428571, 1.0, 0.9887175604818206, 0.9554359905560885,
                0.9018241671106134, 0.8305704108364301, 0.7452476826029011, 0.6501344202803414, 0.55,
                0.44986557971965857, 0.3547523173970989, 0.26942958916356996, 0.19817583288938662,
                0.14456400944391146, 0.11128243951817937, 0.1, 0.1, 0.1, 0.1]


def test_cosine_with_warmup_golden(spark):
    s = spark.range(25).withColumnRenamed("id", "step")
    got = [r.lr for r in s.select("step", lr_cosine_with_warmup(F.col("step"), 1.0, 0.1, 7, 21).alias("lr")).orderBy("step").collect()]
    np.testing.assert_allclose(got, EXPECTED_LRS)


def test_chain_schedule(spark):
    pts = [(0, 0.0), (10, 1.0), (20, 0.5), (40, 0.1)]
    s = spark.range(-2, 50).withColumnRenamed("id", "step")
    lr = {r.step: r.lr for r in lr_schedule(s, pts).collect()}
    assert lr[0] == 0.0 and abs(lr[5] - 0.5) < 1e-12 and abs(lr[15] - 0.75) < 1e-12
    assert abs(lr[20] - 0.5) < 1e-12 and abs(lr[30] - 0.3) < 1e-12 and lr[45] == 0.1 and lr[40] == 0.1
    assert abs(lr[-2] - (-0.2)) < 1e-12  # first interval is open below
    assert len(lr) == 52


def test_step_series(spark):
    s = spark.range(40).withColumnRenamed("id", "step")
    m = step_metrics(s, 8, 16, 4).collect()
    assert [r.step for r in m] == [3, 7, 11, 15, 19, 23, 27, 31, 35, 39]
    assert m[0].tokens_seen == 4 * 8 * 16 and m[-1].effective_steps == 10
    p = periodic(s, 10, 4).collect()
    assert {r.step for r in p if r.is_checkpoint} == {9, 19, 29, 39}


def test_interval_search_matches_a_scan(spark):
    import bisect
    import random

    from mergeloom.operators.schedule import interval_index
    r = random.Random(1)
    for bounds in ([], [5], [5, 5, 9], sorted(r.randrange(-500, 500) for _ in range(77))):
        steps = spark.range(-510, 510).select(F.col("id").alias("step"))
        got = {x.step: x.i for x in steps.select("step", interval_index(F.col("step"), bounds).alias("i")).collect()}
        assert got == {s: bisect.bisect_right(bounds, s) for s in range(-510, 510)}
    null = spark.range(1).select(interval_index(F.lit(None).cast("long"), [1, 2]).alias("i")).first().i
    assert null == 2


def test_many_breakpoints(spark):
    from mergeloom.operators.schedule import annotate_lr, segments
    points = [(10 * i, i / 1000) for i in range(100_001)]
    steps = spark.range(0, 1_000_050, 997).select(F.col("id").alias("step"))
    got = annotate_lr(steps, segments(spark, points)).select("step", "seg").collect()
    assert len(got) == steps.count() and all(x.seg == min(x.step // 10, 100_000) for x in got)
