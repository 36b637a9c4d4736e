"""Scans by ranges, and videos that are most of a table."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from cuefold.operators import cues as C
from cuefold.operators import split as H
from cuefold.operators.numbering import scanned

CUES = "video string, idx int, start double, end double, text string"


def test_scans_are_windows(spark):
    rng = random.Random(1)
    rows = [(rng.choice(["hot"] * 8 + ["a", "b", None]), i, rng.randrange(-50, 50)) for i in range(3000)]
    df = spark.createDataFrame(rows, "k string, i int, x int").repartition(7)
    scans = {"s": ("sum", F.col("x"), True), "s0": ("sum", F.col("x"), False), "lo": ("min", F.col("x"), True), "hi": ("max", F.col("x"), False), "prev": ("last", F.col("x"), False)}
    order = Window.partitionBy("k").orderBy(F.desc("i"))
    upto = lambda e: order.rowsBetween(Window.unboundedPreceding, e)
    want = df.select("k", "i", F.sum("x").over(upto(0)), F.sum("x").over(upto(-1)), F.min("x").over(upto(0)), F.max("x").over(upto(-1)), F.lag("x").over(order))
    got = scanned(df, ["k"], [F.desc("i")], scans).select("k", "i", *scans)
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, map(tuple, want.collect())))
    whole = scanned(df, [], [F.col("i")], {"n": ("sum", F.lit(1), True)})
    assert [r.n for r in whole.orderBy("i").collect()] == list(range(1, 3001))
    assert scanned(df.where("i < 0"), ["k"], [F.col("i")], scans).collect() == []


def test_as_many_groups_as_rows(spark):
    rows = spark.range(5000).select(F.concat(F.lit("g"), "id").alias("episode"), F.col("id").alias("pos"), (F.col("id") % 3 == 0).alias("rich"))
    held = H.held_groups(rows, "episode", F.col("rich"), 0.1)
    assert sorted(int(r.episode[1:]) for r in held.collect()) == list(range(0, 1500, 3))
    plan = held._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan.split("BroadcastExchange")[0]


def long_video(n, seed=2):
    rng, t, rows = random.Random(seed), 0.0, []
    for i in range(n):
        t += rng.choice([0, 0, 0.25, 0.5, 3.0] + [3.25] * (seed == 2))
        d = rng.choice([0.5, 2, 5, 9])
        rows.append((i, t, t + d, f"w{i}" + rng.choice(["", "", "۔", "،"])))
        t += d
    return rows


@pytest.mark.parametrize("seed", [2, 3])  # with gaps, and without any
def test_a_long_video_folds_by_segments(spark, seed):
    rows = [("long", *r) for r in long_video(3000, seed)] + [(f"v{k}", *r) for k in range(5) for r in long_video(20, k)]
    df = spark.createDataFrame(rows, CUES).repartition(5)
    want = C.group_cues(df, most=24.5)
    got = C.group_cues(df, most=24.5, most_cues=100)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_a_long_video_is_reassigned_by_ranges(spark):
    rng = random.Random(5)
    rows = [("long", *r) for r in long_video(2000)] + [(f"v{k}", *r) for k in range(5) for r in long_video(20, k)] + [("none", 0, 0.0, 1.0, "x")]
    df = spark.createDataFrame(rows, CUES)
    chunks = C.boundaries(C.group_cues(df.where("video <> 'none'"), most=24.5)).select("video", "chunk_idx", "chunk_end")
    chunks = spark.createDataFrame([(r.video, r.chunk_idx, r.chunk_end + rng.choice([0.0, -3.0, 2.0])) for r in chunks.collect()], "video string, chunk_idx int, chunk_end double")
    want = C.reassign(df, chunks)
    got = C.reassign(df, chunks, most_cues=100)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and want.count() > 100
