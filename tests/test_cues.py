import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cuefold.functions import signal as S
from cuefold.operators import cues as C

CUES = "video string, idx int, start double, end double, text string"


def cues(spark, rows, video="v"):
    return spark.createDataFrame([(video, i, float(a), float(b), t) for i, (a, b, t) in enumerate(rows)], CUES)


def texts(df):
    return [r.text for r in df.orderBy("chunk_idx").collect()]


@pytest.mark.parametrize(
    "rows, want",
    [
        ([(0, 2, "a"), (5, 6, "b")], ["a b"]),
        ([(0, 2, "a"), (5.25, 6, "b")], ["a", "b"]),
        ([(0, 10, "a۔"), (10, 20, "b"), (20, 30, "c")], ["a۔", "b c"]),
        ([(0, 10, "a،"), (10, 20, "b"), (20, 30, "c")], ["a،", "b c"]),
        ([(0, 10, "a"), (10, 20, "b"), (20, 30, "c")], ["a b", "c"]),
        ([(0, 2, "a۔"), (2, 24, "b"), (24, 50, "c")], ["a۔", "b c"]),
        ([(0, 40, "a")], ["a"]),
    ],
)
def test_grouping(spark, rows, want):
    assert texts(C.group_cues(cues(spark, rows), most=24.5)) == want


def folded(rows, most, gap=3.0):
    """The windows by a plain loop: places where one starts."""
    out, cur = [], []
    for i, (a, b, _) in enumerate(rows):
        if cur:
            if a - rows[cur[-1]][1] > gap:
                out.append(cur)
                cur = []
            elif b - rows[cur[0]][0] > most:
                ends = [k for k, j in enumerate(cur) if rows[j][2].endswith("۔")] or [k for k, j in enumerate(cur) if rows[j][2].endswith("،")] or [len(cur) - 1]
                out.append(cur[: ends[-1] + 1])
                cur = cur[ends[-1] + 1 :]
        cur.append(i)
    return out + [cur] if cur else out


def test_grouping_of_random_cues(spark):
    r, frames, want = random.Random(3), [], {}
    for v in range(30):
        t, rows = 0.0, []
        for _ in range(r.randint(1, 40)):
            t += r.choice([0, 0, 0.25, 0.5, 3.0, 3.25])
            d = r.choice([0.5, 2, 5, 9, 30])
            rows.append((t, t + d, "w" + r.choice(["", "", "۔", "،"])))
            t += d
        frames += [(f"v{v}", i, *row) for i, row in enumerate(rows)]
        want[f"v{v}"] = [len(w) for w in folded(rows, 24.5)]
    got = {}
    for x in C.group_cues(spark.createDataFrame(frames, CUES), most=24.5).orderBy("video", "chunk_idx").collect():
        got.setdefault(x.video, []).append(x.n_cues)
    assert got == want


def test_subtitles(spark):
    body = "﻿1\r\n00:00:01,000 --> 00:00:02,500\r\nhello\r\nworld\r\n\r\n00:00:03,5 --> 01:02:03,004\nno index\n\n3\n00:00:05,000 --> 00:00:06,000\n\nalone\n"
    rows = C.parse_subtitles(spark.createDataFrame([("v", body)], "video string, value string")).orderBy("idx").collect()
    assert [(r.start, r.end, r.text) for r in rows] == [(1.0, 2.5, "hello world"), (3.005, 3723.004, "no index"), (5.0, 6.0, "")]
    with pytest.raises(Exception, match="not a subtitle time"):
        C.parse_subtitles(spark.createDataFrame([("v", "1\nx --> y\nz")], "video string, value string")).collect()


def test_reassign(spark):
    chunks = spark.createDataFrame([("v", 0, 5.0), ("v", 1, 9.0)], "video string, chunk_idx int, chunk_end double")
    got = C.reassign(cues(spark, [(0, 1, "a"), (4.9, 5, "b"), (5.0, 6, "c"), (20, 21, "d")]), chunks).orderBy("chunk_idx").collect()
    assert [(r.chunk_idx, r.text) for r in got] == [(0, "a b"), (1, "c d")]
    got = C.reassign(cues(spark, [(6, 7, "a"), (0, 1, "b")]), chunks).collect()  # cues out of order don't go back
    assert [(r.chunk_idx, r.text) for r in got] == [(1, "a b")]


def test_slices(spark):
    df = spark.createDataFrame([(60.0,), (56.0,), (28.0,)], "duration double")
    got = {}
    for r in C.tumbling(df).orderBy("slice").collect():
        got.setdefault(r.duration, []).append(r.slice_length)
    assert got == {60.0: [28.0, 28.0, 4.0], 56.0: [28.0, 28.0], 28.0: [28.0]}
    assert [(r.window_start, r.window_end) for r in C.sliding(df.where("duration = 60")).orderBy("window").collect()] == [(0.0, 28.0), (22.0, 50.0), (44.0, 60.0)]


def rms(x, frame, hop):
    p = np.pad(np.asarray(x, float), frame // 2)
    return np.array([np.sqrt(np.mean(p[k * hop : k * hop + frame] ** 2)) for k in range(1 + (len(p) - frame) // hop)])


def test_rms_and_snap(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=8000)
    x[5000:5600] *= 0.01
    df = spark.createDataFrame([(x.tolist(),)], "s array<double>")
    got = df.select(S.rms(F.col("s"))).first()[0]
    assert np.allclose(got, rms(x, 400, 160))
    at = lambda nominal, until, d=df: d.select(S.snap(F.col("s"), F.lit(8000.0), F.lit(nominal), F.lit(until))).first()[0]
    start = int((0.6 - 0.5) * 8000)
    want = (start + int(np.argmin(rms(x[start:7200], 400, 160))) * 160) / 8000
    assert at(0.6, 0.9) == pytest.approx(want) and 0.62 < want < 0.7
    assert at(0.6, 0.6) == 0.6 and at(0.6, 0.5) == 0.6
    assert at(0.6, 0.9, spark.createDataFrame([([1.0] * 8000,)], "s array<double>")) == 0.6


def test_chunks_of_audio(spark):
    """A gap's music is left out, texts follow the final boundaries, and a cue is never cut in two."""
    rate = 1000
    t = np.arange(0, 40 * rate) / rate
    x = np.sin(2 * np.pi * 50 * t)
    x[12 * rate : 12 * rate + 500] = 0
    rows = [(1, 6, "pehla۔"), (6, 12, "doosra۔"), (12.4, 25, "teesra۔"), (33, 36, "aakhri۔"), (36, 37, "!")]
    signals = spark.createDataFrame([("v", rate, x.tolist())], "video string, rate int, samples array<double>")
    got = C.chunks_of_audio(cues(spark, rows), signals, most=20.0).orderBy("chunk_idx").collect()
    assert [r.transcript for r in got] == ["pehla۔ doosra۔", "teesra۔", "aakhri۔ !"]
    assert got[0].chunk_start == pytest.approx(0.7) and got[0].chunk_end == got[1].chunk_start
    assert 12.0 <= got[0].chunk_end <= 12.4
    assert got[1].chunk_end <= 26.0 and got[2].chunk_start == pytest.approx(32.7)
    assert all(len(r.samples) == int(r.chunk_end * rate) - int(r.chunk_start * rate) and r.duration <= 20 for r in got)
