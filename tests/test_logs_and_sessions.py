"""Append-only logs that are killed and tried again, and sessions of a stream."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from cuefold import __main__ as cli
from cuefold.sources import files, ledger, sinks
from cuefold.streaming import incremental, sessions
from test_pipelines import put_video


def keyed(spark, *keys):
    return spark.createDataFrame([(k, k.upper()) for k in keys], "key string, up string")


def rows_of(spark, path):
    return [(r.pos, r.key, r.up) for r in ledger.read(spark, path).orderBy("pos").collect()]


def size(path):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(path) for f in names)


def test_log_grows_by_what_is_new(spark, tmp_path):
    path = str(tmp_path / "m.log")
    assert ledger.append(spark, path, keyed(spark, "b", "a"), "one", "key", ["key"]) == 2
    assert ledger.append(spark, path, keyed(spark, "c", "a"), "two", "key", ["key"]) == 1
    assert ledger.append(spark, path, keyed(spark, "c", "a", "d"), "two", "key", ["key"]) == 0  # the batch is there
    assert ledger.append(spark, path, keyed(spark, "c", "a"), "three", "key", ["key"]) == 0  # its rows are
    assert rows_of(spark, path) == [(0, "a", "A"), (1, "b", "B"), (2, "c", "C")]
    many = spark.range(20000).select(F.sha2(F.col("id").cast("string"), 256).alias("key"), F.lit("x").alias("up"))
    ledger.append(spark, path, many, "many", "key", ["key"])
    before = size(path)
    ledger.append(spark, path, many.unionByName(keyed(spark, "z")), "more", "key", ["key"])
    assert size(path) - before < before / 50 and ledger.read(spark, path).count() == 20004
    assert [r.n for r in ledger.log(spark, path).orderBy("version").collect()] == [2, 1, 0, 20000, 1]


def test_keys_above_the_limit_meet_in_a_shuffle(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ledger, "MAX_KEYS", 1)
    path = str(tmp_path / "m.log")
    ledger.append(spark, path, keyed(spark, "a", "b"), "one", "key", ["key"])
    ledger.append(spark, path, keyed(spark, "b", "c", "d"), "two", "key", ["key"])
    assert [k for _, k, _ in rows_of(spark, path)] == ["a", "b", "c", "d"]


def test_a_kill_between_rows_and_record(spark, tmp_path, monkeypatch):
    path, commit = str(tmp_path / "m.log"), ledger._commit
    ledger.append(spark, path, keyed(spark, "a"), "one", "key", ["key"])

    def killed(*_):
        raise KeyboardInterrupt

    monkeypatch.setattr(ledger, "_commit", killed)
    with pytest.raises(KeyboardInterrupt):
        ledger.append(spark, path, keyed(spark, "b"), "two", "key", ["key"])
    assert [k for _, k, _ in rows_of(spark, path)] == ["a"]  # the folder is there, the record isn't
    monkeypatch.setattr(ledger, "_commit", commit)
    assert ledger.append(spark, path, keyed(spark, "b"), "two", "key", ["key"]) == 1
    assert ledger.append(spark, path, keyed(spark, "b"), "two", "key", ["key"]) == 0  # killed after its record
    assert rows_of(spark, path) == [(0, "a", "A"), (1, "b", "B")]


def test_of_two_runs_at_once_one_fails(spark, tmp_path, monkeypatch):
    path, commit = str(tmp_path / "m.log"), ledger._commit

    def slow(*args):
        monkeypatch.setattr(ledger, "_commit", commit)
        ledger.append(spark, path, keyed(spark, "b"), "other", "key", ["key"])
        commit(*args)

    monkeypatch.setattr(ledger, "_commit", slow)
    with pytest.raises(ledger.Conflict):
        ledger.append(spark, path, keyed(spark, "a"), "one", "key", ["key"])
    assert rows_of(spark, path) == [(0, "b", "B")]
    with pytest.raises(ValueError, match="no batch"):
        ledger.read(spark, str(tmp_path / "none.log"))


def test_stream_into_a_log(spark, tmp_path):
    source, target = tmp_path / "in", str(tmp_path / "out.log")
    source.mkdir()
    run = lambda: incremental.log_stream(spark, str(source), "video_id string, n int", target, str(tmp_path / "cp"), lambda d: d.withColumn("n", F.col("n") * 10))
    (source / "1.json").write_text('{"video_id": "a", "n": 1}\n')
    run()
    (source / "2.json").write_text('{"video_id": "a", "n": 5}\n{"video_id": "b", "n": 3}\n{"video_id": "b", "n": 2}\n')
    run()
    run()
    assert [(r.pos, r.video_id, r.n) for r in ledger.read(spark, target).orderBy("pos").collect()] == [(0, "a", 10), (1, "b", 20)]


def test_prepare_batch_into_a_log_and_lines_to_a_dataset(spark, tmp_path):
    """What one command writes the next can read: JSON lines from prepare-batch to convert and build-dataset, and a log that grows."""
    source, out = tmp_path / "in", tmp_path / "processed" / "batch"
    source.mkdir()
    put_video(source, "EP2_aaaaaaaaaaa", [(1, 5, "پہلا ہے۔")], 8)
    args = ["prepare-batch", "--input_dir", str(source), "--output_dir", str(out)]
    cli.main([*args, "--manifest-name", "m.log"])
    cli.main([*args, "--manifest-name", "manifest.jsonl"])
    put_video(source, "EP3_bbbbbbbbbbb", [(1, 5, "دوسرا ہے۔")], 8)
    before = size(out / "m.log" / "rows")
    for _ in range(2):
        cli.main([*args, "--manifest-name", "m.log"])
    texts = [r.transcript for r in files.manifest(spark, str(out / "m.log")).orderBy("pos").collect()]
    assert texts == ["پہلا ہے۔", "دوسرا ہے۔"] and size(out / "m.log" / "rows") < 3 * before
    with pytest.raises(ValueError, match="in place"):
        cli.main(["normalise", "--manifest", str(out / "m.log"), "--inplace"])
    cli.main(["normalise", "--manifest", str(out / "m.log")])
    assert files.manifest(spark, str(out / "manifest_normalized.jsonl")).count() == 2
    reviewed = tmp_path / "reviewed.jsonl"
    reviewed.write_text(json.dumps({"transcript": "جائزہ۔", "duration": 2.0, "language": "ur", "episode_label": "EP2", "youtube_video_id": "aaaaaaaaaaa", "chunk_index": 0}), encoding="utf-8")
    cli.main(["convert", str(reviewed), "--processed-dir", str(tmp_path / "processed"), "--output", str(tmp_path / "converted.jsonl")])
    rows = files.manifest(spark, str(tmp_path / "converted.jsonl")).collect()
    assert [(r.pos, r.transcript) for r in rows] == [(0, "جائزہ۔")] and rows[0].audio_path.endswith("EP2_aaaaaaaaaaa_000.wav")
    cli.main(["build-dataset", str(tmp_path / "converted.jsonl"), str(tmp_path / "data")])
    assert [r.split for r in files.dataset(spark, str(tmp_path / "data")).collect()] == ["train"]
    assert sinks.normalised_path("a/m.log", False) == "a/manifest_normalized.jsonl"


# Sessions


def plain(rows, gap):
    out = []
    for a, b in sorted(rows):
        if out and a - out[-1][1] <= gap:
            out[-1] = (out[-1][0], max(out[-1][1], b), out[-1][2] + 1)
        else:
            out.append((a, b, 1))
    return [(k, *s) for k, s in enumerate(out)]


def test_sessions_whatever_the_order_within_the_delay():
    rng = random.Random(1)
    for _ in range(500):
        gap, late = rng.randrange(1, 6), rng.randrange(0, 20)
        rows = [(t, t + rng.randrange(3)) for t in (rng.randrange(120) for _ in range(40))]
        came = sorted(rows, key=lambda r: r[0] + rng.random() * late)
        state, out, watermark = (0, []), [], -1
        while came:
            k = rng.randrange(1, 9)
            batch, came = came[:k], came[k:]
            assert all(a > watermark for a, _ in batch)
            closed, state = sessions.advance(batch, state, gap, watermark)
            out += closed
            watermark = max([watermark, *[a - late - 1 for a, _ in batch]])
        closed, _ = sessions.advance([], state, gap, 1 << 40)
        assert out + closed == plain(rows, gap)


def test_late_rows_are_dropped_and_numbers_go_on(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    at = lambda s: int(s * 1_000_000)

    def run(name, rows):
        (source / f"{name}.json").write_text("".join(json.dumps({"user": u, "at": at(s)}) + "\n" for u, s in rows))
        stream = spark.readStream.schema("user string, at long").json(str(source))
        out = sessions.session_stream(stream, "user", F.timestamp_micros("at"), F.timestamp_micros("at"), 10, "5 seconds")
        out.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination()
        return sorted((r.user, r.session, r.start_us // 1_000_000, r.end_us // 1_000_000, r.n) for r in spark.read.parquet(str(tmp_path / "out")).collect())

    v = ("v", 0, 101, 101, 1)
    assert run("a", [("u", 100), ("u", 110), ("u", 120.5), ("v", 101)]) == [v]  # the watermark is at 115.5
    u = ("u", 0, 100, 120, 4)  # 118 comes in time and joins two sessions
    assert run("b", [("w", 200), ("u", 118)]) == [u, v]
    assert run("c", [("u", 130), ("u", 300), ("w", 400)]) == [u, ("u", 1, 300, 300, 1), v, ("w", 0, 200, 200, 1)]  # 130 is late


def test_keys_share_groups(spark, tmp_path):
    """State rows, and so calls, are as many as buckets, not as keys; null and large keys keep their values."""
    keys = [None, (1 << 60) + 1, (1 << 60) + 2, -3, *range(500)]
    rows = [(k, 1_000_000 * s) for i, k in enumerate(keys) for s in (5, 12, 40 + i % 3, 51)]
    spark.createDataFrame(rows, "user long, at long").repartition(3).write.parquet(str(tmp_path / "in" / "a"))
    stream = spark.readStream.schema("user long, at long").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in" / "*"))
    at = F.timestamp_micros("at")
    out = sessions.session_stream(stream, "user", at, at, 10, "100 seconds", buckets=8)
    run = lambda: out.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    query = run()
    query.awaitTermination()
    assert max(op["numRowsTotal"] for p in query.recentProgress for op in p["stateOperators"]) == 8
    spark.createDataFrame([(-9, 10_000_000_000)], "user long, at long").write.parquet(str(tmp_path / "in" / "z"))
    run().awaitTermination()
    got = sorted(((r.user, r.session, r.start_us // 1_000_000, r.end_us // 1_000_000, r.n) for r in spark.read.parquet(str(tmp_path / "out")).collect()), key=repr)
    assert got == sorted([x for i, k in enumerate(keys) for x in ((k, 0, 5, 12, 2), *([(k, 1, 40 + i % 3, 51, 2)] if i % 3 else [(k, 1, 40, 40, 1), (k, 2, 51, 51, 1)]))], key=repr)
