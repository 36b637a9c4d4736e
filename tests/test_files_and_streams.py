import json

import numpy as np
from pyspark.sql import functions as F

from cuefold import schemas
from cuefold.operators import cues as C
from cuefold.sources import files, sinks
from cuefold.streaming import incremental


def rows_of(spark):
    return spark.createDataFrame([(1, "b/EP1_x/EP1_x_001.wav", "دو \"2\"", 2.0, None), (0, "b/EP1_x/EP1_x_000.wav", "ایک", 1.5, "ur")], "pos long, " + schemas.MANIFEST)


def test_manifest_round_trip(spark, tmp_path):
    path = str(tmp_path / "batch" / "manifest.json")
    sinks.json_array(rows_of(spark), path)
    text = (tmp_path / "batch" / "manifest.json").read_text(encoding="utf-8")
    assert "ایک" in text and [x["transcript"] for x in json.loads(text)] == ["ایک", 'دو "2"']
    assert [(r.pos, r.duration) for r in files.manifest(spark, path).orderBy("pos").collect()] == [(0, 1.5), (1, 2.0)]
    assert [r.folder for r in files.manifests(spark, str(tmp_path)).collect()] == ["batch", "batch"]
    sinks.json_array(files.manifest(spark, path).where("pos = 0"), path)  # in place
    assert files.manifest(spark, path).count() == 1
    assert files.optional_manifest(spark, str(tmp_path / "none.json")).count() == 0
    assert sinks.normalised_path(path, False).endswith("/batch/manifest_normalized.json")
    assert sinks.converted_path("r", None, "f") == "r/f/manifest_reviewed.json" and sinks.converted_path("r") == "r/manifest_reviewed.json"


def test_lexicons(spark, tmp_path):
    path = tmp_path / "terms.json"
    path.write_text(json.dumps({"spiritual_terms": ["ب"], "arabic_phrases": ["ا"], "english_domain": ["x"]}, indent=1), encoding="utf-8")
    assert files.terms(spark, str(path)) == ["ب", "ا"] and files.terms(spark, str(tmp_path / "no.json")) == []
    path.write_text(json.dumps({"corrections": {"a b": "A B"}}), encoding="utf-8")
    assert files.corrections(spark, str(path)) == {"a b": "A B"}


def test_listing_subtitles_and_audio(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    samples = np.sin(np.arange(1600) / 20)
    (folder / "EP1_a.wav").write_bytes(sinks.encode_wav(samples, 8000))
    (folder / "bad.wav").write_bytes(b"no")
    (folder / "EP1_a.srt").write_text("1\n00:00:00,000 --> 00:00:01,000\nx\n", encoding="utf-8")
    assert files.listing(spark, str(folder), (".wav",)).count() == 2
    assert C.parse_subtitles(files.subtitles(spark, str(folder / "*.srt"))).first().text == "x"
    rows = {r.video: r for r in files.duration(files.audio(spark, str(folder / "*.wav"), 16000)).collect()}
    assert rows["bad"].error and rows["bad"].samples is None
    assert abs(rows["EP1_a"].duration - 0.2) < 1e-6 and np.allclose(rows["EP1_a"].samples[::2], samples, atol=1e-3)


def test_clips_and_dataset(spark, tmp_path):
    chunks = spark.createDataFrame([("v", 3, [0.0, 0.5, -0.5], 8000)], "video string, chunk_idx int, samples array<double>, rate int")
    clip = sinks.clips(chunks).first()
    assert clip.path == "audio/v/v_003.wav"
    assert np.allclose(files.decode_wav(bytes(clip.content))[1], [0, 0.5, -0.5], atol=1e-4)
    path = str(tmp_path / "data")
    rows = spark.createDataFrame([(0, "a", "eval"), (1, "b", "train")], "pos long, sentence string, split string")
    sinks.dataset(rows, path)
    sinks.dataset(rows.where("pos = 0"), path)  # nothing stale is left
    assert [r.sentence for r in files.dataset(spark, path).collect()] == ["a"]
    assert files.dataset(spark, path, "train").count() == 0


def test_incremental_batch_and_stream(spark, tmp_path):
    done = spark.createDataFrame([("a", 1)], "video_id string, n int")
    found = spark.createDataFrame([("a", 2), ("b", 3)], "video_id string, n int")
    assert {(r.video_id, r.n) for r in incremental.append_batch(done, found, lambda d: d).collect()} == {("a", 1), ("b", 3)}
    source, target = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    run = lambda: incremental.append_stream(spark, str(source), "video_id string, n int", target, str(tmp_path / "cp"), lambda d: d.withColumn("n", F.col("n") * 10))
    (source / "1.json").write_text('{"video_id": "a", "n": 1}\n')
    run()
    (source / "2.json").write_text('{"video_id": "a", "n": 5}\n{"video_id": "b", "n": 2}\n')
    run()
    run()
    assert {(r.video_id, r.n) for r in spark.read.parquet(target).collect()} == {("a", 10), ("b", 20)}


def test_shipping_to_workers_without_the_package(tmp_path):
    """A driver that finds the package where its workers don't: shipped, its functions run."""
    import os
    import subprocess
    import sys
    from pathlib import Path

    code = """
import sys
sys.path.append(sys.argv[1])
from pyspark.sql import SparkSession
from cuefold.operators import models
from cuefold.shipping import ship
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").getOrCreate()
ship(spark)
print(models.apply_model(spark.range(3), "id", lambda: (lambda xs: [x + 1 for x in xs]), "y", "long").selectExpr("sum(y)").first()[0])
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    run = subprocess.run([sys.executable, "-c", code, str(Path(__file__).resolve().parent.parent)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=120)
    assert run.stdout.strip().endswith("6"), run.stderr[-2000:]
