"""A small corpus from files to a split dataset, its second run, and the evaluation."""

import json

import numpy as np
import pytest

from cuefold import __main__ as cli
from cuefold.operators import models
from cuefold.plans import pipelines
from cuefold.sources import files, sinks

RATE = 16_000


def put_video(folder, name, lines, seconds=40):
    t = np.arange(seconds * RATE) / RATE
    (folder / f"{name}.wav").write_bytes(sinks.encode_wav(0.5 * np.sin(300 * t), RATE))
    blocks = [f"{i + 1}\n00:00:{a:02d},000 --> 00:00:{b:02d},000\n{text}" for i, (a, b, text) in enumerate(lines)]
    (folder / f"{name}.srt").write_text("\n\n".join(blocks), encoding="utf-8")


def test_from_audio_to_dataset(spark, tmp_path):
    source, out = tmp_path / "in", tmp_path / "processed" / "batch"
    source.mkdir()
    put_video(source, "EP2_aaaaaaaaaaa", [(1, 9, "پہلا ok،اور"), (9, 20, "دوسرا۔"), (25, 33, "تیسرا۔")])
    put_video(source, "EP10_bbbbbbbbbbb", [(2, 9, "چوتھا ۔"), (9, 11, "پانچواں۔")])
    (source / "EP3_ccccccccccc.wav").write_bytes(b"broken")
    (source / "EP3_ccccccccccc.srt").write_text("1\n00:00:01,000 --> 00:00:02,000\nx\n")
    (source / "EP4_ddddddddddd.srt").write_text("no partner")
    cli.main(["prepare-batch", "--input_dir", str(source), "--output_dir", str(out)])
    manifest = json.loads((out / "manifest.json").read_text(encoding="utf-8"))
    assert [m["audio_path"].rsplit("/", 1)[1] for m in manifest] == ["EP2_aaaaaaaaaaa_000.wav", "EP2_aaaaaaaaaaa_001.wav", "EP10_bbbbbbbbbbb_000.wav"]
    assert [m["transcript"] for m in manifest] == ["پہلا ok،اور دوسرا۔", "تیسرا۔", "چوتھا ۔ پانچواں۔"]
    for m in manifest:
        rate, samples = files.decode_wav(open(m["audio_path"], "rb").read())
        assert rate == RATE and abs(len(samples) / rate - m["duration"]) < 1e-3
    put_video(source, "EP11_eeeeeeeeeee", [(1, 5, "نیا ہے۔")])
    cli.main(["prepare-batch", "--input_dir", str(source), "--output_dir", str(out)])
    again = json.loads((out / "manifest.json").read_text(encoding="utf-8"))
    assert again[:3] == manifest and [m["transcript"] for m in again[3:]] == ["نیا ہے۔"]

    cli.main(["normalise", "--manifest", str(out / "manifest.json"), "--dry-run"])
    assert not (out / "manifest_normalized.json").exists()
    cli.main(["normalise", "--manifest", str(out / "manifest.json"), "--inplace"])
    texts = [m["transcript"] for m in json.loads((out / "manifest.json").read_text(encoding="utf-8"))]
    assert texts[0] == "پہلا ok، اور دوسرا۔" and texts[2] == "چوتھا۔ پانچواں۔"

    reviewed = [
        {"audio_s3_key": "k", "transcript": f"جائزہ {i}۔", "duration": 2.0, "language": "ur", "batch_name": "b", "episode_label": e, "youtube_video_id": y, "chunk_index": i, "status": "ok"}
        for e, y, i in (("EP10", "bbbbbbbbbbb", 0), ("EP2", "aaaaaaaaaaa", 1))
    ]
    path = tmp_path / "reviewed.json"
    path.write_text(json.dumps(reviewed), encoding="utf-8")
    rows, coverage = pipelines.convert_reviewed(spark, str(path), str(tmp_path / "processed"))
    assert all(r.audio_path.endswith(".wav") for r in rows.collect()) and coverage.where("episode IS NULL").first().matched == 2
    path.write_text(json.dumps([{**reviewed[0], "chunk_index": 9}]), encoding="utf-8")
    with pytest.raises(ValueError, match="without a local match"):
        pipelines.convert_reviewed(spark, str(path), str(tmp_path / "processed"), allow_reconstruct=True)
    rows, _ = pipelines.convert_reviewed(spark, str(path), str(tmp_path / "processed"), "batch", allow_reconstruct=True)
    assert rows.first().audio_path == "data\\processed\\batch\\audio\\EP10_bbbbbbbbbbb\\EP10_bbbbbbbbbbb_009.wav"

    pairs = tmp_path / "pairs.json"
    pairs.write_text(json.dumps([["ok", "ٹھیک"], ["ٹھیک،", "درست،"]]), encoding="utf-8")
    cli.main(["fix-lexicon", "--input", str(out / "manifest.json"), "--output", str(out / "fixed.json"), "--pairs", str(pairs)])
    assert json.loads((out / "fixed.json").read_text(encoding="utf-8"))[0]["transcript"] == "پہلا درست، اور دوسرا۔"

    rows, counts = pipelines.build_dataset(spark, str(out / "manifest.json"), str(tmp_path / "data"), 0.2)
    split = {r.episode: r.split for r in rows.collect()}
    assert split == {"EP2_aaaaaaaaaaa": "eval", "EP10_bbbbbbbbbbb": "train", "EP11_eeeeeeeeeee": "train"}
    assert {(r.bucket, r.train, r.eval) for r in counts.collect()} == {("code_switch", 0, 1), ("nastaliq_only", 2, 1)}
    assert files.dataset(spark, str(tmp_path / "data"), "eval").count() == 2
    side = files.sidecar(spark, str(tmp_path / "data_eval_buckets.json"))
    assert [(r.pos, r.episode) for r in side.orderBy("pos").collect()] == [(0, "EP2_aaaaaaaaaaa"), (1, "EP2_aaaaaaaaaaa")]
    assert files.sidecar(spark, str(tmp_path / "none.json")) is None


def test_prepare_batch_takes_all_pairs_in_one_call(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(pipelines, "MAX_PATHS", 2)
    names = [f"EP{k}_{'abcde'[k] * 11}" for k in range(5)]
    for k, name in enumerate(names):
        put_video(tmp_path, name, [(1, 5, f"متن {k}۔")], 8)
    (tmp_path / f"{names[1]}.wav").write_bytes(b"broken")
    merged, clips = pipelines.prepare_batch(spark, str(tmp_path), str(tmp_path / "out"))
    texts = [r.transcript for r in merged.orderBy("pos").collect()]
    assert texts == [f"متن {k}۔" for k in (0, 2, 3, 4)] and clips.count() == 4


def test_flat_prep(spark, tmp_path):
    for name, text in {"a": " اچھا متن ", "b": "x", "c": "لمبا متن"}.items():
        (tmp_path / f"{name}.txt").write_text(text, encoding="utf-8")
    media = spark.createDataFrame([("v/a.mp4", 28.0), ("v/b.mp4", 3.0), ("v/c.mp4", 28.5), ("v/d.mp4", 2.0)], "path string, duration double")
    rows = pipelines.flat_prep(spark, media, str(tmp_path)).collect()
    assert [(r.audio_path, r.transcript, r.language) for r in rows] == [("v/a.mp4", "اچھا متن", "ur")]


def test_evaluate_and_prompt(spark, tmp_path, capsys):
    rows = spark.createDataFrame([("base", "a, b", "a b", ["x"]), ("base", "c", "d", ["y"]), ("finetuned", "c", "c", ["y"])], "model string, reference string, prediction string, buckets array<string>")
    got = {(r.model, r.bucket): (r.n, r.raw_wer, r.norm_wer) for r in pipelines.evaluate(rows).collect()}
    assert got[("base", None)] == (2, pytest.approx(200 / 3), pytest.approx(100 / 3)) and got[("base", "x")] == (1, None, 0.0)
    assert {r.model for r in pipelines.evaluate(rows, "finetuned").collect()} == {"finetuned"}
    terms = tmp_path / "t.json"
    terms.write_text(json.dumps({"spiritual_terms": ["ب", "پ"], "arabic_phrases": [], "english_domain": ["Sukuk"]}), encoding="utf-8")
    cli.main(["prompt", "--terms", str(terms), "--max-terms", "1", "--out", str(tmp_path / "p.txt")])
    assert (tmp_path / "p.txt").read_text(encoding="utf-8").endswith("ہے۔ ب۔ Sukuk.")


def test_model_errors_stay_with_their_rows(spark):
    def load():
        def model(values):
            return [10 // v for v in values]

        return model

    rows = models.apply_model(spark.createDataFrame([(i,) for i in (5, 0, 2)], "x int"), "x", load, "y", "int").collect()
    assert {(r.x, r.y, bool(r.error)) for r in rows} == {(5, 2, False), (0, None, True), (2, 5, False)}
    sizes = models.batches(spark.range(20).selectExpr("id % 2 AS k", "id"), ["k"], ["id"], 4).groupBy("k", "batch").count().collect()
    assert sorted(r["count"] for r in sizes) == [2, 2, 4, 4, 4, 4]


def test_files_that_cannot_be_parsed_are_left_out(spark):
    from cuefold.operators import cues as C

    texts = spark.createDataFrame([("a", "1\n00:00:01,0 --> 00:00:02,0\nx"), ("b", "1\n00:00:01,0 --> 00:00:02,0\nx\n\n2\nbad --> time\ny")], "video string, value string")
    assert [r.video for r in C.parse_subtitles(texts, strict=False).collect()] == ["a"]


def test_reports_of_a_rewrite_in_place(spark, tmp_path):
    """Report, log and rows are of what was there before, also once the file has been replaced."""
    path = str(tmp_path / "manifest.json")
    rows = spark.createDataFrame([(0, "a/a_0.wav", "پہلا ۔", 1.0, "ur"), (1, "a/a_1.wav", "x ۔ y ۔", 1.0, "ur"), (2, "a/a_2.wav", "ok", 1.0, "ur")], "pos long, audio_path string, transcript string, duration double, language string")
    sinks.json_array(rows, path)
    dry = [sorted(map(repr, x.collect())) for x in pipelines.normalise_manifest(spark, path, dry_run=True)]
    done = [sorted(map(repr, x.collect())) for x in pipelines.normalise_manifest(spark, path, in_place=True)]
    assert done == dry and len(dry[2]) == 2 and files.manifest(spark, path).where("transcript LIKE '% ۔%'").count() == 0
    _, changed = pipelines.fix_lexicon(spark, path, path, [("ok", "ok ok")])
    again, _ = pipelines.fix_lexicon(spark, path, path, [("ok ok", "!")])
    assert changed == 1 and [r.transcript for r in again.orderBy("pos").collect()][2] == "!" == files.manifest(spark, path).where("pos = 2").first().transcript


def test_manifests_as_json_lines(spark, tmp_path):
    path = str(tmp_path / "manifest.jsonl")
    rows = spark.range(50).selectExpr("id AS pos", "concat('a/a_', id, '.wav') AS audio_path", "'x ۔' AS transcript", "1.0D AS duration", "'ur' AS language")
    sinks.manifest(rows, path)
    assert [r.pos for r in files.manifest(spark, path).orderBy("pos").collect()] == list(range(50))
    out, report, _ = pipelines.normalise_manifest(spark, path)
    assert report.first().n == 50 and files.manifest(spark, str(tmp_path / "manifest_normalized.jsonl")).where("transcript = 'x۔'").count() == 50
    sinks.json_array(rows.repartition(5), str(tmp_path / "all.json"))
    assert [r.pos for r in files.manifest(spark, str(tmp_path / "all.json")).orderBy("pos").collect()] == list(range(50))
    put_video(tmp_path, "EP1_aaaaaaaaaaa", [(1, 5, "متن۔")], 8)
    cli.main(["prepare-batch", "--input_dir", str(tmp_path / "*.*"), "--output_dir", str(tmp_path / "out"), "--manifest-name", "m.jsonl"])
    assert files.manifest(spark, str(tmp_path / "out" / "m.jsonl")).first().transcript == "متن۔"


def test_one_recording_and_flat_media(spark, tmp_path, capsys):
    put_video(tmp_path, "EP1_aaaaaaaaaaa", [(1, 5, "متن۔"), (9, 12, "اور۔")], 14)
    pair = ["--audio", str(tmp_path / "EP1_aaaaaaaaaaa.wav"), "--srt", str(tmp_path / "EP1_aaaaaaaaaaa.srt")]
    cli.main(["prepare-pair", *pair, "--output_dir", str(tmp_path / "one"), "--video_index", "4"])
    manifest = json.loads((tmp_path / "one" / "manifest.json").read_text(encoding="utf-8"))
    assert [m["transcript"] for m in manifest] == ["متن۔", "اور۔"] and all(files.decode_wav(open(m["audio_path"], "rb").read())[0] == RATE for m in manifest)
    with pytest.raises(ValueError, match="EP1_aaaaaaaaaaa.srt"):
        pipelines.prepare_pair(spark, pair[3], pair[3], str(tmp_path))
    media, texts = tmp_path / "media", tmp_path / "texts"
    media.mkdir(), texts.mkdir()
    for name, seconds in (("a", 3), ("b", 30), ("c", 3), ("d", 3)):
        (media / f"{name}.wav").write_bytes(sinks.encode_wav(np.zeros(seconds * RATE), RATE))
    (media / "e.mp4").write_bytes(b"no decoder")
    for name, text in (("a", "اچھا متن"), ("b", "لمبا متن"), ("c", "x"), ("e", "اچھا متن")):
        (texts / f"{name}.txt").write_text(text, encoding="utf-8")
    cli.main(["prepare-flat", "--input_dir", str(media), "--transcript_dir", str(texts), "--output_dir", str(tmp_path / "flat")])
    shown = capsys.readouterr().out
    assert all(x in shown for x in ("too long", "invalid transcript", "no transcript", "unreadable"))
    rows = json.loads((tmp_path / "flat" / "manifest.json").read_text(encoding="utf-8"))
    assert [(m["audio_path"], m["duration"]) for m in rows] == [(f"{tmp_path}/flat/audio/a.wav", 3.0)] and (tmp_path / "flat" / "audio" / "a.wav").exists()


def spoken():
    """A model for tests: it tells the size of a file."""
    return lambda contents: [str(len(c)) if len(c) < 9 else 1 // 0 for c in contents]


def test_transcribe_and_compare(spark, tmp_path, monkeypatch, capsys):
    (tmp_path / "a.mp3").write_bytes(b"1234")
    (tmp_path / "long.mp3").write_bytes(b"1" * 20)
    paths = [str(tmp_path / x) for x in ("a.mp3", "long.mp3", "missing.mp3")]
    rows = {r.out: (r.transcript, bool(r.error)) for r in pipelines.transcribe(spark, paths, lambda: lambda cs: [str(len(c)) if len(c) < 9 else 1 // 0 for c in cs], "base").collect()}
    assert rows == {"a_base.txt": ("4", False), "long_base.txt": (None, True)}
    monkeypatch.setattr(cli, "named", lambda spec, default=None: lambda: lambda cs: [spec + str(len(c)) for c in cs])
    cli.main(["compare", paths[0], "--base", "x:b", "--finetuned", "x:f", "--out_dir", str(tmp_path / "out")])
    assert (tmp_path / "out" / "a_base.txt").read_text() == "x:b4" and (tmp_path / "out" / "a_finetuned.txt").read_text() == "x:f4"


def test_tokenise_and_detokenise(spark):
    rows = spark.createDataFrame([(1, "a b"), (2, "c")], "k int, text string")
    ids = models.tokenise(rows, "text", lambda: lambda ts: [[ord(w) for w in t.split()] for t in ts]).drop("error", "text")
    assert [r.labels for r in ids.orderBy("k").collect()] == [[97, 98], [99]]
    masked = ids.selectExpr("k", "concat(labels, array(-100)) AS labels")
    back = models.detokenise(masked, "labels", lambda: lambda xs: [" ".join(chr(i) for i in x if i) for x in xs], pad=0)
    assert [r.text for r in back.orderBy("k").collect()] == ["a b", "c"]


def test_columns_that_clash_are_named(spark):
    with pytest.raises(ValueError, match="error"):
        models.apply_model(spark.createDataFrame([(1, 2)], "x int, error int"), "x", lambda: list, "y", "int")
    from cuefold.functions import text as T

    with pytest.raises(ValueError, match="hits"):
        T.normalise(spark.createDataFrame([("a", 1)], "transcript string, hits int"))


def test_names_that_operators_add_must_be_free(spark):
    from pyspark.sql import functions as F

    from cuefold.functions import arrays
    from cuefold.operators import cues as C
    from cuefold.operators import numbering, pairing, split

    one = lambda *names: spark.range(1).select("id", *[F.lit(1).alias(n) for n in names])
    for f in (
        lambda: C.gap_sessions(one("Session"), ["id"], ["id"], F.col("id"), F.col("id"), 1), lambda: C.boundaries(one("gap")), lambda: C.tumbling(one("slice")), lambda: C.sliding(one("window")),
        lambda: numbering.numbered(one("place"), [F.col("id")], "place"), lambda: numbering.scanned(one("_at"), [], [F.col("id")], {"n": ("sum", F.lit(1), True)}),
        lambda: split.split_rows(one("SPLIT"), one("g"), "id"), lambda: pairing.join_back(one("matched"), one("audio_path"), F.lit("")), lambda: models.batches(one("batch"), ["id"], ["id"]),
        lambda: arrays.pad_and_mask(one("_bos"), "id", "id", 1),
    ):
        with pytest.raises(ValueError, match="rename"):
            f()


def test_scope_of_shared_tables(spark):
    from cuefold import storage

    outer = storage.written(spark.range(3), "outer")
    with storage.scope():
        inner = storage.gathered([spark.range(2), spark.range(3)], "inner")
        assert inner.count() == 5
    assert outer.count() == 3
    with pytest.raises(Exception):
        inner.count()


def test_resampling_keeps_the_band():
    t = np.arange(32_000) / 32_000
    low, high = np.sin(2 * np.pi * 440 * t), np.sin(2 * np.pi * 11_000 * t)
    out = files.resample(low + high, 32_000, 16_000)
    assert len(out) == 16_000 and np.abs(out - np.sin(2 * np.pi * 440 * np.arange(16_000) / 16_000))[200:-200].max() < 0.02
    assert np.allclose(files.resample(np.ones(100), 8_000, 44_100)[100:-100], 1)


def test_settled_tables(spark):
    """The tables on the way and those that were read go; others stay."""
    from cuefold import storage

    other, first = storage.written(spark.range(3), "other"), storage.settled(lambda: storage.written(spark.range(5), "way"), "first")
    second = storage.settled(lambda: storage.written(first, "way").where("id > 1"), "second", first)
    assert (other.count(), second.count()) == (3, 3)
    left = [p for _, p in storage._written]
    assert not any("-first-" in p for p in left) and sum("-second-" in p for p in left) == 1


def test_tables_of_other_threads_stay(spark):
    """A scope and a settled step delete what their own thread wrote, whatever others write meanwhile."""
    import threading

    from cuefold import storage

    kept, go, done = [], threading.Event(), threading.Event()

    def other():
        go.wait(60)
        kept.append(storage.written(spark.range(4), "thread"))
        with storage.scope():
            gone.append(storage.written(spark.range(5), "thread"))
        done.set()

    gone: list = []
    thread = threading.Thread(target=other)
    thread.start()
    with storage.scope():
        own = storage.written(spark.range(3), "own")
        go.set()
        assert done.wait(60)
        settled = storage.settled(lambda: storage.written(own, "step"), "settled", kept[0])  # kept is given as done: it goes
        assert own.count() == settled.count() == 3
    kept.clear()
    thread.join()
    before = storage.written(spark.range(2), "before")

    def late():
        kept.append(storage.written(spark.range(7), "late"))

    with storage.scope():
        thread = threading.Thread(target=late)
        thread.start()
        thread.join()
    assert before.count() == 2 and kept[0].count() == 7
    with pytest.raises(Exception):
        gone[0].count()


def test_small_functions(spark, tmp_path):
    from pyspark.sql import functions as F

    from cuefold.functions import text as T
    from cuefold.operators import cues as C

    moved = spark.createDataFrame([(0.01,), (-0.2,), (0.06,)], "shift double")
    assert sorted(r[0] for r in C.shifts(moved).collect()) == [-0.2, 0.06]
    one = spark.createDataFrame([([(" a\n",), ("b ",)], 4500.0)], "chunks array<struct<text:string>>, s double")
    assert tuple(one.select(T.chunks_to_text(F.col("chunks")), T.hours(F.col("s")), T.hours(F.lit(None).cast("double"))).first()) == ("a\nb", "1.25h", "0.00h")
    (tmp_path / "c.json").write_text('{"data": {"dataset_path": "x"}}')
    assert files.config(spark, str(tmp_path / "c.json"))["data"]["dataset_path"] == "x"
    (tmp_path / "c.txt").write_text("a: 1")
    try:
        import yaml  # noqa: F401
    except ImportError:
        with pytest.raises(ValueError, match="PyYAML"):
            files.config(spark, str(tmp_path / "c.txt"))
    sinks.metrics(spark.createDataFrame([("base", 1.5, ["p"])], "model string, wer double, predictions array<string>"), str(tmp_path / "m"))
    assert spark.read.json(str(tmp_path / "m")).columns == ["model", "wer"]
    for name in ("b.mkv", "a.webm", "c.mp4", "d.txt"):
        (tmp_path / name).write_bytes(b"x")
    assert [r.path.rsplit("/", 1)[1] for r in files.videos(spark, str(tmp_path)).collect()] == ["c.mp4", "b.mkv", "a.webm"]
    clips = spark.createDataFrame([("audio/v/a.wav", b"abc")], "path string, content binary")
    sinks.wav_files(clips, f"file://{tmp_path}/out")
    assert (tmp_path / "out" / "audio" / "v" / "a.wav").read_bytes() == b"abc" and len(list((tmp_path / "out" / "audio" / "v").iterdir())) == 1
