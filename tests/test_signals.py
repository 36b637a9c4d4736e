"""Signals in blocks against whole signals, and WAV files by ranges."""

import io
import struct
import wave

import numpy as np
import pytest
from pyspark.sql import functions as F

from cuefold.operators import cues as C
from cuefold.operators import signals as G
from cuefold.sources import files, sinks, wav


def blocks_of(spark, signals, rate, size):
    rows = [(v, k, rate, len(x), G.packed(x[k * size : (k + 1) * size])) for v, x in signals.items() for k in range(-(-len(x) // size))]
    return spark.createDataFrame(rows, G.BLOCKS)


def rms(x, frame, hop):
    p = np.pad(np.asarray(x, float), frame // 2)
    return np.array([np.sqrt(np.mean(p[k * hop : k * hop + frame] ** 2)) for k in range(1 + (len(p) - frame) // hop)])


@pytest.mark.parametrize("frame, hop", [(400, 160), (8, 4), (6, 9), (5, 5), (7, 2)])
def test_energies_do_not_depend_on_blocks(spark, frame, hop):
    rng = np.random.default_rng(frame)
    signals = {f"v{n}": rng.normal(size=n).astype(np.float32) * (1e6 if n % 2 else 1) for n in (1, 7, 64, 999, 1000, 1001, 2503)}
    got = {}
    for r in G.block_rms(blocks_of(spark, signals, 100, 500), frame=frame, hop=hop, size=500).collect():
        got.setdefault(r.video, []).append((r.first, r.rms))
    for v, x in signals.items():
        have = np.concatenate([e for _, e in sorted(got.get(v, []))]) if v in got else np.empty(0)
        want = rms(x, frame, hop)
        assert len(have) == len(want) and np.allclose(have, want), (v, len(have), len(want))
        assert np.allclose(G.frame_rms(x, frame, hop), want)


def test_silence_after_noise_keeps_its_digits():
    x = np.concatenate([np.full(4000, 1e9), np.full(4000, 1e-9)])
    assert np.allclose(G.frame_rms(x)[30:-3], 1e-9, rtol=1e-6)


def test_slices_and_blocks_of_pieces(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=1234).astype(np.float32)
    cuts = [0, 3, 3, 500, 1000, 1234]
    pieces = spark.createDataFrame([("v", 10, a, G.packed(x[a:b])) for a, b in zip(cuts, cuts[1:], strict=False)], "video string, rate int, at long, samples binary")
    blocks = G.reblocked(pieces, size=100)
    rows = sorted(blocks.collect(), key=lambda r: r.block)
    assert [len(r.samples) for r in rows] == [400] * 12 + [136] and b"".join(r.samples for r in rows) == G.packed(x) and rows[0].total == 1234
    asked = [(k, int(a), int(b)) for k, (a, b) in enumerate([(0, 1), (0, 1234), (99, 101), (100, 200), (1200, 5000), (-5, 5), (7, 7), (2000, 3000)])]
    got = {r.k: G.unpacked(r.samples) for r in G.slices(blocks, spark.createDataFrame(asked, "k int, begin long, end long").withColumn("video", F.lit("v")), ["video", "k"], size=100).collect()}
    assert set(got) == {0, 1, 2, 3, 4, 5}
    assert all(np.array_equal(got[k], x[max(0, a) : max(0, b)]) for k, a, b in asked if k in got)


def test_chunks_of_blocks_as_of_whole_signals(spark):
    """The block size doesn't matter, and the result is that of one row a signal."""
    rng, rate = np.random.default_rng(3), 1000
    frames, signals = [], {}
    for v in range(4):
        x = rng.normal(size=60 * rate).astype(np.float32)
        t, rows = 0.4, []
        while t < 55:
            d = float(rng.choice([2.0, 4.0, 6.0]))
            rows.append((f"v{v}", len(rows), t, t + d, f"w{len(rows)}" + rng.choice(["", "۔", "،"])))
            x[int((t + d) * rate) : int((t + d + 0.3) * rate)] *= 0.01
            t += d + float(rng.choice([0.25, 0.5, 3.5]))
        frames += rows
        signals[f"v{v}"] = x
    cues = spark.createDataFrame(frames, "video string, idx int, start double, end double, text string")
    whole = spark.createDataFrame([(v, rate, x.astype(float).tolist()) for v, x in signals.items()], "video string, rate int, samples array<double>")
    want = {(r.video, r.chunk_idx): r for r in C.chunks_of_audio(cues, whole, most=20.0).collect()}
    for size in (777, 1 << 20):
        got = {(r.video, r.chunk_idx): r for r in G.chunks_of_blocks(cues, blocks_of(spark, signals, rate, size), most=20.0, size=size).collect()}
        assert set(got) == set(want) and len(want) > 8
        for k, r in got.items():
            assert r.transcript == want[k].transcript and r.chunk_start == pytest.approx(want[k].chunk_start) and r.chunk_end == pytest.approx(want[k].chunk_end)
            assert np.allclose(G.unpacked(r.samples), want[k].samples)


def wav_of(x, rate, width, channels=1, extensible=False):
    """A WAV file of 8, 16, 24 or 32 bits; a chunk of notes stands before the samples."""
    top = 1 << 8 * width - 1
    n = np.clip(np.round(np.asarray(x) * top), -top, top - 1).astype(np.int64)
    raw = b"".join(int(v + (128 if width == 1 else 0)).to_bytes(width, "little", signed=width > 1) for v in n for _ in range(channels))
    fmt = struct.pack("<HHIIHH", 0xFFFE if extensible else 1, channels, rate, rate * width * channels, width * channels, 8 * width)
    if extensible:
        fmt += struct.pack("<HHIH", 22, 8 * width, 0, 1) + b"\x00" * 14
    body = b"fmt " + struct.pack("<I", len(fmt)) + fmt + b"note" + struct.pack("<I", 3) + b"abc\x00" + b"data" + struct.pack("<I", len(raw)) + raw
    return b"RIFF" + struct.pack("<I", 4 + len(body)) + b"WAVE" + body


@pytest.mark.parametrize("width", [1, 2, 3, 4])
def test_wav_of_all_widths(width):
    x = np.sin(np.arange(300) / 9) * 0.9
    for channels, extensible in ((1, False), (2, True)):
        rate, got = files.decode_wav(wav_of(x, 8000, width, channels, extensible))
        assert rate == 8000 and np.allclose(got, x, atol=1.01 / (1 << 8 * width - 1))
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(2)
        w.setframerate(8000)
        w.writeframes(b"\x00\x40" * 5)
    assert np.allclose(files.decode_wav(out.getvalue())[1], 0.5)
    for bad in (b"", b"RIFF", b"RIFF\x00\x00\x00\x00WAVEfmt "):
        with pytest.raises(Exception):
            files.decode_wav(bad)


def test_ranges_of_files_are_the_whole_file(spark, tmp_path):
    rng = np.random.default_rng(5)
    signals = {"a": (rng.uniform(-0.9, 0.9, 5000), 8000, 3), "b": (rng.uniform(-0.9, 0.9, 4801), 16000, 2), "c c": (rng.uniform(-0.9, 0.9, 3000), 44100, 2), "z": (np.empty(0), 16000, 2)}
    for name, (x, rate, width) in signals.items():
        (tmp_path / f"{name}.wav").write_bytes(wav_of(x, rate, width, 2))
    (tmp_path / "bad.wav").write_bytes(b"no")
    for options in ({"size": 1000}, {"size": 1000, "decode": files.decode_wav}):
        got, bad = {}, []
        for r in files.audio_blocks(spark, str(tmp_path / "*.wav"), **options).collect():
            assert r.samples is None or len(r.samples) <= 4000
            if r.error:
                bad.append(r.video)
            else:
                got.setdefault(r.video, {})[r.block] = r
        assert bad == ["bad"] and set(got) == set(signals)
        for name, (x, rate, width) in signals.items():
            own, y = files.decode_wav(wav_of(x, rate, width, 2))
            want = files.resample(y, own, 16000)
            have = np.concatenate([G.unpacked(got[name][k].samples) for k in sorted(got[name])])
            assert got[name][0].total == len(want) == len(have) and np.allclose(have, want, atol=1e-6)
    seen = {r.video: r for r in files.probe(spark, str(tmp_path / "*.wav")).collect()}
    assert seen["b"].duration == 4801 / 16000 and (seen["c c"].rate, seen["c c"].channels) == (44100, 2) and seen["bad"].error and seen["z"].frames == 0


def test_ten_hours_are_never_one_row(spark, tmp_path):
    rate, n = 8000, 10 * 3600 * 8000
    with open(tmp_path / "long.wav", "wb") as f:
        f.write(b"RIFF" + struct.pack("<I", 36 + n) + b"WAVEfmt " + struct.pack("<IHHIIHH", 16, 1, 1, rate, rate, 1, 8) + b"data" + struct.pack("<I", n))
        f.truncate(44 + n)
    rows = files.audio_blocks(spark, str(tmp_path / "long.wav"), rate)
    got = rows.agg(F.count("*").alias("n"), F.max(F.octet_length("samples")).alias("most"), F.sum(F.octet_length("samples")).alias("all"), F.count("error").alias("bad")).first()
    assert got.n == -(-n // G.SIZE) and got.most == 4 * G.SIZE < 8 << 20 and got["all"] == 4 * n and got.bad == 0


def test_clips_of_bytes():
    x = np.array([0.0, 0.5, -0.5])
    assert sinks.encode_wav(G.packed(x), 8000) == sinks.encode_wav(x, 8000)
    assert wav.resampled_length(5, 8000, 16000) == 10
