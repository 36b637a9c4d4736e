"""Writers of manifests, datasets, sidecars, metrics, text and audio clips."""

from __future__ import annotations

import io
import uuid
import wave
from collections.abc import Callable, Iterator
from typing import BinaryIO

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from cuefold.batches import bounded
from cuefold.operators import signals
from cuefold.sources import json_arrays, ledger, wav

def json_lines(rows: DataFrame, path: str) -> None:
    """The scalable manifest: a folder of JSON lines, written in parallel."""
    rows.write.mode("overwrite").json(path)


def _put(spark: SparkSession, path: str, text: str) -> None:
    """A small text, written beside the target and renamed over it, so that a reader sees the old file or the new one."""
    beside = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}")
    out = beside.getFileSystem(spark._jsc.hadoopConfiguration()).create(beside, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    json_arrays.replace(spark, beside, path)


def json_array(rows: DataFrame, path: str, pos_col: str = "pos") -> None:
    """One file with one array in order of pos, for tools that ask for it; its fragments are written in parallel."""
    json_arrays.write(rows, path, pos_col)


def manifest(rows: DataFrame, path: str) -> None:
    """rows (with pos) as a manifest: an array where the path ends in .json, one more batch of an append-only log where it ends in .log
    (rows whose audio_path is there already add nothing), else a folder of JSON lines; all written in parallel."""
    if path.endswith(".log"):
        ledger.append(rows.sparkSession, path, rows, uuid.uuid4().hex, "audio_path", ["pos"])
    elif path.endswith(".json"):
        json_array(rows, path)
    else:
        json_lines(rows, path)


def normalised_path(path: str, in_place: bool) -> str:
    """The input itself, or manifest_normalized beside it, of the same kind. A log only grows: its rewritten manifest is a folder of JSON lines."""
    if in_place and path.endswith(".log"):
        raise ValueError("a log can't be rewritten in place")
    return path if in_place else path.rpartition("/")[0] + "/manifest_normalized" + (".json" if path.endswith(".json") else ".jsonl")


def converted_path(root: str, output: str | None = None, folder: str | None = None, name: str = "manifest_reviewed.json") -> str:
    """An explicit output, else in the forced folder, else in the root."""
    return output or (f"{root}/{folder}/{name}" if folder else f"{root}/{name}")


def dataset(rows: DataFrame, path: str) -> None:
    """Parquet by split; what was there before goes."""
    rows.write.mode("overwrite").partitionBy("split").parquet(path)


def sidecar(rows: DataFrame, path: str) -> None:
    """episode, sentence, buckets of the held-out rows in order."""
    json_array(rows.where(F.col("split") == "eval").select("pos", "episode", "sentence", "buckets"), path)


def metrics(rows: DataFrame, path: str) -> None:
    rows.drop("predictions").write.mode("overwrite").json(path)


def text(spark: SparkSession, content: str, path: str) -> None:
    _put(spark, path, content)


def encode_wav(samples, rate: int) -> bytes:
    """A mono PCM WAV file of 16 bits, of numbers or of floats as bytes."""
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(2)
        w.setframerate(int(rate))
        own = signals.unpacked(samples) if isinstance(samples, bytes) else np.asarray(samples, float)
        w.writeframes(np.clip(np.round(own * 32767), -32768, 32767).astype("<i2").tobytes())
    return out.getvalue()


def waves(rows: DataFrame) -> DataFrame:
    """rows (other columns, samples, rate) with content, a WAV file, in their place: a table, which any store takes."""
    others = [f for f in rows.schema if f.name not in ("samples", "rate")]

    def encoded(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            content = [encode_wav(s, r) for s, r in zip(part["samples"], part["rate"], strict=True)]
            yield part[[f.name for f in others]].assign(content=content)

    return bounded(rows).mapInPandas(encoded, StructType([*others, StructField("content", BinaryType())]))


def clips(chunks: DataFrame) -> DataFrame:
    """video, chunk_idx, path and content (a WAV file) of each clip."""
    path = F.format_string("audio/%s/%s_%03d.wav", "video", "video", "chunk_idx")
    return waves(chunks.select("video", "chunk_idx", path.alias("path"), "samples", F.col("rate").cast("int").alias("rate")))


def wav_files(clips: DataFrame, root: str, create: Callable[[str], BinaryIO] = wav.create_file) -> None:
    """Each clip as a file below root, in any store that Arrow knows; a local folder must be one that all workers see. A file is there
    whole or not at all, and a retried task writes the same files again."""

    def put(rows) -> None:
        for r in rows:
            with create(f"{root}/{r.path}") as f:
                f.write(r.content)

    clips.select("path", "content").foreachPartition(put)
