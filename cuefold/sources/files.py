"""Readers of manifests, subtitles, listings, lexicons, audio and datasets."""

from __future__ import annotations

import io
import json
from collections.abc import Callable, Iterator
from typing import BinaryIO

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cuefold import schemas
from cuefold.batches import bounded
from cuefold.functions import ids
from cuefold.operators import signals
from cuefold.operators.numbering import numbered
from cuefold.sources import json_arrays, ledger, wav
from cuefold.storage import written


#: Names of a folder's manifest.
MANIFESTS = ("manifest.json", "manifest.jsonl")


def _exists(spark: SparkSession, path: str) -> bool:
    """Whether a path or glob matches anything, in whatever store it names."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = at.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(at)
    return bool(found)


def json_array(spark: SparkSession, path: str | list[str], schema: str) -> DataFrame:
    """file, pos and the columns of files that hold one JSON array each, read by ranges; pos is the place in the array."""
    return json_arrays.read(spark, path, schema)


def _is_array(path: str) -> bool:
    return path.endswith(".json")


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """pos and the manifest's columns: of an array where the path ends in .json, of an append-only log where it ends in .log, else of a folder of JSON lines."""
    if path.endswith(".log"):
        return ledger.read(spark, path, "pos long, " + schemas.MANIFEST)
    if not _is_array(path):
        return spark.read.schema("pos long, " + schemas.MANIFEST).json(path)
    return json_array(spark, path, schemas.MANIFEST).drop("file")


def reviewed(spark: SparkSession, path: str) -> DataFrame:
    """pos and the columns of a reviewed export: an array where the path ends in .json, else JSON lines, whose pos is their order by file and place if they have none."""
    if _is_array(path):
        return json_array(spark, path, schemas.REVIEWED).drop("file")
    rows = spark.read.schema("pos long, " + schemas.REVIEWED).json(path).withColumn("_file", F.col("_metadata.file_path"))
    rows = written(rows.withColumn("_place", F.monotonically_increasing_id()), "reviewed")
    if rows.where("pos IS NULL").isEmpty():
        return rows.drop("_file", "_place")
    return numbered(rows.drop("pos"), [F.col("_file"), F.col("_place")], "pos").withColumn("pos", F.col("pos") - 1).drop("_file", "_place")


def manifests(spark: SparkSession, root: str, names: tuple[str, ...] = MANIFESTS) -> DataFrame:
    """All <root>/<folder>/<name> with their folder: arrays, and folders of JSON lines where the name does not end in .json."""
    out = spark.createDataFrame([], f"pos long, {schemas.MANIFEST}, folder string")
    for name in names:
        path = f"{root}/*/{name}"
        if not _exists(spark, path):
            continue
        if _is_array(name):
            rows = json_array(spark, path, schemas.MANIFEST)
        else:
            rows = spark.read.schema("pos long, " + schemas.MANIFEST).json(path).withColumn("file", F.col("_metadata.file_path"))
        folder = F.element_at(F.split(F.split_part("file", F.lit(f"/{name}"), F.lit(1)), "/"), -1)
        out = out.unionByName(rows.withColumn("folder", folder).select(out.columns))
    return out


def optional_manifest(spark: SparkSession, path: str) -> DataFrame:
    """The manifest, or no rows where there is none."""
    there = ledger.exists(spark, path) if path.endswith(".log") else _exists(spark, path)
    return manifest(spark, path) if there else spark.createDataFrame([], "pos long, " + schemas.MANIFEST)


def listing(spark: SparkSession, folder: str, extensions: tuple[str, ...] = ()) -> DataFrame:
    """path and length of the files in a folder with one of the extensions; contents aren't read."""
    rows = spark.read.format("binaryFile").load(folder).select("path", "length")
    return rows.where(ids.suffix(F.col("path")).isin(*extensions)) if extensions else rows


def below(spark: SparkSession, root: str, names: str) -> DataFrame:
    """path and length of the files of such names in all folders below root, which Spark lists in parallel; contents aren't read."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", names).load(root).select("path", "length")


def videos(spark: SparkSession, folder: str) -> DataFrame:
    """Listing of video files, .mp4 first, then .mkv, then .webm."""
    rank = F.array_position(F.array(*[F.lit(e) for e in ids.VIDEO_EXTENSIONS]), ids.suffix(F.col("path")))
    return listing(spark, folder, ids.VIDEO_EXTENSIONS).orderBy(rank, "path")


def whole_texts(spark: SparkSession, path: str | list[str], strip: bool = True) -> DataFrame:
    """path, value of whole text files."""
    rows = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value")
    return rows.withColumn("value", F.regexp_replace("value", r"(?U)^\s+|\s+$", "")) if strip else rows


def subtitles(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """video (the file's stem) and value of subtitle files, for parse_subtitles."""
    rows = whole_texts(spark, path, strip=False)
    return rows.select(ids.stem(F.col("path")).alias("video"), "value")


def terms(spark: SparkSession, path: str) -> list[str]:
    """Spiritual terms, then Arabic phrases, of a lexicon file; none where it is missing."""
    if not _exists(spark, path):
        return []
    groups = lexicon(spark, path)
    return groups["spiritual_terms"] + groups["arabic_phrases"]


def lexicon(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """The lexicon's three lists: configuration, of a few hundred terms."""
    row = spark.read.schema(schemas.LEXICON).option("multiLine", True).json(path).first()
    return {k: list(row[k] or []) for k in ("spiritual_terms", "arabic_phrases", "english_domain")}


def config(spark: SparkSession, path: str) -> dict:
    """Nested settings of a JSON file, or of a YAML file where a YAML library is installed."""
    text = whole_texts(spark, path).first().value
    if path.endswith(".json"):
        return json.loads(text)
    try:
        import yaml
    except ImportError as e:
        raise ValueError("a YAML file needs PyYAML; JSON needs nothing") from e
    return yaml.safe_load(text)


def corrections(spark: SparkSession, path: str) -> dict[str, str]:
    return dict(spark.read.schema(schemas.CORRECTIONS).option("multiLine", True).json(path).first()["corrections"] or {})


def decode_wav(content: bytes) -> tuple[int, np.ndarray]:
    """Rate and mono samples in -1..1 of a WAV file of 8, 16, 24 or 32 bits, or of floats."""
    f = io.BytesIO(content)
    of = wav.header(f)
    return of.rate, wav.read(f, of, 0, of.frames)


def resample(samples: np.ndarray, rate: int, to: int, half: int = 16) -> np.ndarray:
    """Samples at another rate, as wav.resampled."""
    x = np.asarray(samples, float)
    return wav.resampled(lambda a, b: x[a:b], len(x), rate, to, 0, wav.resampled_length(len(x), rate, to), half)


def audio(spark: SparkSession, path: str | list[str], rate: int = 16_000, decode: Callable[[bytes], tuple[int, np.ndarray]] = decode_wav) -> DataFrame:
    """video, rate, samples, error of short audio files as mono signals, one row each; a file that can't be read has its error and
    no samples. Recordings belong in audio_blocks.

    WAV is decoded here; `decode` (bytes to rate and mono samples) reads other formats with what the workers have."""

    def decoded(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for r in part.itertuples(index=False):
                try:
                    own, samples = decode(r.content)
                    row = (r.video, rate, resample(samples, own, rate), None)
                except Exception as e:  # one bad file doesn't end the job
                    row = (r.video, rate, None, f"{type(e).__name__}: {e}")
                yield pd.DataFrame([row], columns=["video", "rate", "samples", "error"])

    files = spark.read.format("binaryFile").load(path).select(ids.stem(F.col("path")).alias("video"), "content")
    return bounded(files).mapInPandas(decoded, "video string, rate int, samples array<double>, error string")


_PROBED = "path string, video string, rate int, channels int, frames long, duration double, error string"


def probe(spark: SparkSession, path: str | list[str], open_: Callable[[str], BinaryIO] = wav.open_file) -> DataFrame:
    """path, video, rate, channels, frames, duration, error of WAV files, from their headers; samples aren't read."""

    def read(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            rows = []
            for r in part.itertuples(index=False):
                try:
                    with open_(r.path) as f:
                        h = wav.header(f)
                    rows.append((r.path, r.video, h.rate, h.channels, h.frames, h.frames / h.rate, None))
                except Exception as e:
                    rows.append((r.path, r.video, None, None, None, None, f"{type(e).__name__}: {e}"))
            out = pd.DataFrame(rows, columns=["path", "video", "rate", "channels", "frames", "duration", "error"])
            yield out.astype({"rate": "Int32", "channels": "Int32", "frames": "Int64"})

    found = spark.read.format("binaryFile").load(path).select("path", ids.stem(F.col("path")).alias("video"))
    return found.mapInPandas(read, _PROBED)


_BLOCKS = signals.BLOCKS + ", error string"


def audio_blocks(
    spark: SparkSession, path: str | list[str], rate: int = 16_000, decode: Callable[[bytes], tuple[int, np.ndarray]] | None = None,
    open_: Callable[[str], BinaryIO] = wav.open_file, size: int = signals.SIZE,
) -> DataFrame:
    """video, block, rate, total, samples (floats as bytes), error of audio files as mono signals in blocks of `size` samples.

    WAV files are read by ranges: a task opens the file, seeks, and decodes and resamples one block, so no row holds more than a
    block. `decode` (bytes to rate and mono samples) reads other formats, each file whole, and so do stores that only Spark can
    open (decode=decode_wav). A file that can't be read has one row, with its error and no block."""

    def row(video, block, total, samples, error=None) -> pd.DataFrame:
        out = pd.DataFrame([(video, block, rate, total, samples, error)], columns=["video", "block", "rate", "total", "samples", "error"])
        return out.astype({"block": "Int64", "total": "Int64"})

    def whole(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for r in part.itertuples(index=False):
                try:
                    own, x = decode(r.content)
                except Exception as e:
                    yield row(r.video, None, None, None, f"{type(e).__name__}: {e}")
                    continue
                x = np.asarray(x, float)
                total = wav.resampled_length(len(x), own, rate)
                for k in range(max(1, -(-total // size))):
                    yield row(r.video, k, total, signals.packed(wav.resampled(lambda a, b: x[a:b], len(x), own, rate, k * size, min(total, (k + 1) * size))))  # noqa: B023

    def ranges(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for r in part.itertuples(index=False):
                if r.error is not None:
                    yield row(r.video, None, None, None, r.error)
                    continue
                try:
                    with open_(r.path) as f:
                        h = wav.header(f)
                        x = wav.resampled(lambda a, b: wav.read(f, h, a, b), h.frames, h.rate, rate, int(r.block) * size, min(int(r.total), (int(r.block) + 1) * size))  # noqa: B023
                    yield row(r.video, int(r.block), int(r.total), signals.packed(x))
                except Exception as e:
                    yield row(r.video, None, None, None, f"{type(e).__name__}: {e}")

    if decode is not None:
        files = spark.read.format("binaryFile").load(path).select(ids.stem(F.col("path")).alias("video"), "content")
        return bounded(files).mapInPandas(whole, _BLOCKS)
    total = F.when(F.col("rate") == rate, F.col("frames")).otherwise(F.floor(F.col("frames") * F.lit(rate) / F.col("rate"))).cast("long")
    found = probe(spark, path, open_).withColumn("total", total)
    blocks = found.select("path", "video", "total", "error", F.explode(F.when(F.col("error").isNull(), F.sequence(F.lit(0).cast("long"), F.expr(f"greatest(total - 1, 0) div {size}"))).otherwise(F.array(F.lit(0).cast("long")))).alias("block"))
    return blocks.repartition("path", "block").mapInPandas(ranges, _BLOCKS)


def duration(signals: DataFrame) -> DataFrame:
    """signals with duration in seconds."""
    return signals.withColumn("duration", F.size("samples") / F.col("rate"))


def sidecar(spark: SparkSession, path: str) -> DataFrame | None:
    """pos, episode, sentence, buckets beside a dataset, or None where there is none."""
    return json_array(spark, path, schemas.SIDECAR).drop("file") if _exists(spark, path) else None


def listed(spark: SparkSession, paths: list[str]) -> DataFrame:
    """path and content of the files of a list; those that don't exist are skipped."""
    found = [p for p in paths if _exists(spark, p)]
    return spark.read.format("binaryFile").load(found).select("path", "content") if found else spark.createDataFrame([], "path string, content binary")


def mark_live(manifests: DataFrame, listing: DataFrame, path_col: str = "audio_path") -> DataFrame:
    """manifests with live: whether the path, its slashes of either kind, is in the listing."""
    form = lambda c: F.regexp_replace(F.replace(c, F.lit("\\"), F.lit("/")), "^file:/+", "/")
    there = listing.select(form(F.col("path")).alias("_path")).distinct().withColumn("_live", F.lit(True))
    rows = manifests.withColumn("_path", form(F.col(path_col))).join(there, "_path", "left")
    return rows.withColumn("live", F.coalesce("_live", F.lit(False))).drop("_path", "_live")


def dataset(spark: SparkSession, path: str, split: str | None = None) -> DataFrame:
    """A dataset written by sinks.dataset; one split reads only its partition."""
    rows = spark.read.parquet(path)
    return rows.where(F.col("split") == split) if split else rows
