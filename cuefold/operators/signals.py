"""Signals in blocks: what is as long as a recording is never one row.

A table of blocks (video, block, rate, total, samples) holds `size` samples of a signal in a row, 32-bit floats as
bytes, little-endian; the last block is shorter. Whoever needs samples asks for ranges; a range meets the
blocks that it touches in a join by (video, block), and bytes are cut where they lie.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cuefold.functions import signal as S
from cuefold.functions import text as T
from cuefold.operators import cues as C

#: Samples of a block: 4 MB.
SIZE = 1 << 20
BLOCKS = "video string, block long, rate int, total long, samples binary"
_WIDTH = 4


def packed(samples) -> bytes:
    return np.ascontiguousarray(samples, "<f4").tobytes()


def unpacked(content: bytes) -> np.ndarray:
    return np.frombuffer(content, "<f4").astype(np.float64)


def pack(samples: Column) -> Column:
    """An array of numbers as bytes; null stays null."""
    return F.pandas_udf(lambda s: s.map(lambda x: None if x is None else packed(x)), "binary")(samples)


def unpack(samples: Column) -> Column:
    return F.pandas_udf(lambda s: s.map(lambda x: None if x is None else unpacked(x)), "array<double>")(samples)


def _joined(pieces: DataFrame, by: list[str], at: str, samples: str = "samples") -> DataFrame:
    """by and samples: the pieces of each group, in order of `at`, as one run of bytes."""
    held = F.array_sort(F.collect_list(F.struct(F.col(at).alias("at"), F.col(samples).alias("samples"))))
    return pieces.groupBy(*by).agg(F.aggregate(held, F.lit(b""), lambda done, p: F.concat(done, p["samples"])).alias("samples"))


def _cut(samples: Column, begin: Column, end: Column) -> Column:
    """Samples begin to end (numbers within the piece) of bytes."""
    return F.substring(samples, (begin * _WIDTH + 1).cast("int"), ((end - begin) * _WIDTH).cast("int"))


def reblocked(pieces: DataFrame, key_col: str = "video", size: int = SIZE) -> DataFrame:
    """Blocks of pieces (key, rate, at, samples), which lie one after the other: `at` is a piece's first sample."""
    end = F.col("at") + F.octet_length("samples") / F.lit(_WIDTH)
    rows = pieces.select(key_col, "rate", F.col("at").cast("long").alias("at"), end.cast("long").alias("end"), "samples").where("end > at")
    total = rows.groupBy(key_col).agg(F.max("end").alias("total"))
    touched = rows.withColumn("block", F.explode(F.sequence(F.expr(f"at div {size}"), F.expr(f"(end - 1) div {size}"))))
    first, last = F.greatest("at", F.col("block") * size), F.least("end", (F.col("block") + 1) * size)
    cut = touched.select(key_col, "block", "rate", first.alias("first"), _cut(F.col("samples"), first - F.col("at"), last - F.col("at")).alias("samples"))
    return _joined(cut, [key_col, "block", "rate"], "first").join(total, key_col).select(key_col, "block", "rate", "total", "samples")


def slices(blocks: DataFrame, ranges: DataFrame, by: list[str], key_col: str = "video", size: int = SIZE) -> DataFrame:
    """ranges (by, which holds the key and names each range, then begin and end) with samples, cut to the signal. Ranges without samples are left out."""
    asked = ranges.withColumns({"begin": F.greatest(F.lit(0), F.col("begin")).cast("long"), "end": F.col("end").cast("long")}).where("end > begin")
    asked = asked.withColumns({"_from": F.expr(f"begin div {size}"), "_to": F.expr(f"(end - 1) div {size}")})
    held = blocks.select(F.col(key_col).alias("_key"), F.col("block").alias("_block"), F.col("samples").alias("_samples"))
    first = F.col("_block") * size
    own = F.octet_length("_samples") / F.lit(_WIDTH)
    cut = _cut(F.col("_samples"), F.greatest(F.col("begin") - first, F.lit(0)), F.least(F.col("end") - first, own))
    met = lambda x: x.join(held, (F.col(key_col) == F.col("_key")) & (F.col("_at") == F.col("_block"))).withColumn("samples", cut).where(F.octet_length("samples") > 0)
    kept = ranges.columns
    within = met(asked.where("_from = _to").withColumn("_at", F.col("_from"))).select(*kept, "samples")
    across = met(asked.where("_from < _to").withColumn("_at", F.explode(F.sequence("_from", "_to"))))
    return within.unionByName(_joined(across, kept, "_block"))


def window_sums(x: np.ndarray, width: int) -> np.ndarray:
    """Sums of each `width` neighbours from running sums that begin anew every `width`: two additions each, whatever the width,
    and no subtraction, so that silence after noise keeps its digits."""
    if len(x) < width:
        return np.empty(0)
    n = len(x) - width + 1
    parts = np.pad(x, (0, -len(x) % width)).reshape(-1, width)
    before, after = parts.cumsum(1).ravel(), parts[:, ::-1].cumsum(1)[:, ::-1].ravel()
    at = np.arange(n)
    return np.where(at % width == 0, before[at + width - 1], after[at] + before[at + width - 1])


def frame_rms(samples: np.ndarray, frame: int = S.FRAME, hop: int = S.HOP, padded: bool = True) -> np.ndarray:
    """Root mean square of each frame, as functions.signal.rms; padded puts half a frame of zeros at both ends."""
    x = np.pad(samples, frame // 2) if padded else samples
    step = math.gcd(frame, hop)
    pieces = (x[: len(x) // step * step].reshape(-1, step) ** 2).sum(1)
    return np.sqrt(window_sums(pieces, frame // step)[:: hop // step] / frame)


def snapped(samples: np.ndarray, first: int, rate: float, nominal: float, frame: int, hop: int, ratio: float) -> float:
    """The time of least energy in samples from number `first` on where that is a clear dip, else nominal."""
    energy = frame_rms(samples, frame, hop)
    middle = np.median(energy)
    k = int(energy.argmin())
    return (first + k * hop) / rate if middle > 0 and energy[k] <= ratio * middle else nominal


def block_rms(blocks: DataFrame, key_col: str = "video", frame: int = S.FRAME, hop: int = S.HOP, size: int = SIZE) -> DataFrame:
    """key, block, first (frame) and rms of the frames that are centred in each block; a frame's samples may lie in the blocks beside."""
    half = frame // 2
    top = F.col("block") * size
    first = F.ceil(top / hop)
    most = F.floor((F.col("total") + 2 * half - frame) / hop)
    last = F.least(F.ceil((top + size) / hop) - 1, most)
    # frames are centred up to the signal's end, which may be one past its last block
    at_end = top + size >= F.col("total")
    asked = blocks.select(key_col, "block", first.alias("first"), F.when(at_end, most).otherwise(last).alias("last")).where("last >= first")
    asked = asked.withColumns({"lead": F.greatest(F.lit(0), F.lit(half) - F.col("first") * hop).cast("int"), "begin": F.col("first") * hop - half, "end": F.col("last") * hop - half + frame})
    got = slices(blocks, asked, [key_col, "block"], key_col, size)

    def energies(samples: pd.Series, lead: pd.Series, n: pd.Series) -> pd.Series:
        out = []
        for s, a, k in zip(samples, lead, n, strict=True):
            x = np.zeros((k - 1) * hop + frame)
            own = unpacked(s)[: len(x) - a]
            x[a : a + len(own)] = own
            out.append(frame_rms(x, frame, hop, padded=False))
        return pd.Series(out)

    return got.select(key_col, "block", "first", F.pandas_udf(energies, "array<double>")("samples", "lead", F.col("last") - F.col("first") + 1).alias("rms"))


def block_boundaries(
    windows: DataFrame, blocks: DataFrame, key_col: str = "video", gap: float = C.GAP, pad: float = C.PAD, search: float = 1.0,
    frame: int = S.FRAME, hop: int = S.HOP, ratio: float = S.RATIO, before: float = S.BEFORE, size: int = SIZE,
) -> DataFrame:
    """key, rate, chunk_idx, chunk_start, chunk_end: boundaries snapped to silence, looking only at the samples around each."""
    signals = blocks.groupBy(key_col).agg(F.max("rate").cast("double").alias("rate"), F.max("total").alias("total"))
    order = Window.partitionBy(key_col).orderBy("chunk_idx")
    rows = windows.select(key_col, "chunk_idx", "start", "end").join(signals, key_col).withColumn("following", F.lead("start").over(order))
    far = F.col("following") - F.col("end") > gap
    rows = rows.withColumn("until", F.when(far, F.col("end") + F.least(F.lit(search), F.col("following") - F.col("end"))).otherwise(F.col("following")))
    begin = F.greatest(F.lit(0), ((F.col("end") - before) * F.col("rate")).cast("long"))
    stop = F.least(F.col("total"), (F.col("until") * F.col("rate")).cast("long"))
    asked = rows.where((F.col("until") > F.col("end")) & (stop > begin + frame)).select(key_col, "chunk_idx", "rate", F.col("end").alias("nominal"), begin.alias("begin"), stop.alias("end"))

    def found(samples: pd.Series, first: pd.Series, rate: pd.Series, nominal: pd.Series) -> pd.Series:
        return pd.Series([snapped(unpacked(s), a, r, t, frame, hop, ratio) for s, a, r, t in zip(samples, first, rate, nominal, strict=True)], dtype="float64")

    cut = slices(blocks, asked, [key_col, "chunk_idx"], key_col, size)
    moved = cut.select(key_col, "chunk_idx", F.pandas_udf(found, "double")("samples", "begin", "rate", "nominal").alias("moved"))
    rows = rows.join(moved, [key_col, "chunk_idx"], "left")
    closed = F.least(F.col("total") / F.col("rate"), F.col("end") + pad)
    rows = rows.withColumn("chunk_end", F.when(F.col("following").isNull(), closed).otherwise(F.coalesce("moved", "end")))
    shared, own = F.lag("chunk_end").over(order), F.col("start") - pad
    torn = F.col("start") - F.lag("end").over(order) > gap
    opened = F.when(shared.isNull(), F.greatest(F.lit(0.0), own)).when(torn, F.greatest(shared, own)).otherwise(shared)
    return rows.withColumn("chunk_start", opened).select(key_col, "rate", "chunk_idx", "chunk_start", "chunk_end")


def chunks_of_blocks(cues: DataFrame, blocks: DataFrame, key_col: str = "video", most: float = C.MAX_DURATION, size: int = SIZE) -> DataFrame:
    """key, chunk_idx, chunk_start, chunk_end, duration, transcript, samples (bytes), rate: cues and blocks to clips, as cues.chunks_of_audio."""
    bounds = block_boundaries(C.group_cues(cues, key_col, max(1.0, most - C.SAFETY)), blocks, key_col, size=size)
    said = C.reassign(cues, bounds, key_col).where(T.valid_transcript(F.col("text"))).select(key_col, "chunk_idx", F.col("text").alias("transcript"))
    end = F.least(F.col("chunk_end"), F.col("chunk_start") + most)
    clips = bounds.join(said, [key_col, "chunk_idx"]).withColumn("chunk_end", end).withColumn("duration", F.col("chunk_end") - F.col("chunk_start"))
    named = clips.select("*", (F.col("chunk_start") * F.col("rate")).cast("long").alias("begin"), (F.col("chunk_end") * F.col("rate")).cast("long").alias("end"))
    cut = slices(blocks, named.select(key_col, "chunk_idx", "begin", "end"), [key_col, "chunk_idx"], key_col, size).select(key_col, "chunk_idx", "samples")
    rows = clips.join(cut, [key_col, "chunk_idx"], "left").withColumn("samples", F.coalesce("samples", F.lit(b"")))
    return rows.select(key_col, "chunk_idx", "chunk_start", "chunk_end", "duration", "transcript", "samples", "rate")
