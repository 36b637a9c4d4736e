"""PCM WAV files read by ranges of samples: a recording of any length is decoded in many tasks, a block at a time."""

from __future__ import annotations

import os
import re
import struct
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from typing import BinaryIO, NamedTuple

import numpy as np

# The format tags of integer, float and extensible samples.
PCM, FLOAT, EXTENSIBLE = 1, 3, 0xFFFE


class Header(NamedTuple):
    rate: int
    channels: int
    width: int
    floats: bool
    data_at: int
    frames: int


def open_file(path: str) -> BinaryIO:
    """A file in any store that Arrow knows (local, HDFS, S3, GCS), at which a reader can seek."""
    from pyarrow import fs

    if re.match("file:/+|/", path) or "://" not in path:
        return open(re.sub("^file:/+", "/", path), "rb")
    store, at = fs.FileSystem.from_uri(path)
    return store.open_input_file(at)


@contextmanager
def create_file(path: str) -> Iterator[BinaryIO]:
    """A new file in any store that Arrow knows. On a local disk it gets its name when it is whole; object stores do so themselves."""
    from pyarrow import fs

    if re.match("file:/+|/", path) or "://" not in path:
        own = re.sub("^file:/+", "/", path)
        beside = f"{own}.{os.getpid()}"
        os.makedirs(os.path.dirname(own) or ".", exist_ok=True)
        with open(beside, "wb") as f:
            yield f
        os.replace(beside, own)
        return
    store, at = fs.FileSystem.from_uri(path)
    with store.open_output_stream(at) as f:
        yield f


def header(f: BinaryIO) -> Header:
    """What the chunks before the samples say. A file whose data chunk claims more than there is (a stream's header) ends where the file does."""
    if (top := f.read(12))[:4] != b"RIFF" or top[8:12] != b"WAVE":
        raise ValueError("no RIFF/WAVE file")
    at, kind = 12, None
    while True:
        f.seek(at)
        name = f.read(8)
        if len(name) < 8:
            raise ValueError("no data chunk")
        size = struct.unpack("<I", name[4:])[0]
        if name[:4] == b"fmt ":
            tag, channels, rate, _, align, bits = struct.unpack("<HHIIHH", f.read(16))
            if tag == EXTENSIBLE:
                tag = struct.unpack("<H", f.read(10)[8:10])[0]
            kind = tag, channels, rate, align // channels if channels else 0, bits
        elif name[:4] == b"data":
            break
        at += 8 + size + size % 2
    if kind is None:
        raise ValueError("no format before the samples")
    tag, channels, rate, width, bits = kind
    if not (tag == PCM and width in (1, 2, 3, 4) or tag == FLOAT and width in (4, 8)) or not rate:
        raise ValueError(f"format {tag} of {bits} bits at {rate} a second")
    f.seek(0, 2)
    size = min(size, f.tell() - at - 8)
    return Header(rate, channels, width, tag == FLOAT, at + 8, size // (width * channels))


def samples(raw: bytes, of: Header) -> np.ndarray:
    """Mono samples in -1..1 of raw frames."""
    if of.floats:
        x = np.frombuffer(raw, f"<f{of.width}").astype(np.float64)
    elif of.width == 1:
        x = (np.frombuffer(raw, np.uint8).astype(np.float64) - 128) / 128
    elif of.width == 3:
        b = np.frombuffer(raw, np.uint8).reshape(-1, 3).astype(np.int32)
        x = ((b[:, 0] << 8 | b[:, 1] << 16 | b[:, 2] << 24) >> 8) / float(1 << 23)
    else:
        x = np.frombuffer(raw, f"<i{of.width}").astype(np.float64) / float(1 << 8 * of.width - 1)
    return x.reshape(-1, of.channels).mean(1)


def read(f: BinaryIO, of: Header, begin: int, end: int) -> np.ndarray:
    """Frames begin to end as mono samples."""
    f.seek(of.data_at + begin * of.width * of.channels)
    return samples(f.read((end - begin) * of.width * of.channels), of)


def resampled_length(frames: int, rate: int, to: int) -> int:
    return frames if rate == to else int(frames * to / rate)


def resampled(part: Callable[[int, int], np.ndarray], frames: int, rate: int, to: int, begin: int, end: int, half: int = 16) -> np.ndarray:
    """Samples begin to end of a signal at another rate, by a windowed sinc of `half` zero crossings to each side, which keeps
    what lies above the lower rate's band out. part(a, b) gives samples a to b of the `frames` at the own rate; only those
    that the range needs are asked for, so ranges give what the whole gives."""
    if rate == to:
        return part(begin, end)
    share = min(1.0, to / rate)
    width = int(np.ceil(half / share))
    offsets = np.arange(1 - width, width + 1)
    out = np.empty(end - begin)
    for a in range(begin, end, 1 << 14):
        at = np.arange(a, min(end, a + (1 << 14))) * (rate / to)
        base = np.floor(at).astype(np.int64)
        low, high = int(base[0]) + 1 - width, int(base[-1]) + width + 1
        held = np.pad(part(max(0, low), min(frames, high)), (max(0, -low), max(0, high - frames)))
        x = offsets[None, :] - (at - base)[:, None]
        taps = np.sinc(share * x) * (0.5 + 0.5 * np.cos(np.pi * np.clip(x / width, -1, 1)))
        out[a - begin : a - begin + len(at)] = (held[base[:, None] + offsets[None, :] - low] * taps).sum(1) / taps.sum(1)
    return out
