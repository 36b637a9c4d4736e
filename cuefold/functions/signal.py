"""Framed energy and silence boundaries on ARRAY<DOUBLE> signals."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from cuefold.functions.arrays import let

# Samples of a frame and between frames, a dip's share of the median, seconds searched before a boundary.
FRAME, HOP, RATIO, BEFORE = 400, 160, 0.5, 0.5


def rms(signal: Column, frame: int = FRAME, hop: int = HOP) -> Column:
    """Root mean square of each frame; frames are centred and the ends padded with zeros.

    Squares are summed once, by pieces as long as frames and hops have in common; a frame adds its pieces."""
    half, step = frame // 2, math.gcd(frame, hop)
    zeros = F.array_repeat(F.lit(0.0), half)
    n = F.floor((F.size(signal) + F.lit(2 * half - frame)) / F.lit(hop)).cast("int")
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda s, x: s + x)
    squares = lambda a: F.aggregate(a, F.lit(0.0), lambda s, x: s + x * x)

    def pieces(padded: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.floor(F.size(padded) / step).cast("int") - 1), lambda i: squares(F.slice(padded, i * step + 1, F.lit(step))))

    def frames(parts: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), n), lambda i: F.sqrt(total(F.slice(parts, i * (hop // step) + 1, F.lit(frame // step))) / F.lit(float(frame))))

    return let(let(F.concat(zeros, signal.cast("array<double>"), zeros), pieces), frames)


def median(values: Column) -> Column:
    """The middle of the sorted values, or the mean of the two middle ones."""
    at = lambda s, k: F.get(s, F.floor((F.size(s) + k) / 2).cast("int"))
    return let(F.array_sort(values), lambda s: (at(s, F.lit(-1)) + at(s, F.lit(0))) / 2)


def first_least(values: Column) -> Column:
    """Index from 0 of the first minimum."""
    return (F.array_position(values, F.array_min(values)) - 1).cast("int")


def snap(signal: Column, rate: Column, nominal: Column, until: Column, frame: int = FRAME, hop: int = HOP, ratio: float = RATIO, before: float = BEFORE) -> Column:
    """The time of least energy from `before` seconds before nominal to until, where it is a clear dip; else nominal."""
    start = F.greatest(F.lit(0), ((nominal - before) * rate).cast("int"))
    end = F.least(F.size(signal), (until * rate).cast("int"))

    def boundary(energy: Column) -> Column:
        clear = let(median(energy), lambda middle: (middle > 0) & (F.array_min(energy) <= ratio * middle))
        return F.when(clear, (start + first_least(energy) * hop) / rate).otherwise(nominal)

    found = let(rms(F.slice(signal, start + 1, F.greatest(end - start, F.lit(0))), frame, hop), boundary)
    searched = until.isNotNull() & (until > nominal) & (end > start + frame)
    return F.when(searched, found).otherwise(nominal)


def clip(signal: Column, rate: Column, start: Column, end: Column) -> Column:
    """Samples from start to end seconds."""
    a, b = (start * rate).cast("int"), (end * rate).cast("int")
    return F.slice(signal, a + 1, F.greatest(b - a, F.lit(0)))
