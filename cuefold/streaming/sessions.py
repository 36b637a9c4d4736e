"""Gap sessions over a stream: keyed state, a watermark and timers.

Keys are dealt to BUCKETS groups by hash, as a call for a group costs milliseconds, whatever it holds: so calls don't grow
with the keys. A group's state holds, for each of its keys, the next session's number and the open sessions (start, end, rows). New rows extend, join or open
sessions. A session is closed, and comes out, when the watermark has passed its end by more than the gap, as no row
that is still accepted can reach it; so sessions come out in order and their numbers are final. Rows that start at or
before the watermark are late and dropped by Spark. A row belongs to the session before it unless it starts more than
the gap after that session's greatest end.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

STATE = "keys array<string>, nexts array<bigint>, opens array<bigint>, starts array<bigint>, ends array<bigint>, counts array<bigint>"
#: Groups that the keys are dealt to.
BUCKETS = 4096


def merged(open_: list[tuple[int, int, int]], gap: int) -> list[tuple[int, int, int]]:
    """Sessions (start, end, n) in order, joined where the next starts no more than gap after the end of the one before."""
    out: list[tuple[int, int, int]] = []
    for start, end, n in sorted(open_):
        if out and start - out[-1][1] <= gap:
            out[-1] = (out[-1][0], max(out[-1][1], end), out[-1][2] + n)
        else:
            out.append((start, end, n))
    return out


def advance(rows: list[tuple[int, int]], state: tuple[int, list], gap: int, watermark: int) -> tuple[list[tuple[int, int, int, int]], tuple[int, list]]:
    """Closed sessions (number, start, end, n) and the state after rows (start, end), all in microseconds."""
    number, held = state
    held = merged([*held, *[(a, b, 1) for a, b in rows]], gap)
    k = 0
    while k < len(held) and held[k][1] + gap < watermark:
        k += 1
    return [(number + i, *s) for i, s in enumerate(held[:k])], (number + k, held[k:])


def _as_text(key: Column, kind: str) -> Column:
    """A key as text: pandas would make floats of integers where some are null."""
    if kind == "timestamp":
        return F.unix_micros(key).cast("string")
    if kind == "binary":
        return F.hex(key)
    if kind in ("float", "double"):
        return (key + F.lit(0.0).cast(kind)).cast("string")  # -0.0 is 0.0
    return F.to_json(key) if "<" in kind else key.cast("string")


def _of_text(key: Column, kind: str) -> Column:
    if kind == "timestamp":
        return F.timestamp_micros(key.cast("long"))
    if kind == "binary":
        return F.unhex(key)
    return F.from_json(key, kind) if "<" in kind else key.cast(kind)


def _unpacked(held: tuple) -> dict:
    """The state of each key: its next number and its open sessions."""
    keys, nexts, opens, starts, ends, counts = held
    out, at = {}, 0
    for key, number, n in zip(keys, nexts, opens, strict=True):
        out[key] = (number, list(zip(starts[at : at + n], ends[at : at + n], counts[at : at + n], strict=True)))
        at += n
    return out


def _packed(held: dict) -> tuple:
    own = [s for _, open_ in held.values() for s in open_]
    return (list(held), [number for number, _ in held.values()], [len(open_) for _, open_ in held.values()], [s[0] for s in own], [s[1] for s in own], [s[2] for s in own])


def session_stream(rows: DataFrame, key: str, start: Column, end: Column, gap: float, late: str, buckets: int = BUCKETS) -> DataFrame:
    """key, session (from 0), start_us, end_us, n of the sessions of a streaming DataFrame, in append mode; `late` is how far
    behind the greatest start a row may come ("2 days"). gap is in seconds. Buckets must stay as they are for a checkpoint."""
    gap_us = int(gap * 1_000_000)
    kind = rows.select(key).schema[0].dataType.simpleString()
    slim = rows.select(_as_text(F.col(key), kind).alias("_key"), start.cast("timestamp").alias("_at"), F.unix_micros(end.cast("timestamp")).alias("_end"))
    slim = slim.withWatermark("_at", late).withColumn("_start", F.unix_micros("_at"))
    slim = slim.withColumn("_bucket", F.pmod(F.xxhash64("_key"), F.lit(buckets)))

    def step(own: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = _unpacked(state.get) if state.exists else {}
        for part in parts:  # rows are joined to the open sessions part by part
            new: dict = {}
            for k, a, b in zip(part["_key"].tolist(), part["_start"].tolist(), part["_end"].tolist(), strict=True):
                new.setdefault(k, []).append((a, b, 1))
            for k, own_rows in new.items():
                number, open_ = held.get(k, (0, []))
                held[k] = (number, merged([*open_, *own_rows], gap_us))
        watermark = state.getCurrentWatermarkMs() * 1000
        closed, first = [], None
        for k, before in held.items():
            # the number outlives the sessions, or a key that comes back would begin at 0 again
            done, held[k] = advance([], before, gap_us, watermark)
            closed += [(k, *c) for c in done]
            if held[k][1]:
                first = held[k][1][0][1] if first is None else min(first, held[k][1][0][1])
        state.update(_packed(held))
        if first is not None:
            state.setTimeoutTimestamp(max(state.getCurrentWatermarkMs() + 1, (first + gap_us) // 1000 + 1))
        yield pd.DataFrame(closed, columns=["_key", "session", "start_us", "end_us", "n"])

    out = "_key string, session long, start_us long, end_us long, n long"
    found = slim.groupBy("_bucket").applyInPandasWithState(step, out, STATE, "append", GroupStateTimeout.EventTimeTimeout)
    return found.select(_of_text(F.col("_key"), kind).alias(key), "session", "start_us", "end_us", "n")
