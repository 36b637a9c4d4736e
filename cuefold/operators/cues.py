"""Cues and windows: subtitle parsing, greedy grouping, boundaries, reassignment, slices."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cuefold.columns import free
from cuefold.functions import signal as S
from cuefold.functions import text as T
from cuefold.operators.numbering import scanned
from cuefold.storage import written

# Seconds of a gap that parts windows, of a clip at most, of room for snapping, of a pad; the form of a subtitle's time.
GAP, MAX_DURATION, SAFETY, PAD = 3.0, 28.0, 3.5, 0.3
#: Cues of a video, or of a stretch of it, that are one row at most.
MAX_CUES = 50_000
_TIME = r"^(\d+):(\d+):(\d+),(\d+)"


def seconds(literal: Column, strict: bool = True) -> Column:
    """H:M:S,ms as seconds; the digits after the comma are thousandths however many there are. Anything else raises, or is null."""
    part = lambda k: F.regexp_extract(T.strip(literal), _TIME, k)
    ok = T.strip(literal).rlike(_TIME)
    if not strict:
        return F.when(ok, part(1).cast("long") * 3600 + part(2).cast("long") * 60 + part(3).cast("long") + part(4).cast("long") / F.lit(1000))
    value = part(1).cast("long") * 3600 + part(2).cast("long") * 60 + part(3).cast("long") + part(4).cast("long") / F.lit(1000)
    return F.when(ok, value).otherwise(F.raise_error(F.concat(F.lit("not a subtitle time: "), literal)).cast("double"))


def parse_subtitles(files: DataFrame, key_col: str = "video", value_col: str = "value", strict: bool = True) -> DataFrame:
    """key, idx, start, end, text of every cue of whole subtitle texts, in file order.

    A time that can't be read raises; where strict is false the whole file is left out instead."""
    body = T.strip(F.regexp_replace(F.regexp_replace(value_col, "^﻿", ""), "\r\n?", "\n"))
    blocks = files.select(key_col, F.posexplode(F.split(body, "\n\n")).alias("block", "value"))
    lines = F.filter(F.split("value", "[\n\x0b\x0c\x1c-\x1e\x85  ]"), lambda x: T.strip(x) != "")
    rows = blocks.select(key_col, "block", lines.alias("lines")).where(F.size("lines") >= 2)
    second = F.contains(F.col("lines")[1], F.lit("-->"))
    times = F.split(F.when(second, F.col("lines")[1]).otherwise(F.col("lines")[0]), "-->")
    said = F.array_join(F.when(second, F.slice("lines", 3, 2147483647 - 3)).otherwise(F.slice("lines", 2, 2147483647 - 3)), " ")
    rows = rows.select(key_col, "block", seconds(times[0], strict).alias("start"), seconds(times[1], strict).alias("end"), said.alias("text"))
    order = Window.partitionBy(key_col).orderBy("block")
    if not strict:
        bad = F.max(F.col("start").isNull() | F.col("end").isNull()).over(Window.partitionBy(key_col))
        rows = rows.withColumn("_bad", bad).where(~F.col("_bad")).drop("_bad")
    return rows.select(key_col, (F.row_number().over(order) - 1).alias("idx"), "start", "end", "text")


def subtitle_text(cues: DataFrame, key_col: str = "video") -> DataFrame:
    """key, value: cues written as a subtitle file."""
    def stamp(t: Column) -> Column:
        ms = F.round(t * 1000).cast("long")
        return F.format_string("%02d:%02d:%02d,%03d", F.floor(ms / 3600000), F.floor(ms / 60000) % 60, F.floor(ms / 1000) % 60, ms % 1000)

    block = F.concat_ws("\n", (F.col("idx") + 1).cast("string"), F.concat(stamp(F.col("start")), F.lit(" --> "), stamp(F.col("end"))), F.col("text"))
    listed = F.array_sort(F.collect_list(F.struct("idx", block.alias("block"))))
    return cues.groupBy(key_col).agg(F.array_join(F.transform(listed, lambda x: x["block"]), "\n\n").alias("value"))


def cue_lists(cues: DataFrame, by: list[str]) -> DataFrame:
    """by, cues: an array in file order. What is listed is bounded by MAX_CUES."""
    cue = F.struct(F.col("idx").cast("int").alias("idx"), F.col("start").cast("double").alias("start"), F.col("end").cast("double").alias("end"), F.col("text").cast("string").alias("text"))
    return cues.groupBy(*by).agg(F.array_sort(F.collect_list(cue)).alias("cues"))


def _folded(cues: DataFrame, by: list[str], most: float, gap: float) -> DataFrame:
    """by, chunk_idx, start, end, n_cues, text: the windows of each list of cues."""
    # the fold carries places in the list, not cues: where the open window starts, its last sentence and clause ends, and the starts of all windows
    none = F.lit(-1)
    marked = F.transform("cues", lambda c: F.struct(c["start"].alias("start"), c["end"].alias("end"), T.ends_sentence(c["text"]).alias("sentence"), T.ends_clause(c["text"]).alias("clause")))

    def step(state: Column, c: Column) -> Column:
        i, first, starts = state["i"], state["first"], state["starts"]
        torn = (i > 0) & (c["start"] - state["last"] > gap)
        full = (i > 0) & ~torn & (c["end"] - F.get(F.col("cues"), first)["start"] > most)
        cut = F.when(state["sentence"] >= 0, state["sentence"]).when(state["clause"] >= 0, state["clause"]).otherwise(i - 1) + 1
        opens = F.when(torn, i).when(full, cut).otherwise(first)
        end_at = lambda kind: F.when(c[kind], i).when(state[kind] >= opens, state[kind]).otherwise(none)
        return F.struct(
            (i + 1).alias("i"), opens.alias("first"), c["end"].alias("last"), end_at("sentence").alias("sentence"), end_at("clause").alias("clause"),
            F.when(opens != first, F.concat(starts, F.array(opens))).otherwise(starts).alias("starts"),
        )

    zero = F.lit(0)
    begin = F.struct(zero.alias("i"), zero.alias("first"), F.lit(0.0).alias("last"), none.alias("sentence"), none.alias("clause"), F.array(zero).alias("starts"))
    listed = cue_lists(cues, by).withColumn("marked", marked).withColumn("starts", F.aggregate("marked", begin, step, lambda s: s["starts"]))
    until = lambda i: F.coalesce(F.get(F.col("starts"), i + 1), F.size("cues"))
    windows = listed.select(*by, F.posexplode(F.transform("starts", lambda a, i: F.slice("cues", a + 1, until(i) - a))).alias("chunk_idx", "w"))
    return windows.select(
        *by, "chunk_idx", F.get("w", F.lit(0))["start"].alias("start"), F.element_at("w", -1)["end"].alias("end"), F.size("w").alias("n_cues"),
        F.array_join(F.transform("w", lambda c: c["text"]), " ").alias("text"),
    )


def _streamed(cues: DataFrame, by: list[str], most: float) -> DataFrame:
    """As _folded, for segments (no gap within) too long to be listed: a task streams one in order and holds its open window only."""
    slim = cues.select(*by, F.col("idx").cast("int").alias("idx"), F.col("start").cast("double").alias("start"), F.col("end").cast("double").alias("end"), F.col("text").cast("string").alias("text"))
    slim = slim.withColumns({"sentence": T.ends_sentence(F.col("text")), "clause": T.ends_clause(F.col("text"))})
    kinds = ", ".join(f"`{c}` {slim.schema[c].dataType.simpleString()}" for c in by)

    def fold(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own, held, n, done = None, [], 0, []

        def close(k: int) -> None:
            nonlocal held, n
            w, held = held[:k], held[k:]
            done.append((*own, n, w[0].start, w[-1].end, len(w), " ".join(c.text for c in w if c.text is not None)))
            n += 1

        for part in parts:
            for c in part.itertuples(index=False):
                if own != (now := tuple(getattr(c, k) for k in by)):
                    if held:
                        close(len(held))
                    own, n = now, 0
                if held and c.end - held[0].start > most:
                    ends = [k for k, h in enumerate(held) if h.sentence] or [k for k, h in enumerate(held) if h.clause] or [len(held) - 1]
                    close(ends[-1] + 1)
                held.append(c)
            if done:
                yield pd.DataFrame(done, columns=[*by, "chunk_idx", "start", "end", "n_cues", "text"])
                done = []
        if held:
            close(len(held))
            yield pd.DataFrame(done, columns=[*by, "chunk_idx", "start", "end", "n_cues", "text"])

    dealt = slim.repartition(*by).sortWithinPartitions(*by, "idx")
    return dealt.mapInPandas(fold, f"{kinds}, chunk_idx int, start double, end double, n_cues int, text string")


def _hot(df: DataFrame, key_col: str, most: int) -> DataFrame | None:
    """The keys of more than `most` rows, a row each, or None."""
    keys = written(df.groupBy(key_col).agg(F.count("*").alias("n")).where(F.col("n") > most).select(F.col(key_col).alias("_hot")), "hot")
    return None if keys.isEmpty() else keys


def _of(df: DataFrame, keys: DataFrame, key_col: str, how: str) -> DataFrame:
    return df.join(F.broadcast(keys), F.col(key_col) == F.col("_hot"), how)  # rows / MAX_CUES keys at most


def group_cues(cues: DataFrame, key_col: str = "video", most: float = MAX_DURATION, gap: float = GAP, most_cues: int = MAX_CUES) -> DataFrame:
    """key, chunk_idx, start, end, n_cues, text: greedy windows.

    A gap above `gap` ends a window. One that would grow beyond `most` is cut after its last sentence end,
    else its last clause end, else whole; what is left opens the next and is not checked again.

    A video of up to `most_cues` cues is one list. A longer one is cut at its gaps, where the fold begins anew anyway, into
    segments, found over ranges of its cues; segments are lists too, or, if still longer, streamed through a task in order."""
    keys = _hot(cues, key_col, most_cues)
    if keys is None:
        return _folded(cues, [key_col], most, gap)
    short = _folded(_of(cues, keys, key_col, "left_anti"), [key_col], most, gap)
    long = _of(cues, keys, key_col, "left_semi").select(key_col, "idx", "start", "end", "text")
    before = scanned(long, [key_col], [F.col("idx")], {"_before": ("last", F.col("end"), False)})
    torn = F.coalesce((F.col("start") - F.col("_before") > gap).cast("int"), F.lit(1))
    pieces = scanned(before, [key_col], [F.col("idx")], {"segment": ("sum", torn, True)}).drop("_before")
    pieces = written(pieces, "segments")
    by = [key_col, "segment"]
    sizes = written(pieces.groupBy(*by).agg(F.count("*").alias("_n")), "sizes")
    whole = pieces.join(sizes.where(F.col("_n") <= most_cues).select(*by), by, "left_semi")
    rest = sizes.where(F.col("_n") > most_cues).select(*by)
    found = _folded(whole, by, most, gap)
    if not rest.isEmpty():
        found = found.unionByName(_streamed(pieces.join(F.broadcast(rest), by, "left_semi"), by, most))
    found = written(found, "windows")
    counts = found.groupBy(*by).agg(F.count("*").alias("_w"))
    offsets = scanned(counts, [key_col], [F.col("segment")], {"_offset": ("sum", F.col("_w"), False)}).select(*by, F.coalesce("_offset", F.lit(0)).alias("_offset"))
    placed = found.join(offsets, by).withColumn("chunk_idx", (F.col("chunk_idx") + F.col("_offset")).cast("int"))
    return short.unionByName(placed.select(*short.columns))


def gap_sessions(df: DataFrame, key_cols: list[str], order_cols: list[str], start: Column, end: Column, threshold) -> DataFrame:
    """df with session: from 0, it grows where a row starts more than threshold after the end of the one before."""
    free(df, "session", "_torn")
    order = Window.partitionBy(*key_cols).orderBy(*order_cols)
    torn = F.coalesce((start - F.lag(end).over(order)) > threshold, F.lit(False)).cast("int")
    return df.withColumn("_torn", torn).withColumn("session", F.sum("_torn").over(order.rowsBetween(Window.unboundedPreceding, 0))).drop("_torn")


def boundaries(windows: DataFrame, key_col: str = "video", gap: float = GAP, pad: float = PAD, total: Column | None = None, snapped: Column | None = None, search: float = 1.0) -> DataFrame:
    """windows with chunk_start, chunk_end, gap (to the next) and shift.

    The first window opens `pad` early and the last closes `pad` late, within the signal. Over a gap above
    `gap` each side keeps its own boundary; else neighbours share one. `snapped(nominal, until)` moves it."""
    free(windows, "gap", "shift", "chunk_start", "chunk_end", "_next")
    order = Window.partitionBy(key_col).orderBy("chunk_idx")
    following, snap = F.lead("start").over(order), snapped or (lambda nominal, until: nominal)
    rows = windows.withColumn("gap", following - F.col("end")).withColumn("_next", following)
    far = F.col("gap") > gap
    until = F.when(far, F.col("end") + F.least(F.lit(search), F.col("gap"))).otherwise(F.col("_next"))
    close = F.col("end") + pad
    rows = rows.withColumn("chunk_end", F.when(F.col("_next").isNull(), F.least(total, close) if total is not None else close).otherwise(snap(F.col("end"), until)))
    before, torn = F.lag("chunk_end").over(order), F.lag(far).over(order)
    opened = F.when(before.isNull(), F.greatest(F.lit(0.0), F.col("start") - pad)).when(torn, F.greatest(before, F.col("start") - pad)).otherwise(before)
    return rows.withColumn("chunk_start", opened).withColumn("shift", F.col("chunk_end") - F.col("end")).drop("_next")


def shifts(bounds: DataFrame, least: float = 0.05) -> DataFrame:
    """Boundaries that snapping moved by more than `least` seconds."""
    return bounds.where(F.abs("shift") > least)


def reassign(cues: DataFrame, chunks: DataFrame, key_col: str = "video", most_cues: int = MAX_CUES) -> DataFrame:
    """key, chunk_idx, n_cues, text by the chunks' final ends: a cue goes to the first chunk that ends after it
    starts, else to the last, and never before the chunk of a cue ahead of it.

    Videos of more than `most_cues` cues are scanned by ranges of time and of cues, which carry what came before."""
    keys = _hot(cues, key_col, most_cues)
    if keys is None:
        placed = _placed(cues, chunks, key_col, False)
    else:
        sides = [[_of(x, keys, key_col, how) for x in (cues, chunks)] for how in ("left_anti", "left_semi")]
        placed = _placed(*sides[0], key_col, False).unionByName(_placed(*sides[1], key_col, True))
    said = F.array_sort(F.collect_list(F.struct("idx", "text")))
    return placed.groupBy(key_col, "chunk_idx").agg(F.count("*").alias("n_cues"), F.array_join(F.transform(said, lambda x: x["text"]), " ").alias("text"))


def _placed(cues: DataFrame, chunks: DataFrame, key_col: str, by_ranges: bool) -> DataFrame:
    """key, idx, text, chunk_idx of cues of videos that have chunks."""
    cue = cues.select(key_col, F.col("start").cast("double").alias("at"), F.lit(0).alias("kind"), F.col("idx").cast("int").alias("idx"), F.col("text").cast("string").alias("text"), F.lit(None).cast("int").alias("chunk_idx"))
    end = chunks.select(key_col, F.col("chunk_end").cast("double").alias("at"), F.lit(1).alias("kind"), F.lit(None).cast("int").alias("idx"), F.lit(None).cast("string").alias("text"), F.col("chunk_idx").cast("int").alias("chunk_idx"))
    rows = cue.unionByName(end)
    # from the latest time on, the least chunk met so far is the first that ends later; at equal times cues come first
    if by_ranges:
        ends = chunks.groupBy(F.col(key_col).alias("_key")).agg(F.max("chunk_idx").cast("int").alias("last"))
        rows = scanned(rows, [key_col], [F.desc("at"), F.col("kind"), F.col("idx"), F.col("chunk_idx")], {"first": ("min", F.col("chunk_idx"), True)}).join(F.broadcast(ends), F.col(key_col) == F.col("_key")).drop("_key")
    else:
        later = Window.partitionBy(key_col).orderBy(F.desc("at"), "kind").rowsBetween(Window.unboundedPreceding, 0)
        rows = rows.withColumns({"first": F.min("chunk_idx").over(later), "last": F.max("chunk_idx").over(Window.partitionBy(key_col))})
    placed = rows.where((F.col("kind") == 0) & F.col("last").isNotNull()).withColumn("first", F.coalesce("first", "last")).select(key_col, "idx", "text", "first")
    if by_ranges:
        return scanned(placed, [key_col], [F.col("idx")], {"chunk_idx": ("max", F.col("first"), True)}).select(key_col, "idx", "text", "chunk_idx")
    ahead = Window.partitionBy(key_col).orderBy("idx").rowsBetween(Window.unboundedPreceding, 0)
    return placed.select(key_col, "idx", "text", F.max("first").over(ahead).alias("chunk_idx"))


def tumbling(df: DataFrame, duration_col: str = "duration", most: float = MAX_DURATION, least: float = 1.0) -> DataFrame:
    """df with slice, slice_start, slice_length: int(duration / most) + 1 slices where it is longer, those of `least` and more."""
    free(df, "slice", "slice_start", "slice_length")
    d = F.col(duration_col)
    n = F.when(d > most, F.floor(d / most)).otherwise(0).cast("int")
    rows = df.withColumn("slice", F.explode(F.sequence(F.lit(0), n))).withColumn("slice_start", F.col("slice") * F.lit(most))
    return rows.withColumn("slice_length", F.least(F.lit(most), d - F.col("slice_start"))).where(F.col("slice_length") >= least)


def sliding(df: DataFrame, duration_col: str = "duration", window: float = MAX_DURATION, strides: tuple[float, float] = (4.0, 2.0)) -> DataFrame:
    """df with window, window_start, window_end: overlapping windows up to the first that reaches the end."""
    free(df, "window", "window_start", "window_end")
    d, step = F.col(duration_col), window - sum(strides)
    n = F.when(d <= window, 0).otherwise(F.ceil((d - window) / step)).cast("int")
    rows = df.withColumn("window", F.explode(F.sequence(F.lit(0), n))).withColumn("window_start", F.col("window") * F.lit(step))
    rows = rows.withColumn("window_end", F.least(F.col("window_start") + window, d))
    return rows.where((F.col("window") == 0) | (F.col("window_end") - F.col("window_start") > strides[0]))


def audio_boundaries(
    windows: DataFrame, signals: DataFrame, key_col: str = "video", gap: float = GAP, pad: float = PAD, search: float = 1.0, frame: int = S.FRAME, hop: int = S.HOP
) -> DataFrame:
    """key, samples, rate, chunks (chunk_idx, chunk_start, chunk_end): boundaries snapped to silence, one row for each signal."""
    listed = windows.groupBy(key_col).agg(F.array_sort(F.collect_list(F.struct("chunk_idx", "start", "end"))).alias("ws"))
    rows = listed.join(signals.select(key_col, "samples", F.col("rate").cast("double").alias("rate")), key_col)
    ws, ends = F.col("ws"), F.col("ends")

    def end(w: Column, i: Column) -> Column:
        following = F.get(ws, i + 1)["start"]
        until = F.when(following - w["end"] > gap, w["end"] + F.least(F.lit(search), following - w["end"])).otherwise(following)
        closed = F.least(F.size("samples") / F.col("rate"), w["end"] + pad)
        return F.when(i == F.size(ws) - 1, closed).otherwise(S.snap(F.col("samples"), F.col("rate"), w["end"], until, frame, hop))

    def start(w: Column, i: Column) -> Column:
        shared, own = F.get(ends, i - 1), w["start"] - pad
        torn = w["start"] - F.get(ws, i - 1)["end"] > gap
        return F.when(i == 0, F.greatest(F.lit(0.0), own)).when(torn, F.greatest(shared, own)).otherwise(shared)

    rows = rows.withColumn("ends", F.transform("ws", end)).withColumn("starts", F.transform("ws", start))
    chunk = lambda w, i: F.struct(w["chunk_idx"].alias("chunk_idx"), F.get("starts", i).alias("chunk_start"), F.get("ends", i).alias("chunk_end"))
    return rows.select(key_col, "samples", "rate", F.transform("ws", chunk).alias("chunks"))


def chunks_of_audio(cues: DataFrame, signals: DataFrame, key_col: str = "video", most: float = MAX_DURATION) -> DataFrame:
    """key, chunk_idx, chunk_start, chunk_end, duration, transcript, samples, rate: cues and signals (key, rate, samples) to clips.

    Windows are grouped with room for the pads, boundaries are snapped to silence, texts come from the final
    boundaries, and what isn't a valid transcript goes, with its number. A signal stays in one row until it is cut."""
    cut = audio_boundaries(group_cues(cues, key_col, max(1.0, most - SAFETY)), signals, key_col)
    flat = cut.select(key_col, F.explode("chunks").alias("c")).select(key_col, "c.chunk_idx", "c.chunk_end")
    said = reassign(cues, flat, key_col).where(T.valid_transcript(F.col("text")))
    said = said.groupBy(key_col).agg(F.map_from_entries(F.collect_list(F.struct("chunk_idx", "text"))).alias("texts"))
    rows = cut.join(said, key_col).select(key_col, "samples", "rate", "texts", F.explode("chunks").alias("c"))
    rows = rows.withColumn("transcript", F.try_element_at("texts", F.col("c.chunk_idx"))).where(F.col("transcript").isNotNull())
    end = F.least(F.col("c.chunk_end"), F.col("c.chunk_start") + most)
    return rows.select(
        key_col, "c.chunk_idx", "c.chunk_start", end.alias("chunk_end"), (end - F.col("c.chunk_start")).alias("duration"), "transcript",
        S.clip(F.col("samples"), F.col("rate"), F.col("c.chunk_start"), end).alias("samples"), "rate",
    )
