"""Best-fit packing with a swap-based local search.

A document's identifiers, with the end identifier, are one piece, or pieces of CAPACITY where they are
more. Pieces of CAPACITY are sequences of their own. The others are dealt by hash to shards of about SHARD
pieces. A shard is packed best fit, longest first; while it has more bins than its tokens need, pieces are
exchanged one for one, two for one, or moved between underfull bins, each step increasing the sum of
squared fills, so that the emptiest bins empty. The emptiest bin of each shard is then packed anew with
those of RELAY other shards. Only lengths are shuffled, and no task holds more than a shard.

Defined results: null and empty texts are one piece that holds the end identifier; repeated rows are packed
each; equal lengths and ties go by piece order; an empty table gives an empty one.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cuefold.llm.batches import map_batches
from cuefold.llm.storage import written
from cuefold.llm.word_ids import CACHED, END_ID, VOCABULARY

CAPACITY = 4096
SHARD = 8192
RELAY = 512


class Bins:
    """Bins of pieces by index, with their fills."""

    def __init__(self, lengths: np.ndarray, capacity: int):
        self.lengths, self.capacity = lengths, capacity
        self.bin_of = np.full(len(lengths), -1, np.int64)
        self.fill: list[int] = []
        self.by_length = np.argsort(lengths, kind="stable")
        self._best_fit()
        self.fill = np.array(self.fill, np.int64)

    def _best_fit(self) -> None:
        """Longest first, each to the fullest bin that takes it. A bit of `open_` stands for each room that some bin has."""
        rooms: list[list[int]] = [[] for _ in range(self.capacity + 1)]
        open_ = 0
        for i in np.argsort(-self.lengths, kind="stable").tolist():
            size = int(self.lengths[i])
            fits = open_ >> size
            if fits:
                room = size + (fits & -fits).bit_length() - 1
                b = rooms[room].pop()
                if not rooms[room]:
                    open_ ^= 1 << room
                self.fill[b] += size
            else:
                b, room = len(self.fill), self.capacity
                self.fill.append(size)
            self.bin_of[i] = b
            left = room - size
            if not rooms[left]:
                open_ |= 1 << left
            rooms[left].append(b)

    def needed(self) -> int:
        return -(-int(self.lengths.sum()) // self.capacity)

    def used(self) -> int:
        return int((self.fill > 0).sum())

    def _put(self, i: int, b: int) -> None:
        self.fill[self.bin_of[i]] -= self.lengths[i]
        self.fill[b] += self.lengths[i]
        self.bin_of[i] = b

    def _step(self, source: int) -> bool:
        """One move or exchange that takes from `source` and fills a bin at least as full. False if there is none."""
        own = np.flatnonzero(self.bin_of == source)
        room = self.capacity - self.fill
        into = (self.fill > 0) & (room > 0) & (self.fill >= self.fill[source])
        into[source] = False
        bins = np.flatnonzero(into)
        if not len(bins):
            return False
        movable = own[self.lengths[own] <= room[bins].max()]
        if len(movable):
            i = int(movable[np.argmax(self.lengths[movable])])
            fits = bins[room[bins] >= self.lengths[i]]
            self._put(i, int(fits[np.argmin(room[fits])]))
            return True
        found = self._exchange(own, self.by_length[into[self.bin_of[self.by_length]]], room)
        if not found:
            return False
        pieces, back = found
        target = int(self.bin_of[back])
        self._put(back, source)
        for i in pieces:
            self._put(i, target)
        return True

    def _exchange(self, own: np.ndarray, others: np.ndarray, room: np.ndarray) -> tuple[tuple[int, ...], int] | None:
        """One or two pieces of `own` and the piece of `others` (shortest first) that they replace, with the greatest gain."""
        at, sizes, twins = {}, self.lengths[own], set()
        for i, n in zip(own.tolist(), sizes.tolist(), strict=True):
            twins.add(n) if n in at else at.setdefault(n, i)
        kinds = np.array(sorted(at), np.int64)  # equal lengths are one kind: a bin has few, since their sum is at most the capacity
        x, y = np.triu_indices(len(kinds))
        x, y = (k[(x != y) | np.isin(kinds[x], list(twins))] for k in (x, y))
        offers = np.concatenate([kinds, kinds[x] + kinds[y]])
        # the shortest piece whose bin takes the offer in its place: the first at which the greatest length and room so far is enough
        reach = np.maximum.accumulate(self.lengths[others] + room[self.bin_of[others]])
        first = np.searchsorted(reach, offers)
        gain = np.where(first < len(others), offers - self.lengths[others[np.minimum(first, len(others) - 1)]], 0)
        best = int(np.argmax(gain))
        if gain[best] <= 0:
            return None
        back = int(others[first[best]])
        if best < len(kinds):
            return (at[int(kinds[best])],), back
        a, b = int(kinds[x[best - len(kinds)]]), int(kinds[y[best - len(kinds)]])
        twin = int(own[np.flatnonzero(sizes == b)[-1]])
        return (at[a], twin), back

    def search(self) -> None:
        """Empties bins until there are as few as the tokens need or no bin has a step left. Each step raises an integer that is bounded."""
        least, stuck, stepped = self.needed(), np.zeros(len(self.fill), bool), False
        while (before := self.used()) > least:
            left = np.flatnonzero((self.fill > 0) & (self.fill < self.capacity) & ~stuck)
            if not len(left):
                if not stepped:
                    return
                stuck[:], stepped = False, False  # steps since may have freed a bin
                continue
            source = int(left[np.argmin(self.fill[left])])
            while self.fill[source] > 0 and self._step(source):
                stepped = True
            stuck[source] = True
            if self.used() < before:
                stuck[:] = False


def pack_lengths(lengths: np.ndarray, capacity: int = CAPACITY) -> np.ndarray:
    """The bin of each length; bins are numbered from 0, none is empty."""
    if not len(lengths):
        return np.zeros(0, np.int64)
    bins = Bins(lengths.astype(np.int64), capacity)
    bins.search()
    return np.unique(bins.bin_of, return_inverse=True)[1].astype(np.int64)


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY, capacity: int = CAPACITY, cached: int = CACHED) -> DataFrame:
    """doc_id, piece, start, length and ids_crc32 of every piece. `cached` words stay in each worker's memory."""
    slim = docs.select(docs[id_col].alias("doc_id"), docs[text_col].cast("string").cast("binary").alias("text"))
    kind = slim.schema["doc_id"].dataType.simpleString()
    end = int(END_ID).to_bytes(4, "little")
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64())

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from cuefold.llm.word_ids import encoder

        words = encoder(vocabulary, cached)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                rows, row_of = [], []
                for k, text in enumerate(part.column(1).to_pylist()):
                    ids = memoryview(words.encode(text) + end)
                    for piece, start in enumerate(range(0, len(ids), 4 * capacity)):
                        of = ids[start : start + 4 * capacity]
                        rows.append((piece, start // 4, len(of) // 4, zlib.crc32(of)))
                        row_of.append(k)
                columns = [pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)]
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(row_of, pa.int64())), *columns], names)

    return map_batches(slim, cut, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


def _packer(capacity: int, keep_open: bool):
    def packed(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("rid", kind="stable", ignore_index=True)
        lengths = rows["length"].to_numpy()
        bins = pack_lengths(lengths, capacity)
        fills = np.bincount(bins, lengths).astype(np.int64)
        order = np.argsort(bins, kind="stable")
        before = np.cumsum(lengths[order]) - lengths[order]
        first = np.cumsum(fills) - fills
        offset = np.empty(len(rows), np.int64)
        offset[order] = before - first[bins[order]]
        least = int(np.argmin(fills))
        is_open = (bins == least) & (fills[least] < capacity) if keep_open else np.zeros(len(rows), bool)
        group = int(key[0])
        return pd.DataFrame({"rid": rows["rid"], "length": lengths, "shard": group, "sequence_id": (group << 32) + bins, "offset": offset, "open": is_open})

    return packed


def pack(found: DataFrame, capacity: int = CAPACITY, shard: int = SHARD, relay: int = RELAY) -> DataFrame:
    """`found` (any columns with length) with sequence_id and offset: places in as few sequences as the search can."""
    rows = written(found.withColumn("rid", F.monotonically_increasing_id()), "pieces")
    own = rows.where(F.col("length") >= capacity).withColumns({"sequence_id": -1 - F.col("rid"), "offset": F.lit(0).cast("long")}).drop("rid")
    short = rows.where(F.col("length") < capacity)
    n = max(1, -(-short.count() // shard))
    schema = "rid long, length long, shard long, sequence_id long, offset long, open boolean"
    first = written(
        short.select("rid", "length", F.pmod(F.xxhash64("rid"), F.lit(n)).alias("shard")).groupBy("shard").applyInPandas(_packer(capacity, True), schema),
        "packed",
    )
    again = first.where("open").select("rid", "length", F.expr(f"shard div {relay}").alias("shard")).groupBy("shard")
    again = again.applyInPandas(_packer(capacity, False), schema).withColumn("sequence_id", F.col("sequence_id") + F.lit(1 << 60))
    places = first.where("not open").unionByName(again).select("rid", "sequence_id", "offset")
    return short.join(places.hint("merge"), "rid").drop("rid").unionByName(own)  # a row a piece, of which the files tell too little


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY, capacity: int = CAPACITY, cached: int = CACHED) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    return pack(pieces(docs, id_col, text_col, vocabulary, capacity, cached), capacity).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )
