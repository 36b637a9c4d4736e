"""Token identifiers in a compressed binary format: static range asymmetric numeral systems (rANS).

Texts are tokenised where they lie; what moves, once, is compressed identifiers of two bytes each where they fit.
Documents are dealt to ranges of doc_id, cut by a sample of ids, and sorted, so groups ascend; rows of an id that
fills ranges are dealt by a hash of their place, so no task gathers one id. A group (GROUP_IDS identifiers or a
little more, of one range) has one table of frequencies, counted over the whole group, scaled to 2**SCALE_BITS and
stored once. Its blocks hold whole documents, about BLOCK_IDS identifiers, and decode on their own: symbol k goes
to lane k mod LANES, all lanes step together, and a lane's state spills 32 bits when it would overflow. Every CHECKPOINT steps a block
records its place in the spilled words and the lanes' states, from where decoding can begin; a checksum covers
the identifiers of each stretch between checkpoints.

The files are a Parquet table with a row for each group, which Spark's committed writers place in any store:
part and seq (the range and the group's number in it), start (identifiers before it in the range), n_ids,
tables (the frequencies), doc_ids, sizes (identifiers of each document, compressed), block_docs (documents of
each block) and bodies (the blocks).

Defined results: null and empty texts are the end identifier alone; repeated rows are stored each, in the
order of their place's hash where doc_id is equal (null first); ids may be of any type that Spark can sort; an
empty table gives an empty one; a damaged block raises ValueError.
"""

from __future__ import annotations

import struct
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, BooleanType, IntegerType, LongType, StructField, StructType

from cuefold.llm.batches import map_batches
from cuefold.llm.storage import written
from cuefold.llm.word_ids import END_ID, VOCABULARY

SCALE_BITS = 18
LANES = 1024
BLOCK_IDS = 1 << 19
GROUP_IDS = 1 << 23
CHECKPOINT = 128
#: Ids drawn to cut ranges, which balance the work and decide nothing else; rows of a range at least, where there are several.
SAMPLE = 50_000
ROWS_A_PART = 2_000
#: Identifiers of a range, about, where that needs more ranges than a shuffle has by its setting; by the average of so many first texts.
RANGE_IDS = 1 << 26
MEASURED, BYTES_AN_ID = 1_000, 3

_LOW = np.uint64(1 << 31)
_U32, _SCALE, _RENORM = np.uint64(32), np.uint64(SCALE_BITS), np.uint64(63 - SCALE_BITS)
_SLOT = np.uint64((1 << SCALE_BITS) - 1)
_MASK32 = np.uint64(0xFFFFFFFF)


class Frequencies:
    """A shared table: symbols that occur, and how often of 2**SCALE_BITS."""

    def __init__(self, symbols: np.ndarray, freq: np.ndarray):
        self.symbols, self.freq = symbols.astype(np.uint32), freq.astype(np.uint64)
        self.start = np.cumsum(self.freq) - self.freq
        self.place = np.zeros(int(self.symbols[-1]) + 1 if len(symbols) else 1, np.int32)
        self.place[self.symbols] = np.arange(len(self.symbols))

    @classmethod
    def of(cls, ids: np.ndarray) -> Frequencies:
        """Counted and scaled; a symbol that occurs has 1 at least."""
        every = np.bincount(ids)
        symbols = np.flatnonzero(every)
        counts = every[symbols]
        total = 1 << SCALE_BITS
        if len(symbols) > total:
            raise ValueError("more distinct symbols than the table has slots")
        freq = np.maximum(1, counts * (total - len(symbols)) // counts.sum())
        spare = total - int(freq.sum())
        order = np.argsort(-counts, kind="stable")
        freq[order[0]] += max(spare, 0)
        for k in order:  # only where ones for rare symbols overdraw the total
            if spare >= 0:
                break
            give = min(int(freq[k]) - 1, -spare)
            freq[k] -= give
            spare += give
        return cls(symbols, freq)

    def to_bytes(self) -> bytes:
        return zlib.compress(struct.pack("<I", len(self.symbols)) + np.diff(self.symbols, prepend=np.uint32(0)).astype("<u4").tobytes() + self.freq.astype("<u4").tobytes(), 1)

    @classmethod
    def from_bytes(cls, data: bytes) -> Frequencies:
        raw = zlib.decompress(data)
        n = struct.unpack_from("<I", raw)[0]
        steps = np.frombuffer(raw, "<u4", n, 4)
        return cls(np.cumsum(steps, dtype=np.uint64).astype(np.uint32), np.frombuffer(raw, "<u4", n, 4 + 4 * n))

    def slots(self) -> np.ndarray:
        """The index of the symbol of each slot."""
        return np.repeat(np.arange(len(self.symbols), dtype=np.uint32), self.freq.astype(np.int64))


def encode_block(ids: np.ndarray, table: Frequencies) -> bytes:
    """A block's body: counts, checkpoints, their states and checksums, spilled words."""
    n = len(ids)
    lanes = max(1, min(LANES, n // 16))
    steps = -(-n // lanes)
    index = table.place[ids]
    state = np.full(lanes, _LOW, np.uint64)
    spilled: list[np.ndarray] = []
    states: list[np.ndarray] = []
    words_after: list[int] = []
    words = 0
    freq_of, start_of = table.freq[index], table.start[index]
    for step in range(steps - 1, -1, -1):
        a, b = step * lanes, min(n, (step + 1) * lanes)
        f, x = freq_of[a:b], state[: b - a]
        over = x >= (f << _RENORM)
        if over.any():
            out = x[over]
            spilled.append((out & _MASK32).astype("<u4"))
            words += len(out)
            x = np.where(over, x >> _U32, x)
        q = x // f
        state[: b - a] = (q << _SCALE) + (x - q * f) + start_of[a:b]
        if step % CHECKPOINT == 0:
            states.append(state.copy())
            words_after.append(words)
    points = len(states)
    states.reverse()
    places = [words - w for w in reversed(words_after)]  # words that a decoder has read when it comes to the checkpoint
    sums = [zlib.crc32(ids[k * CHECKPOINT * lanes : (k + 1) * CHECKPOINT * lanes].astype("<u4")) for k in range(points)]
    spilled.reverse()
    return b"".join(
        [struct.pack("<IIII", n, lanes, points, words), struct.pack(f"<{points}I", *places), struct.pack(f"<{points}I", *sums)]
        + [s.astype("<u8").tobytes() for s in states]
        + [s.tobytes() for s in spilled]
    )


def decode_block(body: bytes, table: Frequencies, slots: np.ndarray, first: int = 0, last: int | None = None) -> np.ndarray:
    """Identifiers of the stretches first..last (all by default). Each begins at a checkpoint and is checked."""
    n, lanes, points, words = struct.unpack_from("<IIII", body)
    places = np.frombuffer(body, "<u4", points, 16)
    sums = np.frombuffer(body, "<u4", points, 16 + 4 * points)
    at = 16 + 8 * points
    states = np.frombuffer(body, "<u8", points * lanes, at).reshape(points, lanes)
    stream = np.frombuffer(body, "<u4", words, at + 8 * points * lanes).astype(np.uint64)
    last = points if last is None else last
    steps = -(-n // lanes)
    stop = min(steps, last * CHECKPOINT)
    out = np.empty(min(n, stop * lanes) - first * CHECKPOINT * lanes, np.uint32)
    if first >= points:
        return out[:0]
    state, place = states[first].astype(np.uint64), int(places[first])
    base = first * CHECKPOINT * lanes
    for step in range(first * CHECKPOINT, stop):
        a, b = step * lanes, min(n, (step + 1) * lanes)
        x = state[: b - a]
        slot = x & _SLOT
        k = slots[slot]
        out[a - base : b - base] = k
        x = table.freq[k] * (x >> _SCALE) + slot - table.start[k]
        low = np.flatnonzero(x < _LOW)
        if len(low):
            x[low] = (x[low] << _U32) | stream[place : place + len(low)]
            place += len(low)
        state[: b - a] = x
    ids = table.symbols[out]
    for k in range(first, last):
        part = ids[(k - first) * CHECKPOINT * lanes : (k - first + 1) * CHECKPOINT * lanes]
        if zlib.crc32(part.astype("<u4")) != int(sums[k]):
            raise ValueError("a block's identifiers don't match their checksum")
    return ids


def encode_group(ids: list[np.ndarray]) -> tuple[bytes, list[int], list[bytes]]:
    """The shared table of a group of documents, how many of them each block holds, and the blocks."""
    whole = np.concatenate(ids)
    table = Frequencies.of(whole)
    n_docs, bodies = [], []
    at = doc = 0
    while doc < len(ids):
        first, size = doc, 0
        while doc < len(ids) and size < BLOCK_IDS:
            size += len(ids[doc])
            doc += 1
        n_docs.append(doc - first)
        bodies.append(encode_block(whole[at : at + size], table))
        at += size
    return table.to_bytes(), n_docs, bodies


class Ranges:
    """Ranges of ids, cut so that each has about as many rows: part k holds the ids from cut k - 1 to cut k."""

    def __init__(self, docs: DataFrame, id_col: str, text_col: str = "text", sample: int = SAMPLE):
        spark = docs.sparkSession
        rows = docs.select(docs[id_col].alias("doc_id"), F.monotonically_increasing_id().alias("at"))
        n_rows = rows.count()
        few = docs.select(F.octet_length(docs[text_col].cast("string")).alias("n")).limit(MEASURED)
        n_ids = n_rows * ((few.agg(F.avg("n")).first()[0] or 0) / BYTES_AN_ID + 1)  # about
        wanted = max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(n_ids / RANGE_IDS))
        self.n = max(1, min(wanted, -(-n_rows // ROWS_A_PART)))
        drawn = rows.orderBy(F.xxhash64("at"), "at").limit(sample).select("doc_id").orderBy("doc_id")
        drawn = drawn.toArrow().column(0).to_pylist()  # `sample` ids, in the shape that they have in batches too
        self.cuts = [_order(drawn[k * len(drawn) // self.n]) for k in range(1, self.n)] if drawn else []
        # a number for each part that the shuffle deals to a task of its own
        numbers = spark.range(64 * self.n).groupBy(F.pmod(F.hash("id"), F.lit(self.n)).alias("to")).agg(F.min("id").alias("id")).collect()
        own = {r.to: r.id for r in numbers}  # one for each part
        self.number = [own.get(k, 64 * self.n + k) for k in range(self.n)]

    def part(self, doc_id, salt: int) -> int:
        key = _order(doc_id)
        low = bisect_left(self.cuts, key)
        same = bisect_right(self.cuts, key, low) - low
        return low + ((salt + (1 << 63)) * (same + 1) >> 64)  # rows of an id that fills parts ascend by salt over them


def _order(doc_id) -> tuple:
    """Sorts as Spark does: null first, not-a-number last, arrays and structs by their elements."""
    if isinstance(doc_id, dict):
        doc_id = list(doc_id.values())
    if isinstance(doc_id, list):
        return (1, tuple(map(_order, doc_id)))
    return (0,) if doc_id is None else (2,) if doc_id != doc_id else (1, doc_id)


def tokenised(docs: DataFrame, ranges: Ranges, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id, salt, part, deal (the part's number for the shuffle), ids (little-endian, with the end identifier, compressed) and wide (four bytes each, not two) of every row."""
    text = docs[text_col].cast("string").cast("binary").alias("text")
    slim = docs.select(docs[id_col].alias("doc_id"), F.xxhash64(F.monotonically_increasing_id()).alias("salt"), text)
    end = int(END_ID).to_bytes(4, "little")
    names = ["doc_id", "salt", "part", "deal", "ids", "wide"]

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from cuefold.llm.word_ids import encoder

        words, squeeze = encoder(vocabulary), zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                found = [np.frombuffer(words.encode(text) + end, "<u4") for text in some.column(2).to_pylist()]
                wide = [bool(x.max() >> 16) for x in found]
                raw = [squeeze((x if w else x.astype("<u2")).tobytes()) for x, w in zip(found, wide, strict=True)]
                part = [ranges.part(d, s) for d, s in zip(some.column(0).to_pylist(), some.column(1).to_pylist(), strict=True)]
                columns = [pa.array(part, pa.int32()), pa.array([ranges.number[k] for k in part], pa.int64()), pa.array(raw, pa.binary()), pa.array(wide, pa.bool_())]
                yield pa.RecordBatch.from_arrays([some.column(0), some.column(1), *columns], names)

    kinds = (LongType(), IntegerType(), LongType(), BinaryType(), BooleanType())
    return map_batches(slim, encoded, StructType([slim.schema["doc_id"], *[StructField(n, k) for n, k in zip(names[1:], kinds, strict=True)]]))


def encode_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """The table of groups, written to the shared folder."""
    ranges = Ranges(docs, id_col, text_col)
    found = tokenised(docs, ranges, id_col, text_col, vocabulary)
    id_field = found.schema["doc_id"]

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        ids, doc_ids, held, start, seq, own = [], [], 0, 0, 0, None

        def group() -> pa.RecordBatch:
            table, n_docs, bodies = encode_group(ids)
            sizes = zlib.compress(np.array([len(x) for x in ids], "<u4").tobytes(), 1)
            known = pa.concat_arrays(doc_ids)
            columns = [
                pa.array([own], pa.int32()), pa.array([seq], pa.int32()), pa.array([start], pa.int64()), pa.array([held], pa.int64()), pa.array([table], pa.binary()),
                pa.ListArray.from_arrays(pa.array([0, len(known)], pa.int32()), known), pa.array([sizes], pa.binary()),
                pa.array([n_docs], pa.list_(pa.int32())), pa.array([bodies], pa.list_(pa.binary())),
            ]
            return pa.RecordBatch.from_arrays(columns, ["part", "seq", "start", "n_ids", "tables", "doc_ids", "sizes", "block_docs", "bodies"])

        for batch in batches:
            since = 0
            for i, (part, raw, wide) in enumerate(zip(*(batch.column(k).to_pylist() for k in (1, 2, 3)), strict=True)):
                full = held >= GROUP_IDS
                if ids and (full or part != own):
                    doc_ids.append(batch.column(0).slice(since, i - since))
                    yield group()
                    start, seq = (start + held, seq + 1) if part == own else (0, 0)
                    ids, doc_ids, held, since = [], [], 0, i
                own = part
                ids.append(np.frombuffer(unpack(raw), "<u4" if wide else "<u2"))
                held += len(ids[-1])
            doc_ids.append(batch.column(0).slice(since))
        if ids:
            yield group()

    ordered = found.repartition(ranges.n, "deal").sortWithinPartitions("part", "doc_id", "salt").select("doc_id", "part", "ids", "wide")
    binary, integer, long_ = BinaryType(), IntegerType(), LongType()
    kinds = (integer, integer, long_, long_, binary, ArrayType(id_field.dataType), binary, ArrayType(integer), ArrayType(binary))
    names = ("part", "seq", "start", "n_ids", "tables", "doc_ids", "sizes", "block_docs", "bodies")
    return written(map_batches(ordered, encoded, StructType([StructField(n, k) for n, k in zip(names, kinds, strict=True)])), "tokens")


def decode_documents(groups: DataFrame) -> DataFrame:
    """From the files: doc_id, start, n_tokens and ids (little-endian, four bytes each) of each document, group by group in parallel."""
    id_kind = groups.schema["doc_ids"].dataType.elementType
    parts = groups.groupBy("part").agg(F.sum("n_ids").alias("n"))  # a row for each range, of which there are shuffle partitions
    before = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                at, packed, docs, sizes, n_docs, bodies = (batch.column(k)[i] for k in range(6))
                table = Frequencies.from_bytes(packed.as_py())
                slots, at, doc_ids = table.slots(), at.as_py(), docs.values
                lengths = np.frombuffer(zlib.decompress(sizes.as_py()), "<u4").astype(np.int64)
                doc = 0
                for n, body in zip(n_docs.as_py(), bodies, strict=True):
                    ids = decode_block(body.as_py(), table, slots)
                    own = lengths[doc : doc + n]
                    cuts = np.concatenate([[0], np.cumsum(own)])
                    raw = ids.astype("<u4").tobytes()
                    texts = [raw[4 * a : 4 * b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
                    yield pa.RecordBatch.from_arrays(
                        [doc_ids.slice(doc, n), pa.array(at + cuts[:-1]), pa.array(own), pa.array(texts, pa.binary())], ["doc_id", "start", "n_tokens", "ids"]
                    )
                    doc, at = doc + n, at + int(cuts[-1])

    placed = groups.join(F.broadcast(before), "part").select((F.col("start") + F.col("before")).alias("at"), "tables", "doc_ids", "sizes", "block_docs", "bodies")
    schema = StructType([StructField("doc_id", id_kind), StructField("start", LongType()), StructField("n_tokens", LongType()), StructField("ids", BinaryType())])
    return map_batches(placed, decoded, schema)


def token_digests(docs: DataFrame, **options) -> DataFrame:
    """Write the files, read them back, and digest each document's identifiers."""
    read = decode_documents(encode_documents(docs, **options))
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
