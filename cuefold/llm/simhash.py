"""SimHash near-dedup by multi-index hashing.

A document's fingerprint has a bit set where more than half of its shingles' hashes have it. Distinct
fingerprints are indexed by each of their two 32-bit segments. Two that differ in DISTANCE = 3 bits or
fewer differ in one bit at most in one segment; so for each fingerprint and segment the ball of radius 1
is enumerated (the key itself and, from the side that lacks the bit, those with one bit more), the index's
matches are fetched, and the complete distance is verified. A key that more than FULL fingerprints share is
split: its other segment's two 16-bit halves differ in one bit at most in one of them, so balls of radius 1
in these are keys of a second index. A second key leaves 16 bits open, so it holds 65,536 fingerprints at
most, however many there are. Links between distinct fingerprints are contracted to components: in each round
every node joins the neighbour of least random priority, edges are renamed, and what has become one node goes,
until no edge is left.

Copies share a fingerprint and never meet in a join among themselves; fingerprints and components of many rows
are broadcast as one row each. The other joins are merges (`hint("merge")`): Spark takes an exploded table for no larger than
its file and would broadcast it through the driver. Texts are lower-cased in A-Z; words are runs of characters other than \\x20 and
\\x09-\\x0D. Fewer words than a shingle has are one shingle; no words (null and empty texts too) give fingerprint
0, which is linked like any other. Rows that repeat an id have fingerprints of their own; a null doc_id is never
a component's id unless all of its are null.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from cuefold.llm.batches import map_batches
from cuefold.llm.rows import Rows, of_hot_keys
from cuefold.llm.storage import written

SHINGLE = 3
SEED = 42
DISTANCE = 3
SEGMENTS = 2
CHUNK = 1 << 16
#: Fingerprints of a key above which it is split; it grows so that MAX_FULL such keys, 8 bytes each, are broadcast at most.
FULL = 64
MAX_FULL = 1 << 20
#: Rows of a fingerprint or component above which it is broadcast; it grows so that these are MAX_HOT at most.
HOT = 64
MAX_HOT = 20_000


def fingerprint(text: bytes | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """64 bits; memory is bounded by the text and CHUNK hashes."""
    found = (text or b"").lower().split()
    if not found:
        return 0
    if len(found) <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(found), seed)
    total, join, hashed = len(found) - shingle + 1, b" ".join, xxhash.xxh64_intdigest
    counts = np.zeros(64, np.int64)
    for at in range(0, total, CHUNK):
        part = found[at : min(at + CHUNK, total) + shingle - 1]
        runs = zip(*[part[k:] for k in range(shingle)], strict=False)
        hashes = np.array([hashed(join(run), seed) for run in runs], "<u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > total, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, also: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, the columns of `also` and fp (the 64 bits as a long) of every row."""
    slim = docs.select(docs[text_col].cast("string").cast("binary").alias("text"), docs[id_col].alias("doc_id"), *also)
    kept = slim.drop("text").schema
    names = [*kept.names, "fp"]

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                found = np.array([fingerprint(text, shingle) for text in part.column(0).to_pylist()], np.uint64)
                yield pa.RecordBatch.from_arrays([*part.columns[1:], pa.array(found.view(np.int64))], names)

    return map_batches(slim, hashed, StructType([*kept.fields, StructField("fp", LongType())]))


def _half(fp: str, k: int) -> Column:
    return F.shiftrightunsigned(fp, 32 * k).bitwiseAND(F.lit(0xFFFFFFFF))


def _ball(bits: int, first: int = 0) -> Column:
    """0 and the numbers with one of `bits` bits, from bit `first` on."""
    return F.array(F.lit(0).cast("long"), *[F.lit(1 << (first + i)).cast("long") for i in range(bits)])


def candidates(distinct: DataFrame, full: int = FULL, max_full: int = MAX_FULL) -> DataFrame:
    """Pairs (a, b) of fingerprints (column fp of `distinct`) that meet in an index, each order once at most for a key."""
    keys = F.array(*[F.struct(_half("fp", k).bitwiseOR(F.lit(k << 32)).alias("key"), _half("fp", 1 - k).alias("rest")) for k in range(SEGMENTS)])
    index = distinct.select("fp", F.explode(keys).alias("at")).select("fp", "at.key", "at.rest")
    probes = index.select("fp", "rest", "key", F.explode(_ball(32)).alias("flip")).where(F.col("key").bitwiseAND(F.col("flip")) == 0)
    probes = probes.select("fp", "rest", F.col("key").bitwiseOR(F.col("flip")).alias("key"), (F.col("flip") == 0).alias("same"))
    once = ~F.col("same") | (F.col("a") < F.col("b"))  # keys that differ are probed from one side only
    least = max(full, 2 * distinct.count() // max_full)
    crowded = written(index.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > least).select("key"), "full")
    if crowded.isEmpty():
        return probes.withColumnRenamed("fp", "a").join(index.select(F.col("fp").alias("b"), "key").hint("merge"), "key").where(once).select("a", "b")
    few = F.broadcast(crowded)  # max_full keys at most
    plain = probes.join(few, "key", "left_anti").withColumnRenamed("fp", "a").join(index.join(few, "key", "left_anti").select(F.col("fp").alias("b"), "key").hint("merge"), "key")
    part = lambda j, flip: F.shiftright(F.col("rest").bitwiseXOR(flip), 16 * j).bitwiseAND(F.lit(0xFFFF)).bitwiseOR(F.lit(j << 16))
    nothing = F.lit(0).cast("long")
    second = index.join(few, "key", "left_semi").select(F.col("fp").alias("b"), "key", F.explode(F.array(*[part(j, nothing) for j in range(2)])).alias("part"))
    asked = probes.join(few, "key", "left_semi").select(F.col("fp").alias("a"), "rest", "key", "same", F.explode(_ball(16)).alias("turn"))
    asked = asked.select("a", "key", "same", F.explode(F.array(*[part(j, F.col("turn") * (1 << 16 * j)) for j in range(2)])).alias("part"))
    return plain.where(once).select("a", "b").unionByName(asked.join(second.hint("merge"), ["key", "part"]).where(once).select("a", "b"))


def links(distinct: DataFrame, distance: int = DISTANCE, full: int = FULL) -> DataFrame:
    """Pairs a < b of fingerprints (column fp of `distinct`) that differ in `distance` bits or fewer."""
    if not 0 <= distance < 2 * SEGMENTS:
        raise ValueError("balls of radius 1 in two segments find up to 3 differing bits")
    near = candidates(distinct.select("fp"), full).where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance)
    return near.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """node and root for every node of the edges (a, b), which must be a table that can be read again."""
    nodes = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
    steps: list[DataFrame] = []
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        priority = lambda c: F.struct(F.xxhash64(F.col(c), F.lit(len(steps))).alias("p"), F.col(c).alias("v"))
        least = both.groupBy(F.col("a").alias("v")).agg(F.min(priority("b")).alias("least"))
        joined = written(least.select("v", F.least(priority("v"), F.col("least"))["v"].alias("to")), "joined")
        to = lambda c: joined.select(F.col("v").alias(c), F.col("to").alias(f"to_{c}")).hint("merge")  # noqa: E731, B023
        renamed = edges.join(to("a"), "a").join(to("b"), "b").select(F.col("to_a").alias("a"), F.col("to_b").alias("b")).where("a <> b")
        edges = written(renamed.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
        steps.append(joined)
    # from the last round back: whom a node joined in a round, and where that one ended in the rounds after it
    ends = None
    for joined in reversed(steps):
        if ends is None:
            ends = joined.select(F.col("v").alias("node"), F.col("to").alias("root"))
            continue
        later = ends.withColumnsRenamed({"node": "to", "root": "_root"})
        ends = joined.join(later.hint("merge"), "to", "left").select(F.col("v").alias("node"), F.coalesce("_root", "to").alias("root"))
    return nodes.withColumn("root", F.col("node")) if ends is None else written(ends, "roots")


def firsts(found: DataFrame, order: Column, distance: int = DISTANCE) -> tuple[DataFrame, int]:
    """fp, first and n of each fingerprint of `found`: the least `order` among the rows of its component, and its rows;
    and the number of rows from which a fingerprint is hot."""
    own = written(found.groupBy("fp").agg(F.min(order).alias("own"), F.count("*").alias("n")), "distinct")
    n_rows, n_distinct = own.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    edges = written(links(own, distance), "links")
    linked = written(own.drop("n").join(components(edges).withColumnRenamed("node", "fp").hint("merge"), "fp"), "linked")
    least = written(linked.groupBy("root").agg(F.min("own").alias("least"), F.count("*").alias("n")), "least")
    named = of_hot_keys(linked.select("fp", "root"), least, "root", max(HOT, n_distinct // MAX_HOT)).select("fp", "least")
    return written(own.join(named.hint("merge"), "fp", "left").select("fp", F.coalesce("least", "own").alias("first"), "n"), "named"), max(HOT, n_rows // MAX_HOT)


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id."""
    found = written(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    first, least = firsts(found, F.col("doc_id"), distance)
    rows = of_hot_keys(found, first, "fp", least)
    return rows.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("first").alias("component_id"))


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """docs, all columns, without the rows that are not the first of their component: one row of each stays.

    The first has the smallest doc_id (null after all others); of several rows with that id, it is the one whose text has
    the least hash, then the first by place. Fingerprints, ids and places move, texts don't."""
    rows = Rows(docs)
    text = rows.docs[text_col].cast("string")
    place = rows.place()
    slim = rows.docs.select(rows.docs[id_col].alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("row"), *place)
    found = written(fingerprints(slim, "doc_id", "text", shingle, ("row", "row_file", "row_at")), "fingerprints")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row", "row_file", "row_at")
    first, least = firsts(found, order, distance)
    judged = of_hot_keys(found, first, "fp", least)
    stays = (F.col("row_file") == F.col("first.row_file")) & (F.col("row_at") == F.col("first.row_at"))
    return rows.without(judged.where(~stays).select("row_file", "row_at"))
