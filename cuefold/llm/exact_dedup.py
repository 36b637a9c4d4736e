"""Exact dedup by two passes around a Bloom filter, with DataFrame functions alone.

Pass one hashes every normalised text and builds a Bloom filter of repeats: HASHES bit positions for each
hash, in words of 64 bits; a word holds the bits that were set more than once. A filter has BITS_PER_ROW bits
for each row. Where that is more than max_bits, the hashes are dealt by other bits into as many slices as keep
it below, each with a filter of its own, one after the other; so the words that hold a repeat, broadcast, have
a proven bound at any number of rows. Pass two probes the filter: a row with a position that was set only once
is alone and passes straight through; only the rest, the possibly repeated hashes, shuffle. Groups of HOT rows
or more are few (rows / HOT at most, HOT grows with the rows); they are summed before any shuffle and
broadcast, so no task gathers a large group. Hashes, ids and places in files move, texts never do.

Texts are equal when identical after lower-casing A-Z. Of equal texts the row with the largest doc_id stays
(a null doc_id is the smallest). Null counts as empty; of rows that share text and doc_id one stays, in
drop_copies the one whose columns have the greatest hash, and of rows that repeat wholly the last by place;
an empty table gives an empty one; columns beyond the id and the text are ignored, or kept by drop_copies.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cuefold.llm.rows import Rows
from cuefold.llm.storage import gathered_together, written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
HASHES = 2
BITS_PER_ROW = 16
#: Of one filter: 4 M words at most, of which about a third hold a repeat by chance, of 16 bytes each.
MAX_BITS = 1 << 28
MAX_FOLDERS = 256
#: Slices that are worked on at once; the broadcasts of so many are held.
AT_ONCE = 8
HOT = 64
MAX_HOT = 20_000


def normalised(text: Column) -> Column:
    return F.translate(F.coalesce(text.cast("string"), F.lit("")), UPPER, LOWER)


def digest(text: Column) -> Column:
    return F.unhex(F.sha2(normalised(text), 256))


def digests(docs: DataFrame, id_col: str, text_col: str, order: list[Column]) -> DataFrame:
    """sha and own (doc_id, then `order`, which tells rows apart) of every row, written once."""
    own = F.struct(docs[id_col].alias("doc_id"), *order)
    return written(docs.select(digest(docs[text_col]).alias("sha"), own.alias("own")), "digests")


def slices(slim: DataFrame, max_bits: int = MAX_BITS) -> Iterator[tuple[DataFrame, int]]:
    """Rows of slim and their number (about, for slices) in parts of which each has BITS_PER_ROW bits a row in max_bits."""
    n_rows = slim.count()
    n = 1
    while BITS_PER_ROW * n_rows > n * max_bits:
        n *= 2
    if n == 1:
        yield slim, n_rows
        return
    part = F.pmod(F.conv(F.hex(F.substring("sha", 29, 4)), 16, 10).cast("long"), F.lit(n))  # positions use other bytes
    per_folder = -(-n // MAX_FOLDERS)
    dealt = slim.withColumn("slice", part).withColumn("folder", F.floor(F.col("slice") / per_folder).cast("int"))
    dealt = written(dealt.repartition("slice"), "slices", by=("folder",))  # hashes and ids, so that a task writes few folders
    for k in range(n):
        own = dealt.where((F.col("folder") == k // per_folder) & (F.col("slice") == k))
        yield own.drop("slice", "folder"), -(-n_rows // n)


def _bits(n_rows: int, max_bits: int) -> int:
    """A power of two: BITS_PER_ROW for each row, max_bits at most."""
    return min(max_bits, max(1 << 10, 1 << (BITS_PER_ROW * n_rows - 1).bit_length()))


def _positions(bits: int) -> Column:
    """HASHES bit positions, from separate parts of the digest."""
    parts = [F.conv(F.hex(F.substring("sha", 1 + 7 * k, 7)), 16, 10).cast("long") for k in range(HASHES)]
    return F.array(*[F.pmod(p, F.lit(bits)) for p in parts])


def repeats(slim: DataFrame, n_rows: int, max_bits: int = MAX_BITS) -> tuple[DataFrame, int]:
    """Words of the filter that hold a bit set more than once: word, twice; and the number of bits."""
    bits = _bits(n_rows, max_bits)
    spots = slim.select(F.explode(_positions(bits)).alias("p"))
    bit = F.expr("shiftleft(1L, cast(p & 63 as int))")
    words = spots.groupBy(F.shiftright("p", 6).alias("word")).agg(F.bit_or(bit).alias("any"), F.bit_xor(bit).alias("odd"), F.count("*").alias("n"))
    even = F.col("any").bitwiseAND(F.bitwise_not("odd"))  # set an even number of times: twice at least
    extra = F.col("n") - F.bit_count("any")  # settings beyond the first of each bit
    # an even bit accounts for one extra; where more are left, some bit was set three times or more, and all set bits may be
    twice = F.when(extra == F.bit_count(even), even).otherwise(F.col("any"))
    return words.where(extra > 0).select("word", twice.alias("twice")), bits


def probed(rows: DataFrame, words: DataFrame, bits: int) -> DataFrame:
    """rows (with sha) and maybe: whether all positions of the hash were set more than once."""
    held = rows.withColumn("_at", _positions(bits))
    maybe = F.lit(True)
    for k in range(HASHES):
        own = words.select(F.col("word").alias(f"_w{k}"), F.col("twice").alias(f"_t{k}"))
        at = F.col("_at")[k]
        held = held.join(F.broadcast(own), F.shiftright(at, 6) == F.col(f"_w{k}"), "left")  # at most bits / 64 words of 16 bytes
        maybe = maybe & F.coalesce(F.col(f"_t{k}").bitwiseAND(F.expr(f"shiftleft(1L, cast(_at[{k}] & 63 as int))")) != 0, F.lit(False))
    return held.withColumn("maybe", maybe).drop("_at", *[f"_{x}{k}" for x in "wt" for k in range(HASHES)])


def _grouped(slim: DataFrame, n_rows: int, max_bits: int) -> DataFrame:
    words, bits = repeats(slim, n_rows, max_bits)
    rows = probed(slim, written(words, "bloom"), bits)
    alone = rows.where(~F.col("maybe")).select("sha", "own", F.col("own").alias("best"), F.lit(1).cast("long").alias("group_size"))
    maybe = written(rows.where("maybe").select("sha", "own"), "candidates")
    least = max(HOT, n_rows // MAX_HOT)
    best = F.max("own")
    large = maybe.groupBy("sha").agg(best.alias("best"), F.count("*").alias("group_size")).where(F.col("group_size") >= least)
    large = written(large, "large")  # n_rows / least rows at most
    in_large = maybe.join(F.broadcast(large), "sha").select(alone.columns)
    small = maybe.join(F.broadcast(large.select("sha")), "sha", "left_anti")
    same = Window.partitionBy("sha")  # fewer than `least` rows each
    in_small = small.select("sha", "own", best.over(same).alias("best"), F.count("*").over(same).alias("group_size"))
    return alone.unionByName(in_large).unionByName(in_small)


def grouped(slim: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """slim with best (the own of the row that stays of its group) and group_size."""
    parts = slices(slim, max_bits)
    first, n_rows = next(parts)
    if first is slim:
        return _grouped(slim, n_rows, max_bits)

    made = [lambda part=part, n=n: _grouped(part, n, max_bits) for part, n in [(first, n_rows), *parts]]
    return gathered_together(slim.sparkSession, made, "groups", AT_ONCE)


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_bits: int = MAX_BITS) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    found = grouped(digests(docs, id_col, text_col, [F.monotonically_increasing_id().alias("rid")]), max_bits)
    kept = F.col("own.rid") == F.col("best.rid")
    return found.select(
        F.col("own.doc_id").alias("doc_id"), F.col("best.doc_id").alias("keep_id"), "group_size", kept.alias("kept"), F.lower(F.hex("sha")).alias("text_sha256")
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_bits: int = MAX_BITS) -> DataFrame:
    """docs, all columns, without the rows that are not the best of their group."""
    rows = Rows(docs)
    column = lambda f: rows.docs[f"`{f.name}`"]
    hashable = [F.to_json(F.struct(column(f))) if any(x in f.dataType.simpleString() for x in ("map<", "variant")) else column(f) for f in rows.docs.schema]
    slim = digests(rows.docs, id_col, text_col, [F.xxhash64(*hashable).alias("row"), *rows.place()])
    found = grouped(slim, max_bits).where(~((F.col("own.row_file") == F.col("best.row_file")) & (F.col("own.row_at") == F.col("best.row_at"))))
    return rows.without(found.select("own.row_file", "own.row_at"))


def oracle() -> str:
    low = f"translate(coalesce(text, ''), '{UPPER}', '{LOWER}')"
    return f"""
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept, sha256(low) AS text_sha256
FROM (SELECT doc_id, {low} AS low FROM documents) WINDOW w AS (PARTITION BY low)"""
