"""Word error rates: sums of edits over sums of reference words, overall and by bucket."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cuefold.functions import arrays
from cuefold.functions import text as T


def edits(predictions: DataFrame, normalised: bool = False) -> DataFrame:
    """predictions (reference, prediction) with edits and ref_words."""
    form = T.wer_text if normalised else (lambda c: c)
    ref, hyp = form(F.col("reference")), form(F.col("prediction"))
    return predictions.withColumn("edits", arrays.word_edits(ref, hyp)).withColumn("ref_words", F.size(arrays.tokens(ref)))


def wer(rows: DataFrame, by: list[str]) -> DataFrame:
    """by, n, wer of rows with edits and ref_words."""
    rate = F.when(F.sum("ref_words") > 0, 100 * F.sum("edits") / F.sum("ref_words"))
    return rows.groupBy(*by).agg(F.count("*").alias("n"), rate.alias("wer"))


def wer_by_bucket(predictions: DataFrame, by: list[str]) -> DataFrame:
    """by, bucket, n, wer on normalised text; rows hold an array of buckets."""
    return wer(edits(predictions, True).withColumn("bucket", F.explode("buckets")), [*by, "bucket"])


def wer_delta(base: DataFrame, tuned: DataFrame, by: list[str]) -> DataFrame:
    """by, base, tuned, delta (positive: better); what one side lacks is null."""
    a, b = base.select(*by, F.col("wer").alias("base")), tuned.select(*by, F.col("wer").alias("tuned"))
    return a.join(b, by, "full_outer").withColumn("delta", F.col("base") - F.col("tuned"))


def aligned(sidecar: DataFrame, rows: DataFrame) -> DataFrame:
    """n_sidecar, n_rows, n_equal, aligned: whether both hold the same sentence at each position."""
    both = sidecar.select("pos", F.col("sentence").alias("a")).join(rows.select("pos", F.col("sentence").alias("b")), "pos", "full_outer")
    sums = both.agg(F.count("a").alias("n_sidecar"), F.count("b").alias("n_rows"), F.count_if(F.col("a") == F.col("b")).alias("n_equal"))
    return sums.withColumn("aligned", (F.col("n_sidecar") == F.col("n_rows")) & (F.col("n_equal") == F.col("n_rows")))


#: Ranges of positions that are told apart at once.
RANGES = 4096


def first_difference(a: DataFrame, b: DataFrame, pos_col: str = "pos", value_col: str = "sentence", ranges: int = RANGES) -> int | None:
    """The first position where two tables differ (a value, a row that one lacks, or rows more of it), or None.

    Positions are cut into ranges; of each, both sides' digests (sums of hashes of position and value, one side's with a minus)
    come to nothing where they agree. The first range that differs is cut again, so nothing is joined, what shuffles is `ranges`
    rows a task, and rows are read as often as the logarithm of their number to the base `ranges`."""
    def side(rows: DataFrame, sign: int) -> DataFrame:
        hashes = [F.xxhash64(F.lit(k), F.col(pos_col).cast("long"), value_col).bitwiseAND(F.lit(0x7FFFFFFF)) * sign for k in range(2)]
        return rows.select(F.col(pos_col).cast("long").alias("at"), F.lit(sign).alias("n"), hashes[0].alias("x"), hashes[1].alias("y"))

    both = side(a, 1).unionByName(side(b, -1))
    low, high = both.agg(F.min("at"), F.max("at")).first()
    if low is None:
        return None
    while True:
        width = max(1, -(-(high - low + 1) // ranges))
        own = both.where(F.col("at").between(low, high)).groupBy(((F.col("at") - low) / width).cast("long").alias("range"))
        sums = own.agg(*[F.sum(c).alias(c) for c in "nxy"]).where("n <> 0 OR x <> 0 OR y <> 0")
        first = sums.agg(F.min("range")).first()[0]
        if first is None:
            return None
        low, high = low + first * width, min(high, low + (first + 1) * width - 1)
        if width == 1:
            return low


def alignment(sidecar: DataFrame, rows: DataFrame, ranges: int = RANGES) -> DataFrame:
    """n_sidecar, n_rows, first_pos: the sizes, and the first position where the sentences differ (null: nowhere)."""
    first = first_difference(sidecar, rows, ranges=ranges)
    counts = sidecar.agg(F.count("*").alias("n_sidecar")), rows.agg(F.count("*")).first()[0]
    return counts[0].withColumns({"n_rows": F.lit(counts[1]).cast("long"), "first_pos": F.lit(first).cast("long")})
