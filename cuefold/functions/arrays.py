"""Arrays: padding and masks as expressions, and word edit distance in Arrow batches."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cuefold.columns import free

IGNORED = -100


def pad_and_mask(df: DataFrame, batch_col: str, labels_col: str, bos: int, ignored: int = IGNORED) -> DataFrame:
    """labels padded with `ignored` to the longest of the batch; a start token that all rows have is dropped."""
    free(df, "_width", "_bos")
    size = F.size(labels_col)
    sums = df.groupBy(batch_col).agg(F.max(size).alias("_width"), F.every(F.coalesce(F.get(F.col(labels_col), F.lit(0)) == bos, F.lit(False))).alias("_bos"))
    own = df.join(sums, batch_col)
    padded = F.concat(F.col(labels_col), F.array_repeat(F.lit(ignored), F.col("_width") - size))
    return own.withColumn(labels_col, F.when(F.col("_bos"), F.slice(padded, F.lit(2), F.greatest(F.col("_width") - 1, F.lit(0)))).otherwise(padded)).drop("_width", "_bos")


def unmask(labels: Column, pad: int, ignored: int = IGNORED) -> Column:
    return F.transform(labels, lambda x: F.when(x == ignored, F.lit(pad)).otherwise(x))


def let(value: Column, body) -> Column:
    """body of a value that is computed once, however often body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def tokens(text: Column) -> Column:
    """Words split on spaces; none in an empty text."""
    return F.filter(F.split(text, " "), lambda w: w != "")


def edit_distance(a: list, b: list) -> int:
    """Substitutions, deletions and insertions between two lists, a column of the distance table at a time as bits of
    two integers (Myers' bit vectors, in Hyyrö's form for whole distances)."""
    first = 0
    most = min(len(a), len(b))
    while first < most and a[first] == b[first]:
        first += 1
    last = 0
    while last < most - first and a[-1 - last] == b[-1 - last]:
        last += 1
    a, b = a[first : len(a) - last], b[first : len(b) - last]
    if not a or not b:
        return len(a) + len(b)
    places: dict = {}
    for i, x in enumerate(a):
        places[x] = places.get(x, 0) | 1 << i
    top, every, score = 1 << (len(a) - 1), (1 << len(a)) - 1, len(a)
    up, down = every, 0  # where the column grows by one, or falls by one
    for y in b:
        same = places.get(y, 0)
        across = (((same & up) + up) ^ up) | same
        grows, falls = down | (every & ~(across | up)), up & across
        score += 1 if grows & top else -1 if falls & top else 0
        grows = (grows << 1 | 1) & every
        kept = same | down
        up, down = (falls << 1 & every) | (every & ~(kept | grows)), grows & kept
    return score


def _edits(reference: pd.Series, hypothesis: pd.Series) -> pd.Series:
    words = lambda s: [w for w in s.split(" ") if w]
    found = [None if r is None or h is None else 0 if r == h else edit_distance(words(r), words(h)) for r, h in zip(reference, hypothesis, strict=True)]
    return pd.Series(found, dtype="Int32")


def word_edits(reference: Column, hypothesis: Column) -> Column:
    """Substitutions, deletions and insertions between two texts' words, in Arrow batches; null where a text is null.

    The built-in levenshtein compares characters, and each of its cells costs a step; here a word of 64 cells does."""
    return F.pandas_udf(_edits, "int")(reference, hypothesis)
