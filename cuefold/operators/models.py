"""Functions of a caller's model over rows, in Arrow batches; one bad row does not end a job."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cuefold.batches import bounded
from cuefold.columns import free
from cuefold.functions import arrays


def batches(rows: DataFrame, key: list[str], order: list[str], size: int = 8) -> DataFrame:
    """rows with batch, from 0, of `size` rows each within a key."""
    free(rows, "batch")
    place = F.row_number().over(Window.partitionBy(*key).orderBy(*order)) - 1
    return rows.withColumn("batch", F.floor(place / size).cast("int"))


def apply_model(rows: DataFrame, column: str, load: Callable[[], Callable], out: str, out_type: str, size: int = 8) -> DataFrame:
    """rows with `out` and `error`: what the function that `load` makes (once a task) gives for lists of `size` values.

    Where a list fails its values are tried one by one; a value that fails has its error. Columns of those names in rows raise."""
    free(rows, out, "error")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema) + f", `{out}` {out_type}, error string"

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = load()

        def one(value):
            try:
                return model([value])[0], None
            except Exception as e:
                return None, f"{type(e).__name__}: {e}"

        for part in parts:
            found = []
            for at in range(0, len(part), size):
                values = part[column].iloc[at : at + size].tolist()
                try:
                    found += [(x, None) for x in model(values)]
                except Exception:
                    found += [one(v) for v in values]
            yield part.assign(**{out: [f[0] for f in found], "error": [f[1] for f in found]})

    return bounded(rows).mapInPandas(run, schema)


def transcribe_paths(paths: DataFrame, load: Callable[[], Callable], path_col: str = "path", size: int = 8) -> DataFrame:
    """paths with transcript and error: a caller's model over lists of paths."""
    return apply_model(paths, path_col, load, "transcript", "string", size)


def transcribe_bytes(files: DataFrame, load: Callable[[], Callable], content_col: str = "content", size: int = 1) -> DataFrame:
    """files without their contents, with transcript and error: a caller's model over lists of whole files' bytes."""
    return apply_model(files, content_col, load, "transcript", "string", size).drop(content_col)


def tokenise(rows: DataFrame, text_col: str, load: Callable[[], Callable], out: str = "labels", size: int = 64) -> DataFrame:
    """rows with the identifiers that a caller's tokenizer gives for lists of texts, and error."""
    return apply_model(rows, text_col, load, out, "array<int>", size)


def detokenise(rows: DataFrame, ids_col: str, load: Callable[[], Callable], out: str = "text", pad: int | None = None, size: int = 64) -> DataFrame:
    """rows with the texts that a caller's tokenizer gives for lists of identifiers, and error. With `pad`, masked places become padding first."""
    own = rows if pad is None else rows.withColumn(ids_col, arrays.unmask(F.col(ids_col), pad))
    return apply_model(own, ids_col, load, out, "string", size)
