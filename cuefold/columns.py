"""Names of columns that operators add."""

from __future__ import annotations

from pyspark.sql import DataFrame


def free(df: DataFrame, *names: str) -> DataFrame:
    """df, or an error that names those of the columns that it holds already, whatever their case."""
    held = {c.lower() for c in df.columns}
    taken = sorted({n for n in names if n.lower() in held})
    if taken:
        raise ValueError(f"rename these columns before: {taken}")
    return df
