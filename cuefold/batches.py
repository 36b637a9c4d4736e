"""Arrow batches bounded by bytes: what a Python worker holds doesn't grow with the length of texts."""

from __future__ import annotations

from pyspark.sql import DataFrame

LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"
#: Of one batch; a row above it is a batch of its own.
MAX_BYTES = 8 << 20


def bounded(df: DataFrame) -> DataFrame:
    """df, of whose session batches are bounded from now on. It is the session's setting, as Spark has none for one operator: it holds for
    all later Python functions of the session, and stays as it is where it is set already."""
    conf = df.sparkSession.conf
    if conf.get(LIMIT, None) is None:
        conf.set(LIMIT, MAX_BYTES)
    return df
