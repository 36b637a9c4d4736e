"""Arrow batches bounded by bytes: what a Python worker holds doesn't grow with the length of texts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"
#: Of one batch; a row above it is a batch of its own.
MAX_BYTES = 8 << 20


def map_batches(df: DataFrame, function: Callable, schema: StructType | str) -> DataFrame:
    """df.mapInArrow in batches of MAX_BYTES. It is a setting of df's session, which stays as it is where it is set already."""
    conf = df.sparkSession.conf
    if conf.get(LIMIT, None) is None:
        conf.set(LIMIT, MAX_BYTES)
    return df.mapInArrow(function, schema)
