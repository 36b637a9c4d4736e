"""The shared tables of cuefold.storage, and the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cuefold.storage import gathered, gathered_together, release, scope, settled, shared_dir, written

__all__ = ["gathered", "gathered_together", "release", "scope", "settled", "shared_dir", "table", "written"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
