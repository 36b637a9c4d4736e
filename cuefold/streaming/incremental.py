"""Incremental append: only videos that the manifest does not hold are processed."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cuefold.operators import pairing
from cuefold.sources import ledger


def append_batch(done: DataFrame, found: DataFrame, process: Callable[[DataFrame], DataFrame], key: str = "video_id") -> DataFrame:
    """done and the processed rows of what is new."""
    return done.unionByName(process(pairing.unseen(found, done, key)), allowMissingColumns=True)


def append_stream(
    spark: SparkSession, source: str, schema: str, target: str, checkpoint: str, process: Callable[[DataFrame], DataFrame], key: str = "video_id", file_format: str = "json"
):
    """Process files that are new since the last call and append them, then stop.

    The checkpoint remembers the files and the target's rows remember the keys, so neither a file that comes
    again nor a batch that is retried adds a key twice. Of a batch's rows of one key the least as JSON stays. Returns the finished query."""

    def put(batch: DataFrame, _: int) -> None:
        row = F.struct(*batch.columns)
        new = batch.groupBy(F.col(key).alias("_key")).agg(F.min_by(row, F.to_json(row)).alias("row")).select("row.*")
        at = spark._jvm.org.apache.hadoop.fs.Path(target + "/_SUCCESS")
        if at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at):
            new = pairing.unseen(new, spark.read.parquet(target), key)
        process(new).write.mode("append").parquet(target)

    rows = spark.readStream.schema(schema).format(file_format).load(source)
    query = rows.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def log_stream(
    spark: SparkSession, source: str, schema: str, target: str, checkpoint: str, process: Callable[[DataFrame], DataFrame], key: str = "video_id", file_format: str = "json"
):
    """As append_stream, into an append-only log (sources.ledger): a micro-batch reads the log's keys, writes its new rows and one
    record, under a name made of the checkpoint and its number, so that one that is run again adds nothing. Returns the finished query."""
    name = hashlib.sha256(checkpoint.encode()).hexdigest()[:16]

    def put(batch: DataFrame, number: int) -> None:
        row = F.struct(*batch.columns)
        new = batch.groupBy(F.col(key).alias("_key")).agg(F.min_by(row, F.to_json(row)).alias("row")).select("row.*")
        ledger.append(batch.sparkSession, target, process(new), f"{name}-{number}", key, [key])

    rows = spark.readStream.schema(schema).format(file_format).load(source)
    query = rows.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query
