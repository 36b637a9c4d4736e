"""An append-only table: one folder of rows and one record in the log for each run.

    <path>/rows/<batch>-<attempt>/part-*.parquet     rows with `place`, from 0 within the batch
    <path>/log/<version>.json                        batch, folder, n, first (the rows before)

A batch counts from the moment when its record is there, and records are created only where none of that version is,
so of two runs that write at once one fails and nothing is lost. A batch that is in the log already is not
written again, so a retry of a run that was killed after its record adds nothing; one that was killed before it
left a folder that no record names and no reader sees. A run reads the keys of what is there (a column, which
doesn't move where the run's own keys are few enough to be broadcast, and is pruned by Spark's runtime filters where
they aren't) and writes its new rows only. Positions are the batches' first places in the log and the rows' own.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cuefold.operators.numbering import numbered
from cuefold.storage import written

#: Keys of a run that are broadcast at most.
MAX_KEYS = 1_000_000
_LOG = "version long, batch string, folder string, n long, first long"


class Conflict(RuntimeError):
    """Another run has appended meanwhile; read again and repeat."""


def _at(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def exists(spark: SparkSession, path: str) -> bool:
    fs, at = _at(spark, f"{path}/log")
    return bool(fs.exists(at))


def log(spark: SparkSession, path: str) -> DataFrame:
    """version, batch, folder, n, first: a row for each run."""
    return spark.read.schema(_LOG).json(f"{path}/log/*.json") if exists(spark, path) else spark.createDataFrame([], _LOG)


def read(spark: SparkSession, path: str, schema: str | T.StructType | None = None) -> DataFrame:
    """pos and the columns of all rows in the log."""
    runs = log(spark, path)
    folders = [r.folder for r in runs.select("folder").collect()]  # a name for each run
    if not folders:
        empty = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
        if empty is None:
            raise ValueError(f"{path} holds no batch, and no schema was given")
        return spark.createDataFrame([], empty)
    rows = spark.read.parquet(*[f"{path}/rows/{f}" for f in folders]).withColumn("_folder", F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2))
    known = F.broadcast(runs.select(F.col("folder").alias("_folder"), "first"))
    out = rows.join(known, "_folder").withColumn("pos", F.col("first") + F.col("place")).drop("_folder", "first", "place")
    return out.select("pos", *[c for c in out.columns if c != "pos"])


def unseen(spark: SparkSession, path: str, rows: DataFrame, key: str) -> DataFrame:
    """The rows whose key is not in the log's rows; `rows` must be a table that can be read again."""
    folders = [r.folder for r in log(spark, path).select("folder").collect()]
    if not folders:
        return rows
    done = spark.read.parquet(*[f"{path}/rows/{f}" for f in folders]).select(F.col(key).alias("_key"))
    asked = rows.select(F.col(key).alias("_key")).distinct()
    few = asked.limit(MAX_KEYS + 1).count() <= MAX_KEYS
    met = done.join(F.broadcast(asked) if few else asked, "_key", "left_semi").distinct()
    return rows.join(met, F.col(key) == F.col("_key"), "left_anti")


def append(spark: SparkSession, path: str, rows: DataFrame, batch: str, key: str | None = None, order: list[str] | None = None) -> int:
    """Write the rows as one batch, without those whose `key` is there already; the number of rows that this call added.

    `order` (total) gives their places, else they have those that they are written in. A batch that the log holds adds nothing."""
    runs = log(spark, path).agg(F.max("version").alias("version"), F.max_by(F.col("first") + F.col("n"), "version").alias("first"), F.max(F.col("batch") == batch).alias("done")).first()
    if runs.done:
        return 0
    fresh = rows if key is None else unseen(spark, path, written(rows, "found"), key)
    placed = numbered(fresh, [F.col(c) for c in order] if order else [F.monotonically_increasing_id()], "place").withColumn("place", F.col("place") - 1).drop("pos")
    folder = f"{batch}-{uuid.uuid4().hex}"
    placed.write.parquet(f"{path}/rows/{folder}")
    n = spark.read.parquet(f"{path}/rows/{folder}").count()
    _commit(spark, path, {"version": (runs.version or 0) + 1, "batch": batch, "folder": folder, "n": n, "first": runs["first"] or 0})
    return n


def _commit(spark: SparkSession, path: str, record: dict) -> None:
    """Create the log's next record; it fails where another run has."""
    name = f"{path}/log/{record['version']:020d}.json"
    fs, at = _at(spark, name)
    if fs.exists(at):
        raise Conflict(name)
    beside = _at(spark, f"{path}/log/.{uuid.uuid4().hex}")[1]
    out = fs.create(beside, True)
    out.write(bytearray(json.dumps(record).encode()))
    out.close()
    none = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 1)
    none[0] = spark._jvm.org.apache.hadoop.fs.Options.Rename.NONE  # fails where the target is there
    try:
        spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(at.toUri(), spark._jsc.hadoopConfiguration()).rename(beside, at, none)
    except Exception as e:
        fs.delete(beside, False)
        if fs.exists(at):
            raise Conflict(name) from e
        raise
