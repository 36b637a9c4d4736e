"""Tables that cut lineage, in the folder all executors share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
import warnings
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import ContextVar, copy_context
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType
from pyspark.util import inheritable_thread_target

_own: dict[str, str] = {}
_written: list[tuple[SparkSession, str]] = []
#: Who a table belongs to: the scopes and steps that its writer is in. Other threads have their own.
_within: ContextVar[tuple[object, ...]] = ContextVar("cuefold_within", default=())
_owners: dict[str, tuple[object, ...]] = {}
#: The folder of each table that is still in use.
_folder: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; in local mode a temporary one where that is unset."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if spark.sparkContext.master != "local" and not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return _own.setdefault(spark.sparkContext.applicationId, "file://" + tempfile.mkdtemp(prefix="cuefold-"))


def _path(spark: SparkSession, label: str) -> str:
    if not _written:
        atexit.register(release)
    path = f"{shared_dir(spark)}/cuefold-{label}-{uuid.uuid4().hex}"
    _written.append((spark, path))
    _owners[path] = _within.get()
    return path


def folder(spark: SparkSession, label: str) -> str:
    """A new name in the shared folder, for what is no single table; it goes as tables do."""
    return _path(spark, label)


def written(df: DataFrame, label: str, by: tuple[str, ...] = ()) -> DataFrame:
    """df as a Parquet table in the shared folder, in folders by the columns of `by`: computed once, safe from lost executors."""
    path = _path(df.sparkSession, label)
    df.write.partitionBy(*by).parquet(path) if by else df.write.parquet(path)
    return _read(df.sparkSession, df.schema, path)


def _read(spark: SparkSession, schema: StructType, path: str) -> DataFrame:
    out = spark.read.schema(schema).parquet(path)
    _folder[out] = path
    return out


def gathered(parts: Iterable[DataFrame], label: str) -> DataFrame:
    """The rows of all parts, one at least, in one table. Parts are computed one after the other, so that only one's broadcasts are held."""
    path = None
    for part in parts:
        if path is None:
            spark, schema, path = part.sparkSession, part.schema, _path(part.sparkSession, label)
        part.write.mode("append").parquet(path)
    return _read(spark, schema, path)


def gathered_together(spark: SparkSession, makes: list[Callable[[], DataFrame]], label: str, at_once: int) -> DataFrame:
    """The rows of what all of `makes`, one at least, return, in one table. So many are made and written at once, each in a folder of its own, so the cluster isn't idle at the end of each."""
    path = _path(spark, label)

    def put(k: int) -> StructType:
        part = makes[k]()
        part.write.parquet(f"{path}/{k}")
        return part.schema

    with ThreadPoolExecutor(at_once) as pool:  # threads of the driver, which only start jobs
        schemas = list(pool.map(lambda x: x[0].run(inheritable_thread_target(spark)(put), x[1]), [(copy_context(), k) for k in range(len(makes))]))
    out = spark.read.schema(schemas[0]).option("recursiveFileLookup", True).parquet(path)
    _folder[out] = path
    return out


@contextmanager
def _owned() -> Iterator[object]:
    """What is written within, by this thread, belongs to the token that it gets."""
    token = object()
    before = _within.set((*_within.get(), token))
    try:
        yield token
    finally:
        _within.reset(before)


def _taken(gone: Callable[[str], bool]) -> list[tuple[SparkSession, str]]:
    """Tables that leave the list of what is to be deleted."""
    found = [x for x in _written if gone(x[1])]
    for x in found:
        _written.remove(x)
        _owners.pop(x[1], None)
    return found


def settled(make: Callable[[], DataFrame], label: str, *done: DataFrame) -> DataFrame:
    """What `make` returns as a table; the tables that were written on the way go, and so do those of `done` that are such tables themselves."""
    with _owned() as steps:
        made = make()
    out = written(made, label)
    folders = {_folder.get(d) for d in done}
    _delete(_taken(lambda path: steps in _owners.get(path, ()) or path in folders))
    return out


@contextmanager
def scope() -> Iterator[None]:
    """Tables that this thread writes within go at its end, whatever happens; results must be consumed or written elsewhere before."""
    with _owned() as own:
        try:
            yield
        finally:
            _delete(_taken(lambda path: own in _owners.get(path, ())))


def release() -> None:
    """Delete the tables that this process has written. Their DataFrames can't be read afterwards.

    A folder that can't be deleted (its session has ended, its store fails) does not keep the others; it is
    named in a warning. After a driver's loss, delete cuefold-* in the shared folder by hand."""
    _delete(_taken(lambda path: True))


def _delete(tables: list[tuple[SparkSession, str]]) -> None:
    for spark, path in reversed(tables):
        try:
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
        except Exception as e:
            if path.startswith("file:") or path.startswith("/"):
                shutil.rmtree(path.removeprefix("file://"), ignore_errors=True)
            else:
                warnings.warn(f"{path} stays: {type(e).__name__}", stacklevel=2)
