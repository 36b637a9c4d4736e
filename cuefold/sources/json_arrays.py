"""One JSON array in one file, read and written by many tasks.

Reading: Spark's text reader cuts a file into byte ranges at closing braces, wherever these stand. A lexer of three
states (in a string, after a backslash, depth) would have to come from the file's first byte; but what a range does
to the state composes: it turns the state "in a string" over or not, adds to the depth, and passes commas at depths
relative to its own start, one result for each of the two states it may start in. Running sums over the
ranges of a file, a row each, then tell every range its state, depth and number of elements before, and it cuts its
elements on its own. Only elements that cross a range's end are put together again.

Writing: rows are sorted by ranges, every task writes its fragment with its commas, and the fragments are joined by
the store itself where it can, else copied as bytes.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cuefold.batches import bounded
from cuefold.storage import written

_TOKENS = re.compile(r'\\.|"', re.DOTALL)
_MARKS = re.compile(r'"[^"\\]*(?:\\.[^"\\]*)*"?|[\[\]{},]', re.DOTALL)
_REST = re.compile(r'[^"\\]*(?:\\.[^"\\]*)*"?', re.DOTALL)
_OPEN, _CLOSE = "[{", "]}"


def _pieces(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """file, start (of the byte range) and value: the files' texts between closing braces."""
    rows = spark.read.option("lineSep", "}").text(path)
    return rows.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value")


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[int, str, int, str]]:
    """Row, file, start and text of each run of a batch's rows that belong to one range, braces put back between its pieces."""
    if not batch.num_rows:
        return
    differ = np.zeros(batch.num_rows - 1, bool)
    for column in batch.columns[:2]:
        differ |= pc.not_equal(column.slice(1), column.slice(0, batch.num_rows - 1)).to_numpy(zero_copy_only=False)
    cuts = [0, *(np.flatnonzero(differ) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:], strict=False):
        yield a, batch.column(0)[a].as_py(), batch.column(1)[a].as_py(), "}".join(batch.column(2).slice(a, b - a).to_pylist())


class _Effect:
    """What a range of text does to a lexer, for both states that it may start in: outside of a string (0) and in one (1)."""

    def __init__(self):
        self.turned, self.depth, self.commas = False, [0, 0], [Counter(), Counter()]

    def pass_(self, text: str) -> None:
        at = 0
        for m in _TOKENS.finditer(text):
            if m.group() == '"':
                self._outside(text[at : m.start()])
                self.turned, at = not self.turned, m.end()
        self._outside(text[at:])

    def _outside(self, text: str) -> None:
        """Text that is outside of strings in one of the two states only."""
        of = int(self.turned)
        opened = text.count("[") + text.count("{")
        closed = text.count("]") + text.count("}")
        if not opened and not closed:
            self.commas[of][self.depth[of]] += text.count(",")
            return
        for c in re.findall(r"[\[\]{},]", text):
            if c == ",":
                self.commas[of][self.depth[of]] += 1
            else:
                self.depth[of] += 1 if c in _OPEN else -1


def _effects(pieces: DataFrame) -> DataFrame:
    """file, start, turned, depth and commas (by relative depth) of each range."""
    counts = pa.map_(pa.int32(), pa.int64())

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, effect = None, None
        out: list[tuple] = []

        def table() -> pa.RecordBatch:
            found = [pa.array([o[0][0] for o in out]), pa.array([o[0][1] for o in out], pa.int64()), pa.array([o[1].turned for o in out])]
            for of in range(2):
                found += [pa.array([o[1].depth[of] for o in out], pa.int32()), pa.array([list(o[1].commas[of].items()) for o in out], counts)]
            out.clear()
            return pa.RecordBatch.from_arrays(found, ["file", "start", "turned", "depth0", "commas0", "depth1", "commas1"])

        for batch in batches:
            for _, file, start, text in _texts(batch):
                begins = (file, start) != at
                if begins:
                    at, effect = (file, start), _Effect()
                    out.append((at, effect))
                effect.pass_(text if begins and not start else "}" + text)
        if out:
            yield table()

    return bounded(pieces).mapInArrow(read, "file string, start long, turned boolean, depth0 int, commas0 map<int,bigint>, depth1 int, commas1 map<int,bigint>")


def _entries(effects: DataFrame) -> DataFrame:
    """file, start, quoted, depth, before: the state in which each range starts and the array's commas before it; and the state at its end."""
    order = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, 0)
    turned = F.col("turned").cast("int")
    rows = effects.withColumn("turns", F.sum(turned).over(order)).withColumn("quoted", (F.col("turns") - turned) % 2 == 1)
    rows = rows.withColumn("delta", F.when(F.col("quoted"), F.col("depth1")).otherwise(F.col("depth0"))).withColumn("after", F.sum("delta").over(order))
    rows = rows.withColumn("depth", F.col("after") - F.col("delta"))
    commas = F.when(F.col("quoted"), F.col("commas1")).otherwise(F.col("commas0"))
    own = F.coalesce(F.try_element_at(commas, (F.lit(1) - F.col("depth")).cast("int")), F.lit(0))
    rows = rows.withColumn("own", own).withColumn("before", F.sum("own").over(order) - F.col("own"))
    return rows.select("file", "start", "quoted", F.col("depth").cast("int").alias("depth"), "before", (F.col("turns") % 2 == 1).alias("open"), "after")


class _Cutter:
    """Cuts a stream of text into the elements of the array, given the state at its start."""

    def __init__(self, quoted: bool, depth: int, before: int):
        self.quoted, self.depth, self.pos, self.held, self.whole = quoted, depth, before, [], depth == 0

    def pass_(self, text: str) -> Iterator[tuple[int, bool, bool, str]]:
        """(pos, whether it has its start, whether it has its end, text) of elements that end here."""
        begin = at = 0
        if self.quoted:
            m = _REST.match(text)
            at = m.end()
            self.quoted = not (at and text[at - 1] == '"' and _closed(text[:at]))
        for m in _MARKS.finditer(text, at):
            c = m.group()
            if c[0] == '"':
                self.quoted = not (len(c) > 1 and _closed(c[1:]))
            elif c == ",":
                if self.depth == 1:
                    yield self._element(text[begin : m.start()], True)
                    self.pos, begin = self.pos + 1, m.end()
            elif c in _OPEN:
                self.depth += 1
                if self.depth == 1:
                    if c != "[" or text[:m.start()].strip(" \t\r\n﻿"):
                        raise ValueError("not a JSON array")
                    begin = m.end()
            else:
                self.depth -= 1
                if self.depth == 0:
                    yield self._element(text[begin : m.start()], True)
                    begin = m.end()
        if self.depth > 0 or self.quoted:
            self.held.append(text[begin:])

    def _element(self, text: str, ends: bool) -> tuple[int, bool, bool, str]:
        own = (self.pos, self.whole, ends, "".join(self.held) + text)
        self.held, self.whole = [], True
        return own

    def rest(self) -> Iterator[tuple[int, bool, bool, str]]:
        if self.held:
            yield self._element("", False)


def _closed(text: str) -> bool:
    """Whether a text that begins in a string ends with the quote that closes it."""
    if not text.endswith('"'):
        return False
    backslashes = len(text) - 1 - len(text[:-1].rstrip("\\"))
    return backslashes % 2 == 0


_CUT = "file string, start long, pos long, begins boolean, ends boolean, text string"


def _elements(pieces: DataFrame, entries: DataFrame) -> DataFrame:
    """file, start, pos, begins, ends, text: elements, or what a range holds of one."""
    known = pieces.join(F.broadcast(entries.select("file", "start", "quoted", "depth", "before")), ["file", "start"], "left")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, cutter = None, None

        def table(rows: list[tuple]) -> pa.RecordBatch:
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.string())
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], ["file", "start", "pos", "begins", "ends", "text"])

        for batch in batches:
            rows: list[tuple] = []
            for k, file, start, text in _texts(batch):
                begins = (file, start) != at
                if begins:
                    if at:
                        rows += [(*at, *e) for e in cutter.rest()]
                    quoted, depth, before = (batch.column(c)[k].as_py() for c in (3, 4, 5))
                    if quoted is None:
                        raise ValueError(f"{file} was read in other ranges than before: its size or the session's settings have changed; read it again")
                    at, cutter = (file, start), _Cutter(quoted, depth, before)
                rows += [(*at, *e) for e in cutter.pass_(text if begins and not start else "}" + text)]
            if rows:
                yield table(rows)
        if at and (rows := [(*at, *e) for e in cutter.rest()]):
            yield table(rows)

    return known.select("file", "start", "value", "quoted", "depth", "before").mapInArrow(cut, _CUT)


def read(spark: SparkSession, path: str | list[str], schema: str) -> DataFrame:
    """file, pos and the schema's columns of files that hold one JSON array each; pos is the place in the array, from 0.

    A file that ends within its array or a string raises. A file is read in as many tasks as it has ranges (spark.sql.files.maxPartitionBytes)."""
    pieces = _pieces(spark, path)
    entries = written(_entries(_effects(pieces)), "ranges")  # a row for each range
    last = entries.groupBy("file").agg(F.max_by(F.struct("open", "after"), "start").alias("end"))
    broken = last.where(F.col("end.open") | (F.col("end.after") != 0)).select("file").take(5)
    if broken:
        raise ValueError(f"not whole JSON arrays: {[r.file for r in broken]}")
    cut = _elements(pieces, entries)
    whole = cut.where("begins AND ends").select("file", "pos", "text")
    parts = cut.where("NOT (begins AND ends)").groupBy("file", "pos").agg(F.array_sort(F.collect_list(F.struct("start", "text"))).alias("parts"))
    joined = parts.select("file", "pos", F.array_join(F.transform("parts", lambda p: p["text"]), "").alias("text"))
    rows = whole.unionByName(joined).where(F.trim(F.translate("text", "\t\r\n", "   ")) != "")
    return rows.select("file", "pos", F.from_json("text", T._parse_datatype_string(schema)).alias("row")).select("file", "pos", "row.*")


def element(rows: DataFrame, columns: list[str]) -> Column:
    """A row as indented JSON within an array, without its comma."""
    pretty = F.to_json(F.struct(*columns), {"pretty": "true", "ignoreNullFields": "false"})
    return F.concat(F.lit("  "), F.replace(pretty, F.lit("\n"), F.lit("\n  ")))


def write(rows: DataFrame, path: str, pos_col: str = "pos") -> None:
    """One file with one array in order of pos, whose values must differ. No row passes through the driver.

    Fragments are written beside the target. HDFS joins them by their blocks; other stores' fragments are copied as bytes, once,
    by the driver's file system client. The result then replaces the target in one step where the store has one."""
    spark = rows.sparkSession
    top = rows.agg(F.max(pos_col).alias("last"), F.count("*").alias("n"), F.count(pos_col).alias("known")).first()
    if top.n != top.known:
        raise ValueError(f"{pos_col} is null in some rows")
    columns = [c for c in rows.columns if c != pos_col]
    last = F.lit(top["last"]).cast(rows.schema[pos_col].dataType) if top.n else F.lit(None)
    text = F.concat(element(rows, columns), F.when(F.col(pos_col) < last, F.lit(",")).otherwise(F.lit("")))
    if top.n and rows.where(F.col(pos_col) == last).limit(2).count() > 1:
        raise ValueError(f"{pos_col} repeats")
    beside = f"{path}.{uuid.uuid4().hex}"
    rows.select(pos_col, text.alias("value")).orderBy(pos_col).select("value").write.text(beside)
    try:
        _join(spark, beside, path)
    finally:
        _fs(spark, beside).delete(_path(spark, beside), True)


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _fs(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def _join(spark: SparkSession, folder: str, path: str) -> None:
    """Bracket, the folder's fragments in order, bracket: as one file."""
    jvm, fs = spark._jvm, _fs(spark, folder)
    found = [s.getPath() for s in fs.listStatus(_path(spark, folder)) if s.getPath().getName().startswith("part-") and s.getLen()]
    parts = sorted(found, key=lambda p: (int(p.getName().split("-")[1]), p.getName()))
    head, tail = _path(spark, f"{folder}/head"), _path(spark, f"{folder}/tail")
    for at, text in ((head, "[\n"), (tail, "]")):
        out = fs.create(at, True)
        out.write(bytearray(text.encode()))
        out.close()
    if fs.getScheme() == "hdfs":
        array = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Path, len(parts) + 1)
        for i, p in enumerate([*parts, tail]):
            array[i] = p
        fs.concat(head, array)
        joined = head
    else:
        joined = _path(spark, f"{folder}/joined")
        out = fs.create(joined, True)
        for p in [head, *parts, tail]:
            given = fs.open(p)
            jvm.org.apache.hadoop.io.IOUtils.copyBytes(given, out, 1 << 20, False)
            given.close()
        out.close()
    replace(spark, joined, path)


def replace(spark: SparkSession, made, path: str) -> None:
    """Rename a file over another, in one step where the store has one; the old file's checksum goes with it."""
    jvm, to = spark._jvm, _path(spark, path)
    fs = to.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(to.getParent())
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(to.toUri(), spark._jsc.hadoopConfiguration()).rename(made, to, options)
