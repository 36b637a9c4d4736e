"""Rows of a table by their place in its files: a second reading finds the same rows, and none has to move.

A place is the hash of the file's path and the row's number in the file. A table that is no plain reading of
files (its rows come from a shuffle, a limit, a random number) is written once, and its copy's places count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cuefold.llm.storage import gathered, written

#: Words of 64 rows that are broadcast at once, of 24 bytes each.
MAX_WORDS = 1 << 20
_PLAIN = {"Project", "Filter", "SubqueryAlias", "LogicalRelation"}


def _plain_reading(docs: DataFrame) -> bool:
    plan = docs._jdf.queryExecution().analyzed()
    todo = [plan]
    while todo:
        node = todo.pop()
        if node.nodeName() not in _PLAIN:
            return False
        todo += [node.children().apply(i) for i in range(node.children().size())]
    return bool(plan.deterministic())


class Rows:
    """A table whose rows have places."""

    def __init__(self, docs: DataFrame):
        self.docs = docs
        if _plain_reading(docs):
            try:
                docs.select(*self.place())
                return
            except Exception as e:
                if "UNRESOLVED" not in str(e) and "METADATA" not in str(e).upper():
                    raise  # files that tell no row numbers are copied, other errors are none of ours
        self.docs = written(docs, "rows")

    def place(self) -> list[Column]:
        """row_file and row_at of a row."""
        of = self.docs.metadataColumn("_metadata")
        return [F.xxhash64(of["file_path"]).alias("row_file"), of["row_index"].alias("row_at")]

    def without(self, dropped: DataFrame) -> DataFrame:
        """The table, all columns, without the rows whose places are in `dropped` (row_file, row_at).

        Dropped rows become bits of words of 64 rows, which are broadcast; where there are more than MAX_WORDS
        words, files are read in as many groups as keep each broadcast below, one after the other."""
        bit = F.expr("shiftleft(1L, cast(row_at & 63 as int))")
        words = dropped.withColumn("bit", bit).groupBy("row_file", F.shiftright("row_at", 6).alias("row_word")).agg(F.bit_or("bit").alias("bits"))
        words = written(words, "dropped")
        groups = max(1, -(-words.count() // MAX_WORDS))

        def part(g: int) -> DataFrame:
            file, at = self.place()
            rows = self.docs.select(F.struct("*").alias("doc"), file, at)
            own = words
            if groups > 1:
                mine = F.pmod(F.col("row_file"), F.lit(groups)) == g
                rows, own = rows.where(mine), words.where(mine)
            rows = rows.withColumn("row_word", F.shiftright("row_at", 6)).join(F.broadcast(own), ["row_file", "row_word"], "left")
            return rows.where(F.coalesce(F.col("bits").bitwiseAND(bit) == 0, F.lit(True))).select("doc.*")

        return part(0) if groups == 1 else gathered((part(g) for g in range(groups)), "left")


def of_hot_keys(rows: DataFrame, table: DataFrame, key: str, least: int) -> DataFrame:
    """rows joined to the one row of `table` for their key. `table` has n, the rows of a key: keys of `least` rows
    or more, of which there are (all rows) / least at most, meet a broadcast, so that no task gathers one. The others grow
    with the table and meet a merge, whatever the size of its files."""
    hot = F.broadcast(table.where(F.col("n") >= least))
    cold = rows.join(F.broadcast(table.where(F.col("n") >= least).select(key)), key, "left_anti")
    return rows.join(hot, key).unionByName(cold.join(table.where(F.col("n") < least).hint("merge"), key))
