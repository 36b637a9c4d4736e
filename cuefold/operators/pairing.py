"""Joins by identity: audio with subtitles, new with done, reviewed with local, and their reports."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType, StructField, StructType

from cuefold.batches import bounded
from cuefold.columns import free
from cuefold.functions import ids
from cuefold.functions import text as T
from cuefold.operators.numbering import numbered, scanned
from cuefold.storage import gathered, written

#: Characters of the terms that a worker holds at once.
MAX_TERM_CHARS = 20_000_000


def identified(files: DataFrame, extensions: tuple[str, ...], path_col: str = "path") -> DataFrame:
    """yt_id and path of the files with one of the extensions; of equal ids the last path stays."""
    own = files.select(path_col, ids.youtube_id(F.col(path_col)).alias("yt_id")).where(ids.suffix(F.col(path_col)).isin(*extensions) & F.col("yt_id").isNotNull())
    return own.groupBy("yt_id").agg(F.max(path_col).alias(path_col))


def pairs(audio: DataFrame, subtitles: DataFrame) -> DataFrame:
    """pair_index (from 1, in natural order of the audio's name), yt_id, audio, subtitle."""
    both = audio.select("yt_id", F.col("path").alias("audio")).join(subtitles.select("yt_id", F.col("path").alias("subtitle")), "yt_id")
    return numbered(both, [ids.natural_key(F.col("audio")), F.col("audio")], "pair_index").select("pair_index", "yt_id", "audio", "subtitle")


def orphans(audio: DataFrame, subtitles: DataFrame) -> DataFrame:
    """yt_id, missing, path: what has no partner."""
    alone = lambda a, b, lacks: a.join(b, "yt_id", "left_anti").select("yt_id", F.lit(lacks).alias("missing"), "path")
    return alone(audio, subtitles, "subtitle").unionByName(alone(subtitles, audio, "audio"))


def unseen(found: DataFrame, done: DataFrame, key: str = "video_id") -> DataFrame:
    """Rows whose key is not done yet."""
    return found.join(done.select(key).distinct(), key, "left_anti")


def append_new(done: DataFrame, found: DataFrame, key: str = "video_id") -> DataFrame:
    """done and the rows of found with new keys."""
    return done.unionByName(unseen(found, done, key).select(done.columns))


KEY = ["episode", "yt_id", "chunk_index"]


def local_lookup(manifests: DataFrame, path_col: str = "audio_path") -> DataFrame:
    """manifests (folder, pos, audio_path, live) with the key in the path; of one manifest the last row of a key stays."""
    folder = ids.parent(F.col(path_col))
    rows = manifests.where(folder.rlike(ids.FOLDER)).select(
        "*", F.regexp_extract(folder, ids.FOLDER, 1).alias("episode"), F.regexp_extract(folder, ids.FOLDER, 2).alias("yt_id"), ids.chunk_index(F.col(path_col)).alias("chunk_index")
    )
    best = F.max_by(F.struct(*manifests.columns), F.col("pos")).alias("row")
    return rows.groupBy(*KEY, F.col("folder").alias("_folder")).agg(best).select(*KEY, "row.*")


def merge_lookups(lookups: DataFrame, key: list[str] = KEY) -> DataFrame:
    """One row for each key: the first folder's live row, else the first folder's."""
    best = F.min_by(F.struct(*[c for c in lookups.columns if c not in key]), F.struct((~F.col("live")).alias("dead"), "folder"))
    return lookups.groupBy(*key).agg(best.alias("row")).select(*key, "row.*")


def join_back(reviewed: DataFrame, lookup: DataFrame, root: Column, key: list[str] = KEY) -> DataFrame:
    """reviewed with its local path, else the path that its key spells, and whether it matched. No row goes."""
    free(reviewed, "matched", "audio_path", "_local")
    local = lookup.select(*key, F.col("audio_path").alias("_local"))
    rows = reviewed.join(local, key, "left")
    spelled = ids.audio_path(root, F.col("episode"), F.col("yt_id"), F.col("chunk_index"))
    return rows.withColumn("matched", F.col("_local").isNotNull()).withColumn("audio_path", F.coalesce("_local", spelled)).drop("_local")


def coverage(joined: DataFrame) -> DataFrame:
    """episode (null: all), matched, total, missing; in_order sorts it."""
    sums = joined.rollup("episode").agg(F.count_if("matched").alias("matched"), F.count("*").alias("total"))
    return sums.withColumn("missing", F.col("total") - F.col("matched"))


def in_order(report: DataFrame) -> DataFrame:
    """A report by episode in order of episode numbers, then of names; the row for all last. It has a row for each episode."""
    return report.orderBy(F.col("episode").isNull(), ids.episode_number(F.col("episode")), "episode")


def coverage_summary(joined: DataFrame) -> DataFrame:
    """episodes, matched, total, missing over all, and share as text."""
    sums = joined.agg(F.count_distinct("episode").alias("episodes"), F.count_if("matched").alias("matched"), F.count("*").alias("total"))
    return sums.withColumn("missing", F.col("total") - F.col("matched")).withColumn("share", T.percent(F.col("matched"), F.col("total")))


def coverage_folders(reviewed: DataFrame, lookup: DataFrame, key: list[str] = KEY) -> DataFrame:
    """place, folder, matched: the folders that reviewed rows were found in, sorted and numbered from 1."""
    met = reviewed.select(*key).join(lookup.select(*key, "folder"), key)
    sums = met.groupBy("folder").agg(F.count("*").alias("matched"))  # a row for each folder
    return sums.select(F.row_number().over(Window.orderBy("folder")).alias("place"), "folder", "matched")


def gate(joined: DataFrame, allow_reconstruct: bool = False, forced_folder: bool = False) -> DataFrame:
    """joined, or an error where a row matched nothing and reconstruction is not both allowed and given a folder."""
    if not (allow_reconstruct and forced_folder) and not joined.where(~F.col("matched")).isEmpty():
        raise ValueError("reviewed rows without a local match: " + str(joined.where(~F.col("matched")).select(*KEY).take(5)))
    return joined


def jaccard(a: DataFrame, b: DataFrame, key: list[str]) -> DataFrame:
    """both, either, jaccard of two key sets."""
    seen = a.select(*key).distinct().withColumn("_a", F.lit(1)).unionByName(b.select(*key).distinct().withColumn("_b", F.lit(1)), allowMissingColumns=True)
    sums = seen.groupBy(*key).agg(F.max("_a").alias("a"), F.max("_b").alias("b")).agg(F.count_if(F.col("a").isNotNull() & F.col("b").isNotNull()).alias("both"), F.count("*").alias("either"))
    return sums.withColumn("jaccard", F.when(F.col("either") > 0, F.col("both") / F.col("either")))


def exclude(rows: DataFrame, listed: DataFrame, key: list[str]) -> DataFrame:
    return rows.join(listed.select(*key).distinct(), key, "left_anti")


def _automaton(terms: list[tuple]) -> tuple[object | None, list]:
    """An automaton whose matches give lists of ids, and the ids of empty terms."""
    import ahocorasick

    by_term: dict[str, list] = {}
    for term_id, term in terms:
        by_term.setdefault(term, []).append(term_id)
    empty = by_term.pop("", [])
    automaton = ahocorasick.Automaton()
    for term, found in by_term.items():
        automaton.add_word(term, (term, found))
    if by_term:
        automaton.make_automaton()
    return automaton if by_term else None, empty


def term_matches(docs: DataFrame, terms: DataFrame, doc_id: str, text_col: str, term_id: str, term_col: str, most: int = MAX_TERM_CHARS) -> DataFrame:
    """doc_id, term_id for every row of docs and of terms where the term is a substring of the text.

    The terms become an automaton that every worker holds, and each text is read once, where it lies. Where all rows of terms
    have more than `most` characters together, the distinct terms are numbered, dealt in order to automata of about `most`
    characters, one after the other, and the ids of their rows are joined to what matched. Null texts and
    terms match nothing, an empty term every text; rows that repeat match each."""
    t = terms.select(F.col(term_id).alias("_id"), F.col(term_col).cast("string").alias("_term")).where(F.col("_term").isNotNull())
    d = docs.select(F.col(doc_id).alias("_doc"), F.col(text_col).cast("string").alias("_text")).where(F.col("_text").isNotNull())
    size = F.length("_term") + 16
    if t.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0] <= most:
        return _found(d, [tuple(r) for r in t.collect()], doc_id, term_id, t.schema["_id"].dataType)
    numbers = scanned(t.select("_term").distinct(), [], [F.col("_term")], {"_number": ("sum", F.lit(1), True), "_before": ("sum", size, False)})
    numbers = written(numbers.withColumn("_part", (F.coalesce("_before", F.lit(0)) / most).cast("int")).select("_number", "_term", "_part"), "terms")
    parts = sorted(r[0] for r in numbers.select("_part").distinct().collect())  # a number for each automaton
    each = (_found(d, [tuple(r) for r in numbers.where(F.col("_part") == k).select("_number", "_term").collect()], "_doc", "_number", numbers.schema["_number"].dataType) for k in parts)
    ids_ = t.join(numbers, "_term").select("_number", "_id")
    return gathered(each, "matches").join(ids_, "_number").select(F.col("_doc").alias(doc_id), F.col("_id").alias(term_id))


def _found(d: DataFrame, known: list[tuple], doc_id: str, term_id: str, term_kind: DataType) -> DataFrame:
    """doc_id, term_id of texts (_doc, _text) that hold one of the known terms (id, term)."""
    kinds = StructType([StructField(doc_id, d.schema["_doc"].dataType), StructField(term_id, term_kind)])
    id_kind = to_arrow_type(term_kind)

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, empty = _automaton(known)
        for batch in batches:
            rows, matched = [], []
            for i, text in enumerate(batch.column(1).to_pylist()):
                held = {term: own_ids for _, (term, own_ids) in automaton.iter(text)} if automaton else {}
                for own_ids in (empty, *held.values()):
                    rows += [i] * len(own_ids)
                    matched += own_ids
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int64())), pa.array(matched, id_kind)], [doc_id, term_id])

    return bounded(d).mapInArrow(found, kinds)
