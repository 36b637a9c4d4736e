"""Periodic runs of words by harmonic grid probing.

A run is a stretch of words with smallest period p, of max(LEAST, 2 p) words at least, that no neighbour extends.
A stretch of 2 p words holds two neighbouring points j p and (j + 1) p of the grid of p, so for each period only
the words at these points are compared, which is n ln n comparisons for all periods of n words. Points that agree
and have some agreeing neighbours at the same distance are extended to both sides by comparing chunks. Periods come
in ascending order: points inside of a run whose period divides p belong to that run and are skipped, so that what
is left has p as its smallest period.

Words are runs of characters other than \\x20 and \\x09-\\x0D, numbered from 0. A null text has no words, as an empty
one has; both give no runs and an empty text. Rows that repeat an id are looked at each; an empty table gives an
empty one. A document is one row and is never cut; memory is bounded by its words.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import compress, count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, _parse_datatype_string

from cuefold.functions.arrays import let
from cuefold.llm.batches import map_batches

#: Words of a run at least.
LEAST = 12
#: Words up to which the grid points of all periods are tabulated and compared at once; longer texts go period by period.
TABLED = 1 << 16
#: Agreeing neighbours that are looked for at all points at once, before single points are extended.
NEAR = 8
CHUNK = 256

RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"

_grid: tuple[np.ndarray, np.ndarray] = (np.empty(0, np.int32), np.empty(0, np.int32))


def grid(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Points and their periods, (k p, p) for all p and k > 0, that lie below n, in order of the points."""
    global _grid
    if not len(_grid[0]) or _grid[0][-1] < n - 1:
        to = min(TABLED, max(4096, 1 << (n - 1).bit_length()))
        points = np.concatenate([np.arange(p, to, p, dtype=np.int32) for p in range(1, to)])
        periods = np.repeat(np.arange(1, to, dtype=np.int32), [(to - 1) // p for p in range(1, to)])
        order = np.argsort(points, kind="stable")
        _grid = points[order], periods[order]
    below = np.searchsorted(_grid[0], n)
    return _grid[0][:below], _grid[1][:below]


def _neighbours(codes: np.ndarray, points: np.ndarray, periods: np.ndarray) -> np.ndarray:
    """How many words in a row, with the point itself, equal the word a period before: NEAR to each side at most."""
    n = np.ones(len(points), np.int32)
    for side in (-1, 1):
        live, at, p = np.arange(len(points)), points, periods
        for _ in range(NEAR):
            at = at + side
            inside = (at >= p) & (at < len(codes))
            live, at, p = live[inside], at[inside], p[inside]
            same = codes[at] == codes[at - p]
            live, at, p = live[same], at[same], p[same]
            if not len(live):
                break
            n[live] += 1
    return n


def _survivors(codes: np.ndarray, points: np.ndarray, periods: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """The points that may lie in a run of their period: it has max(least - p, p) agreeing words in a row."""
    enough = _neighbours(codes, points, periods) >= np.minimum(NEAR, np.maximum(least - periods, periods))
    return points[enough], periods[enough]


def _probed(codes: np.ndarray, least: int) -> Iterator[tuple[int, np.ndarray]]:
    """Periods in ascending order with the grid points that agree, in order."""
    n = len(codes)
    if n > TABLED:
        for p in range(1, n // 2 + 1):
            points = p * (1 + np.flatnonzero(codes[p::p] == codes[: n - p : p]))
            if len(points):
                points, _ = _survivors(codes, points, np.full(len(points), p), least)
            if len(points):
                yield p, points
        return
    points, periods = grid(n)
    agree = np.flatnonzero(codes[points] == codes[points - periods])
    points, periods = points[agree], periods[agree]
    short = 2 * periods <= n
    points, periods = _survivors(codes, points[short], periods[short], least)
    order = np.lexsort((points, periods))
    points, periods = points[order], periods[order]
    cuts = np.flatnonzero(np.diff(periods)) + 1
    for own, p in zip(np.split(points, cuts), periods[np.concatenate([[0], cuts])] if len(periods) else [], strict=False):
        yield int(p), own


def _stretch(codes: np.ndarray, point: int, p: int) -> tuple[int, int]:
    """Start and end of the longest stretch around a point whose words equal those p before."""
    n, end, size = len(codes), point + 1, CHUNK
    while end < n:
        to = min(n, end + size)
        differ = codes[end:to] != codes[end - p : to - p]
        k = int(differ.argmax())
        if differ[k]:
            end += k
            break
        end, size = to, size * 2
    start, size = point, CHUNK
    while start > p:
        to = max(p, start - size)
        differ = codes[to:start] != codes[to - p : start - p]
        k = int(differ[::-1].argmax())
        if differ[len(differ) - 1 - k]:
            start -= k
            break
        start, size = to, size * 2
    return start - p, end


def find_runs(codes: np.ndarray, least: int = LEAST) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of a sequence of word numbers, by start, then period."""
    found: list[tuple[int, int, int]] = []
    known: dict[int, list[tuple[int, int]]] = {}  # by period, in order; two runs of a period overlap in less than a period
    for p, points in _probed(codes, least):
        for q, runs in known.items():
            if p % q == 0:
                starts, ends = np.array([r[0] for r in runs]), np.array([r[1] for r in runs])
                held = np.searchsorted(starts, points - p, "right") - 1
                points = points[(held < 0) | (points >= ends[held])]
        at = 0
        while at < len(points):
            start, end = _stretch(codes, int(points[at]), p)
            if end - start >= max(least, 2 * p):
                found.append((start, end - start, p))
                known.setdefault(p, []).append((start, end))
            at = int(np.searchsorted(points, end))
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapse(text: bytes | None, least: int = LEAST) -> tuple[list[tuple[int, int, int]], bytes]:
    """The runs of a text, and its words, a space between them, without those that any run holds after its first period."""
    words = (text or b"").split()
    if len(words) < least:
        return [], b" ".join(words)
    numbers: defaultdict[bytes, int] = defaultdict(count().__next__)
    runs = find_runs(np.fromiter(map(numbers.__getitem__, words), np.int32, len(words)), least)
    if not runs:
        return runs, b" ".join(words)
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return runs, b" ".join(compress(words, (change[:-1].cumsum() == 0).tolist()))


def collapse_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST) -> DataFrame:
    """doc_id, runs (start, length, period of each, by start, then period) and collapsed, the text without repetitions."""
    slim = docs.select(docs[id_col].alias("doc_id"), docs[text_col].cast("string").cast("binary").alias("text"))
    schema = StructType([slim.schema["doc_id"], StructField("runs", _parse_datatype_string(RUNS)), StructField("collapsed", _parse_datatype_string("string"))])
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def collapsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [collapse(text, least) for text in batch.column(1).to_pylist()]
            runs = pa.array([[dict(zip(("start", "length", "period"), r, strict=True)) for r in f[0]] for f in found], kind)
            yield pa.RecordBatch.from_arrays([batch.column(0), runs, pa.array([f[1] for f in found], pa.binary()).cast(pa.string())], schema.names)

    return map_batches(slim, collapsed, schema)


def planted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and text: of about a tenth of the documents, by the id's checksum h, the words from number a on repeat the
    p words that begin there. A null id is no tenth document."""
    h = F.crc32(docs[id_col].cast("string").cast("binary"))
    g = F.expr("h div 10")
    slim = docs.select(docs[id_col].alias("doc_id"), docs[text_col].cast("string").alias("text"), h.alias("h"))

    def repeated(words: Column) -> Column:
        n = F.size(words).cast("long")
        place = F.struct((g % n).alias("a"), F.expr("h div 10 % 8 + 3").alias("times"), n.alias("n"))
        tail = let(place, lambda x: F.struct(x["a"].alias("a"), (F.lit(1) + F.floor((x["n"] - x["a"]) / x["times"])).alias("p"), x["n"].alias("n")))
        number = lambda i, x: F.when(i < x["a"], i).otherwise(x["a"] + F.pmod(i - x["a"], x["p"]))
        spoken = let(tail, lambda x: F.array_join(F.transform(F.sequence(F.lit(0).cast("long"), x["n"] - 1), lambda i: F.get(words, number(i, x).cast("int"))), " "))
        return F.when(n > 0, spoken).otherwise(F.lit(""))

    words = F.filter(F.split("text", "[ \t-\r]+"), lambda w: w != "")
    return slim.select("doc_id", F.when((F.col("h") % 10 == 0) & F.col("text").isNotNull(), let(words, repeated)).otherwise(F.col("text")).alias("text"))


def run_digests(collapsed: DataFrame) -> DataFrame:
    """doc_id, n_runs, the run of greatest length with its exponent in thousandths, and digests of all runs and of the collapsed text."""
    best = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period"))))
    listed = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")])), "\n")
    rows = collapsed.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), F.when(F.size("runs") > 0, F.concat(listed, F.lit("\n"))).otherwise("").alias("listed"), "collapsed")
    return rows.select(
        "doc_id", "n_runs", F.col("best.start").alias("start"), (-F.col("best.less")).alias("length"), F.col("best.period").alias("period"),
        F.expr("-1000 * best.less div best.period").alias("exponent_milli"), F.sha2("listed", 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def oracle(least: int = LEAST) -> str:
    """The digests in DuckDB, for ids that don't repeat: all pairs of equal words of a document, and stretches of pairs of one distance."""
    checksum = "xor(list_reduce(list_concat([4294967295], list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295)"
    return f"""
WITH crc AS (SELECT list_transform(range(256), lambda n: list_reduce(list_concat([n], range(8)), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
h AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w, {checksum} AS h FROM documents, crc),
a AS (SELECT doc_id, w, len(w) AS n, h // 10 AS g, CASE WHEN h % 10 = 0 AND len(w) > 0 THEN h // 10 % len(w) END AS a FROM h),
x AS (SELECT doc_id, n, CASE WHEN a IS NULL THEN w ELSE list_transform(range(n), lambda i: CASE WHEN i < a THEN w[i + 1] ELSE w[a + (i - a) % (1 + (n - a) // (3 + g % 8)) + 1] END) END AS w FROM a),
t AS (SELECT doc_id, n, unnest(w) AS word, unnest(range(n)) AS i FROM x),
e AS (SELECT r.doc_id, r.i, r.i - l.i AS p FROM t r JOIN t l ON l.doc_id = r.doc_id AND l.word = r.word AND l.i < r.i WHERE 2 * (r.i - l.i) <= r.n),
s AS (SELECT doc_id, p, i, i - row_number() OVER (PARTITION BY doc_id, p ORDER BY i) AS island FROM e),
stretches AS (SELECT doc_id, p, min(i) - p AS s, count(*) + p AS size FROM s GROUP BY doc_id, p, island HAVING count(*) + p >= greatest({least}, 2 * p)),
runs AS (SELECT * FROM stretches o WHERE NOT EXISTS (SELECT 1 FROM stretches q WHERE q.doc_id = o.doc_id AND q.p < o.p AND o.p % q.p = 0 AND q.s <= o.s AND q.s + q.size >= o.s + o.size)),
listed AS (SELECT doc_id, count(*) AS n_runs, string_agg(s || ',' || size || ',' || p || chr(10), '' ORDER BY s, p) AS runs, min({{'less': -size, 's': s, 'p': p}}) AS best FROM runs GROUP BY doc_id),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text FROM t WHERE NOT EXISTS (SELECT 1 FROM runs r WHERE r.doc_id = t.doc_id AND t.i >= r.s + r.p AND t.i < r.s + r.size) GROUP BY doc_id)
SELECT x.doc_id, coalesce(n_runs, 0) AS n_runs, CAST(best.s AS BIGINT) AS start, CAST(-best.less AS BIGINT) AS length, CAST(best.p AS BIGINT) AS period, CAST(1000 * -best.less // best.p AS BIGINT) AS exponent_milli,
  sha256(coalesce(runs, '')) AS runs_sha256, sha256(coalesce(kept.text, '')) AS collapsed_sha256
FROM x LEFT JOIN listed USING (doc_id) LEFT JOIN kept USING (doc_id)"""
