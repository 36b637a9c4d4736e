"""Exact top-k inner products with multi-resolution segment statistics.

Vectors become integers, floor(SCALE * x). A vector cut into segments has a mean and a deviation in each; the
segments' means multiply exactly, and deviations bound the rest (Cauchy-Schwarz), which bounds the inner
product from above and, with the norms, the distance from below.

Vectors are dealt to cells of like ones (nearest of PIVOTS centres at most, fitted on a bounded sample) and
packed into blocks of one cell; a large cell has many blocks. Blocks of candidates are joined into stripes of
bounded size, and a task holds one stripe and streams the blocks of queries past it, so queries are copied
once for each stripe, not for each block. For each query the blocks come in order of the bound that their
segments' extremes give; a query skips the blocks whose bound is below its k-th score so far. In a block the
pairs of a query and a candidate whose bound is below that score fall, from coarse to fine, and the rest gets
exact scores; the k-th score rises as blocks pass. It begins with the query's exact scores in the sample, the
same for all. Where the first queries of a block see most pairs survive all resolutions, the block's other
queries go to exact scores at once, which changes the cost and not the result.

Queries are the rows whose id is divisible by QUERY_EVERY; candidates all rows but the query's own id.
Ties go to the smaller id. Vectors that are null, or hold null or non-finite components, take no part, nor
do null ids; vectors of different lengths meet as if the shorter ended in zeros; scores beyond a long are
cut to its range; rows that repeat an id are candidates each, and as queries are ranked together; an empty
table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cuefold.llm.batches import map_batches
from cuefold.llm.storage import written

K = 20
SCALE = 64
QUERY_EVERY = 20
QUERY_BLOCK = 2048
CANDIDATE_BLOCK = 8192
#: Rows of a stripe at most: with 64 components of one byte, 32 MB.
STRIPE_ROWS = 1 << 19
SAMPLE = 2048
PIVOTS = 256
RESOLUTIONS = (1, 4, 16, 32)
#: Queries that go through a block together, and the share of surviving pairs above which bounds don't pay.
GROUP = 64
PAYS = 0.5
#: Products of integers below this in size are exact in float64 for up to 2**13 components.
EXACT = 1 << 20

VECTOR = "vec_id long, cell int, kind string, v binary"
BLOCK = "block int, kind string, ids binary, rows binary"


def quantised(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """vec_id and v, as doubles, of the vectors that take part."""
    v = vectors[vector_col].cast("array<double>")
    rows = vectors.select(vectors[id_col].cast("long").alias("vec_id"), v.alias("v")).where(F.col("vec_id").isNotNull() & F.col("v").isNotNull())
    return rows.where(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))))


def _matrix(lists: pa.ListArray) -> np.ndarray:
    """Rows of integers; shorter ones end in zeros."""
    lengths = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(lengths), int(lengths.max(initial=0))))
    out[np.arange(out.shape[1])[None, :] < lengths[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
    return np.floor(out * SCALE)


def _narrow(m: np.ndarray) -> str:
    """The narrowest kind of number that holds all components."""
    most = np.abs(m).max(initial=0)
    return next((k for k, bits in (("<i1", 7), ("<i2", 15), ("<i4", 31)) if most < 1 << bits), "<f8")


def _block(kind: str, ids: bytes, rows: bytes) -> tuple[np.ndarray, np.ndarray]:
    own, found = np.frombuffer(ids, np.int64), np.frombuffer(rows, kind)
    return own, found.reshape(len(own), len(found) // max(1, len(own)))


def _pad(m: np.ndarray, width: int) -> np.ndarray:
    return m if m.shape[1] == width else np.pad(m, ((0, 0), (0, width - m.shape[1])))


def centres(sample: np.ndarray, n: int, rounds: int = 4) -> np.ndarray:
    """n centres of a bounded sample: each next one is the row farthest from those before, then rounds of means."""
    n = min(n, len(sample))
    if n < 2:
        return np.zeros((1, sample.shape[1]))
    found, far = [0], ((sample - sample[0]) ** 2).sum(1)
    while len(found) < n:
        found.append(int(np.argmax(far)))
        far = np.minimum(far, ((sample - sample[found[-1]]) ** 2).sum(1))
    out = sample[found].astype(float)
    for _ in range(rounds):
        own = _nearest(sample, out)
        for i in np.unique(own):
            out[i] = sample[own == i].mean(0)
    return out


def _nearest(m: np.ndarray, points: np.ndarray) -> np.ndarray:
    width = max(m.shape[1], points.shape[1])
    m, points = _pad(m, width), _pad(points, width)
    return np.argmax(m @ points.T - (points * points).sum(1) / 2, axis=1).astype(np.int32)


def stored(vectors: DataFrame, points: np.ndarray) -> DataFrame:
    """vec_id, cell, kind, v (numbers of that kind) of every vector, written once."""

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = _matrix(batch.column(1))
            kind = _narrow(m)
            raw = m.astype(kind)
            rows = pa.array([r.tobytes() for r in raw], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(_nearest(m, points)), pa.array([kind] * len(m), pa.string()), rows], ["vec_id", "cell", "kind", "v"])

    return written(map_batches(vectors.select("vec_id", "v"), packed, VECTOR), "vectors")


def blocks(vectors: DataFrame, size: int) -> tuple[DataFrame, int]:
    """Blocks of about `size` vectors of one cell: block, kind, ids and rows, ids ascending; and their number. Blocks of like cells follow each other."""
    counts = {r.cell: r.n for r in vectors.groupBy("cell").agg(F.count("*").alias("n")).collect()}  # PIVOTS rows at most
    parts = [max(1, -(-counts.get(c, 0) // size)) if c in counts else 0 for c in range(max(counts, default=-1) + 1)]
    before = np.cumsum([0, *parts])
    if not counts:
        return vectors.sparkSession.createDataFrame([], BLOCK), 0
    of = lambda values: F.element_at(F.array(*[F.lit(int(x)) for x in values]), F.col("cell") + 1)
    dealt = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.greatest(of(parts), F.lit(1)))  # rows of one id or vector part too

    def packed(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("vec_id", kind="stable")
        own = [np.frombuffer(v, k) for v, k in zip(rows["v"], rows["kind"], strict=True)]
        m = np.zeros((len(own), max(map(len, own))))
        for i, x in enumerate(own):
            m[i, : len(x)] = x
        kind = _narrow(m)
        return pd.DataFrame({"block": [key[0]], "kind": [kind], "ids": [rows["vec_id"].to_numpy(np.int64).tobytes()], "rows": [m.astype(kind).tobytes()]})

    keyed = vectors.select("vec_id", "kind", "v", (of(before[:-1]) + dealt).cast("int").alias("block"))
    return written(keyed.groupBy("block").applyInPandas(packed, BLOCK), "blocks"), int(before[-1])


class Resolutions:
    """Segment means and deviations of vectors at each resolution, as rows whose products bound."""

    def __init__(self, m: np.ndarray):
        self.levels: list[np.ndarray] = []
        width = m.shape[1]
        for n in RESOLUTIONS:
            if n >= width:
                break
            cuts = np.linspace(0, width, n + 1).astype(int)
            sizes = np.diff(cuts)
            means = np.add.reduceat(m, cuts[:-1], axis=1) / sizes
            squares = np.add.reduceat(m * m, cuts[:-1], axis=1) / sizes
            spread = np.sqrt(np.maximum(squares - means * means, 0))
            self.levels.append(np.hstack([means * np.sqrt(sizes), spread * np.sqrt(sizes)]))
        self.norms = np.sqrt((m * m).sum(1))


class Block:
    """Candidates, their statistics, and the extremes of these."""

    def __init__(self, c: np.ndarray, ids: np.ndarray, width: int):
        self.c, self.ids = _pad(c.astype(np.float64), width), ids
        self.of = Resolutions(self.c)
        self.reach = self.of.norms.max(initial=0)

    def extremes(self) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest of each column of the finest level."""
        finest = self.of.levels[-1]
        return finest.min(0), finest.max(0)


def block_bounds(of_q: Resolutions, lows: np.ndarray, highs: np.ndarray, reach: float) -> np.ndarray:
    """For each query a score that none of a block's candidates exceeds."""
    a = of_q.levels[-1]
    return np.maximum(a, 0) @ highs + np.minimum(a, 0) @ lows + _slack(of_q, reach)


def _slack(of_q: Resolutions, reach: float) -> float:
    """Of rounding in the bounds."""
    return 1e-9 * (1 + of_q.norms.max(initial=0) * reach)


def _exact(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Integer inner products, cut to the range of a long."""
    if max(np.abs(q).max(initial=0), np.abs(c).max(initial=0)) < EXACT and q.shape[1] <= 1 << 13:
        return (q @ c.T).astype(np.int64)
    whole = np.vectorize(int, otypes=[object])
    products = whole(q).dot(whole(c).T) if q.shape[1] else np.zeros((len(q), len(c)), object)
    return np.clip(products, -(1 << 63), (1 << 63) - 1).astype(np.int64)


def survivors(of_q: Resolutions, rows: np.ndarray, block: Block, floors: np.ndarray, counts: list[int] | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the queries `rows`: those with live pairs, the candidates of live pairs, and which pairs of both live.
    `counts` gets the number of pairs that each resolution leaves."""
    rows, columns = np.asarray(rows), np.arange(len(block.ids))
    live = np.ones((len(rows), len(columns)), bool)
    slack = _slack(of_q, block.reach)
    for a, b in zip(of_q.levels, block.of.levels, strict=True):
        live &= a[rows] @ b[columns].T + slack >= floors[rows][:, None]
        if counts is not None:
            counts.append(int(live.sum()))
        keep_rows, keep = live.any(1), live.any(0)
        if not (keep_rows.all() and keep.all()):
            rows, columns, live = rows[keep_rows], columns[keep], live[keep_rows][:, keep]
    return rows, columns, live


class Best:
    """The k best so far of each query of a block, and the k-th scores, below which nothing can enter."""

    def __init__(self, q: np.ndarray, ids: np.ndarray, floors: np.ndarray, k: int):
        self.q, self.ids, self.floors, self.k = q.astype(np.float64), ids, floors.copy(), k
        self.of = Resolutions(self.q)
        self.found = [np.zeros(0, np.int64)] * 3

    def meet(self, block: Block, rows: np.ndarray) -> None:
        """Scores the pairs of the queries `rows` with the block that can matter."""
        bounded = bool(self.of.levels)
        new = []
        for at in range(0, len(rows), GROUP):
            some = rows[at : at + GROUP]
            columns, live = np.arange(len(block.ids)), None
            if bounded and np.isfinite(self.floors[some]).all():
                pairs = len(some) * len(columns)
                some, columns, live = survivors(self.of, some, block, self.floors)
                bounded = live.sum() <= PAYS * pairs
            if not len(columns):
                continue
            if live is not None and live.sum() < live.size / 8:
                parts = [(i, columns[live[n]]) for n, i in enumerate(some)]
                new += [self._entering(np.array([i]), own, _exact(self.q[i : i + 1], block.c[own]), block) for i, own in parts]
            else:
                new.append(self._entering(some, columns, _exact(self.q[some], block.c[columns]), block))
        if new:
            self._merge([np.concatenate(x) for x in zip(*new, strict=True)])

    def _entering(self, rows: np.ndarray, columns: np.ndarray, scores: np.ndarray, block: Block) -> tuple[np.ndarray, ...]:
        """(query, vec_id, score) of the pairs that reach the floor; of each query the k best, ties by order of ids."""
        enough = (scores >= self.floors[rows][:, None]) & (self.ids[rows][:, None] != block.ids[columns][None, :])
        out = []
        for n, i in enumerate(rows):
            at = np.flatnonzero(enough[n])
            if len(at) > self.k:
                s = scores[n, at]
                at = at[s >= np.partition(s, len(s) - self.k)[len(s) - self.k]]
                at = at[np.argsort(-scores[n, at], kind="stable")[: self.k]]  # ids of a block ascend
            out.append((np.full(len(at), i), block.ids[columns[at]], scores[n, at]))
        return tuple(np.concatenate(x).astype(np.int64) for x in zip(*out, strict=True))

    def _merge(self, new: list[np.ndarray]) -> None:
        row, vec, score = (np.concatenate(x) for x in zip(self.found, new, strict=True))
        order = np.lexsort((vec, ~score, row))  # ~score descends and does not overflow
        row, vec, score = row[order], vec[order], score[order]
        first = np.searchsorted(row, row, "left")
        kept = np.arange(len(row)) - first < self.k
        self.found = [x[kept] for x in (row, vec, score)]
        row, score = self.found[0], self.found[2]
        last = np.flatnonzero(np.arange(len(row)) - np.searchsorted(row, row, "left") == self.k - 1)
        reached = score[last].astype(np.float64)
        reached = np.where(np.abs(reached) < 1 << 53, reached, np.nextafter(reached, -np.inf))
        self.floors[row[last]] = np.maximum(self.floors[row[last]], reached)


def top_of_stripe(best: Best, stripe: list[tuple], width: int) -> None:
    """Meets the blocks (kind, ids, rows, lows, highs, reach) of a stripe, most promising first."""
    if not best.of.levels:
        for kind, ids, rows, *_ in stripe:
            own, c = _block(kind, ids, rows)
            best.meet(Block(c, own, width), np.arange(len(best.q)))
        return
    bounds = np.array([block_bounds(best.of, *b[3:]) for b in stripe])
    for i in np.argsort(-bounds.max(1), kind="stable"):
        rows = np.flatnonzero(bounds[i] >= best.floors)
        if len(rows):
            own, c = _block(*stripe[i][:3])
            best.meet(Block(c, own, width), rows)


def top_k(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = K, every: int = QUERY_EVERY,
    query_block: int = QUERY_BLOCK, candidate_block: int = CANDIDATE_BLOCK, sample: int = SAMPLE, stripe_rows: int = STRIPE_ROWS,
) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k best candidates."""
    rows = quantised(vectors, id_col, vector_col)
    spark = rows.sparkSession
    total, width = rows.agg(F.count("*"), F.coalesce(F.max(F.size("v")), F.lit(0))).first()
    near = rows.withColumn("h", F.xxhash64("vec_id")).orderBy("h", "vec_id").limit(sample).select("vec_id", "v").collect()  # bounded: floors and centres only
    known = pa.array([r.v for r in near], pa.list_(pa.float64()))
    seen, seen_ids = _pad(_matrix(known), width), np.array([r.vec_id for r in near], np.int64)
    ascending = np.argsort(seen_ids, kind="stable")
    seen, seen_ids = seen[ascending].astype(_narrow(seen)), seen_ids[ascending]
    points = centres(seen.astype(np.float64), max(1, min(PIVOTS, total // candidate_block)))
    everything = stored(rows, points)
    candidates, n_blocks = blocks(everything, candidate_block)
    queries, n_asked = blocks(everything.where(F.pmod(F.col("vec_id"), F.lit(every)) == 0), query_block)

    def floors(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        block = Block(seen, seen_ids, width)
        for part in parts:
            for r in part.itertuples(index=False):
                ids, q = _block(r.kind, r.ids, r.rows)
                best = Best(_pad(q, width), ids, np.full(len(ids), -np.inf), k)
                best.meet(block, np.arange(len(ids)))
                yield pd.DataFrame({"block": [r.block], "kind": [r.kind], "ids": [r.ids], "rows": [r.rows], "floors": [best.floors.tobytes()]})

    per_stripe = max(1, stripe_rows // candidate_block)
    n_stripes = max(1, -(-n_blocks // per_stripe))
    # few stripes are met by several slices of the queries, so that all cores have work
    n_slices = max(1, min(n_asked, -(-2 * spark.sparkContext.defaultParallelism // n_stripes)))
    unit = lambda stripe, slice_: (stripe * n_slices + slice_).cast("int").alias("unit")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    nothing = F.lit(None).cast("binary")
    held = candidates.withColumn("slice", each(n_slices)).select(
        unit(F.floor(F.col("block") / per_stripe), F.col("slice")), F.lit(False).alias("asks"), "block", "kind", "ids", "rows", nothing.alias("floors")
    )
    asked = written(queries.mapInPandas(floors, BLOCK + ", floors binary"), "floors").withColumn("stripe", each(n_stripes))
    asked = asked.select(unit(F.col("stripe"), F.col("block") % n_slices), F.lit(True).alias("asks"), "block", "kind", "ids", "rows", "floors")

    def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, stripe = None, []
        for batch in batches:
            for r in batch.to_pylist():
                if r["unit"] != at:
                    at, stripe = r["unit"], []
                if not r["asks"]:
                    ids, c = _block(r["kind"], r["ids"], r["rows"])
                    block = Block(c, ids, width)
                    ends = block.extremes() if block.of.levels else (None, None)
                    stripe.append((r["kind"], r["ids"], r["rows"], *ends, block.reach))
                    continue
                ids, q = _block(r["kind"], r["ids"], r["rows"])
                best = Best(_pad(q, width), ids, np.frombuffer(r["floors"], np.float64), k)
                top_of_stripe(best, stripe, width)
                row, vec, score = best.found
                yield pa.RecordBatch.from_arrays([pa.array(ids[row]), pa.array(vec), pa.array(score)], ["query_id", "vec_id", "score"])

    dealt = held.unionByName(asked).repartition(n_stripes * n_slices, "unit").sortWithinPartitions("unit", "asks", "block")
    pairs = map_batches(dealt, met, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")  # k rows of each stripe at most
    return pairs.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def oracle(k: int = K, every: int = QUERY_EVERY) -> str:
    """The same in DuckDB, for vectors of one length."""
    return f"""
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % {every} = 0),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= {k}"""
