"""Embedding near-dedup: exact pairs above a cosine by dual traversal of cover trees.

Unit vectors with cosine c lie sqrt(2 - 2 c) apart, so links are pairs within a radius. The vectors of one label
(and one length) are dealt to cells and blocks; the block's points form a cover tree: nested levels whose radii
halve, where a node's centre is also a centre below, each with the radius that really covers its points. Two
trees are traversed together: a pair of nodes whose centres lie further apart than both radii and the limit is
pruned; one whose points all lie within the limit is counted whole, without looking at its pairs; others split
until single points remain. What lies within ROUNDING of the limit is decided by the cosine of the vectors as given.

Identical vectors of a label are one node with a weight, so copies never meet in pairs. Cells are the level of a
cover tree over a bounded sample (SAMPLE vectors) that has as many centres as blocks are worth it; every vector
goes to its nearest centre, and pairs of cells are pruned by centres and covering radii too. A large cell has many
blocks, so a hot label is spread over all tasks: a task holds a stripe of blocks and streams the others past it.
A pair of blocks gives a number of links for each point and a forest that spans what is linked, never its pairs;
components come from the forests' edges by contraction.

Vectors that are null, empty or zero, or hold null or non-finite components, and rows whose label is null link with
nothing; neither do vectors of different lengths. Rows that repeat an id are vectors each; an id that is null is no
component's name unless all of its are null. An empty table gives an empty one. Blocks hold fewer of longer vectors, so
that a block is BLOCK_BYTES or one vector.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cuefold.llm.batches import map_batches
from cuefold.llm.rows import of_hot_keys
from cuefold.llm.simhash import components
from cuefold.llm.storage import written

COSINE = 0.98
#: Vectors of a sample that cells are fitted on, and its bytes.
SAMPLE, SAMPLE_BYTES = 4096, 64 << 20
#: Cells of one label at most.
CELLS = 256
#: Vectors of a block, and its bytes as doubles.
BLOCK_ROWS, BLOCK_BYTES = 1536, 4 << 20
#: Blocks that a task holds at most.
STRIPE = 16
LEAF = 8
#: Distances are known to within this; a cosine that is nearer to the limit is computed from the vectors as given.
ROUNDING = 1e-6
#: Edges that are held before they are reduced to a forest.
HELD = 1 << 20
HOT = 64
MAX_HOT = 20_000

BLOCK = ["label", "width", "cell", "parts", "part"]
BLOCK_SCHEMA = "label string, width int, cell int, parts int, part int"
TREE = "ids binary, weights binary, raw binary, begins binary, ends binary, centres binary, radii binary, children binary, counts binary"


def units(raw: np.ndarray) -> np.ndarray:
    """Rows of length 1; scaled first, so that no square leaves the doubles' range."""
    raw = raw.astype(np.float64)
    raw = raw / np.abs(raw).max(1, keepdims=True)
    return raw / np.sqrt((raw * raw).sum(1, keepdims=True))


def distances(cosines: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2 - 2 * cosines, 0))


def cover(gram: np.ndarray, radius: float) -> tuple[np.ndarray, np.ndarray]:
    """Centres, the first point first, more than radius apart, that cover all points; and the centre of each point."""
    near = gram >= 1 - radius * radius / 2
    of = np.full(len(gram), -1)
    centres = []
    for c in range(len(gram)):
        if of[c] < 0:
            own = near[c] & (of < 0)
            own[c] = True
            of[own] = len(centres)
            centres.append(c)
    return np.array(centres), of


class Tree:
    """A cover tree over a block's points; a node's points lie side by side, and so do a node's children."""

    def __init__(self, ids, weights, raw, begins, ends, centres, radii, children, counts):
        self.ids, self.weights, self.raw = ids, weights, raw
        self.begins, self.ends, self.centres, self.radii, self.children, self.counts = begins, ends, centres, radii, children, counts
        self.points = units(raw)
        self.norms = np.sqrt((raw.astype(np.float64) ** 2).sum(1))
        self.sums = np.concatenate([[0], np.cumsum(weights)])

    @classmethod
    def grown(cls, ids: np.ndarray, weights: np.ndarray, raw: np.ndarray) -> Tree:
        points = units(raw)
        gram = points @ points.T
        order, todo, k = np.arange(len(points)), [(0, len(points), 0, 2.0)], 0
        columns: list[list] = [[], [], [], [], [], []]  # begin, end, centre's place, radius, first child, children
        while k < len(todo):
            begin, end, centre, radius = todo[k]
            k += 1
            own = order[begin:end]
            covering = float(distances(gram[order[centre], own]).max())
            row = [begin, end, centre, covering, 0, 0]
            if end - begin > LEAF and covering > ROUNDING:
                first = np.concatenate([own[centre - begin : centre - begin + 1], np.delete(own, centre - begin)])  # nested: the centre is a centre below
                while True:
                    radius /= 2
                    chosen, of = cover(gram[np.ix_(first, first)], radius)
                    if len(chosen) > 1:
                        break
                by = np.argsort(of, kind="stable")
                order[begin:end] = first[by]
                cuts = begin + np.searchsorted(of[by], np.arange(len(chosen) + 1))
                row[4:] = [len(todo), len(chosen)]
                todo += [(int(cuts[i]), int(cuts[i + 1]), int(cuts[i]), radius) for i in range(len(chosen))]
                row[2] = begin
            for column, value in zip(columns, row, strict=True):
                column.append(value)
        begins, ends, centres, radii, children, counts = (np.array(c, np.float64 if i == 3 else np.int32) for i, c in enumerate(columns))
        return cls(ids[order], weights[order], raw[order], begins, ends, centres, radii, children, counts)

    def stored(self) -> dict[str, bytes]:
        return {k: np.ascontiguousarray(getattr(self, k)).tobytes() for k in ("ids", "weights", "raw", "begins", "ends", "centres", "radii", "children", "counts")}

    @classmethod
    def read(cls, row: dict, kind: str, width: int) -> Tree:
        of = lambda name, kind: np.frombuffer(row[name], kind)
        return cls(
            of("ids", np.int64), of("weights", np.int64), of("raw", kind).reshape(-1, width), *[of(c, np.int32) for c in ("begins", "ends", "centres")],
            of("radii", np.float64), of("children", np.int32), of("counts", np.int32),
        )

    def below(self, node: int) -> np.ndarray:
        return np.arange(self.children[node], self.children[node] + self.counts[node]) if self.counts[node] else np.array([node])


class Forest:
    """Points that are linked, as edges from the first of each component; reduced whenever many edges are held."""

    def __init__(self, n: int):
        self.root, self.held, self.n_held = np.arange(n), [], 0

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        self.held.append((a, b))
        self.n_held += len(a)
        if self.n_held > HELD:
            self.reduce()

    def reduce(self) -> np.ndarray:
        a, b = (np.concatenate([h[i] for h in self.held]) if self.held else np.empty(0, np.int64) for i in range(2))
        self.held, self.n_held = [], 0
        while len(a):
            a, b = self.root[a], self.root[b]
            differ = a != b
            a, b = np.minimum(a, b)[differ], np.maximum(a, b)[differ]
            np.minimum.at(self.root, b, a)
            while True:
                further = self.root[self.root]
                if (further == self.root).all():
                    break
                self.root = further
        return self.root


class Links:
    """The links of the points of two trees, or of one tree with itself."""

    def __init__(self, a: Tree, b: Tree, cosine: float = COSINE):
        self.a, self.b, self.own, self.cosine = a, b, a is b, cosine
        self.limit = float(distances(np.array(cosine)))
        self.of_a, self.of_b = np.zeros(len(a.ids), np.int64), np.zeros(len(b.ids), np.int64)
        self.forest = Forest(len(a.ids) + (0 if self.own else len(b.ids)))
        self.visits = 0
        self.shift = 0 if self.own else len(a.ids)
        self._traverse()

    def _linked(self, x: np.ndarray, y: np.ndarray, cosines: np.ndarray) -> np.ndarray:
        """Which pairs of points reach the limit, by the vectors as given where rounding might decide."""
        linked = cosines >= self.cosine
        close = np.flatnonzero(np.abs(cosines - self.cosine) < ROUNDING)
        for at in range(0, len(close), 4096):
            k = close[at : at + 4096]
            p, q = self.a.raw[x[k]].astype(np.float64), self.b.raw[y[k]].astype(np.float64)
            with np.errstate(all="ignore"):
                exact = (p * q).sum(1) / (self.a.norms[x[k]] * self.b.norms[y[k]])
            linked[k] = np.where(np.isfinite(exact), exact, cosines[k]) >= self.cosine
        return linked

    def _pairs(self, x: np.ndarray, y: np.ndarray, cosines: np.ndarray) -> None:
        linked = self._linked(x, y, cosines)
        x, y = x[linked], y[linked]
        if len(x):
            np.add.at(self.of_a, x, self.b.weights[y])
            np.add.at(self.of_a if self.own else self.of_b, y, self.a.weights[x])
            self.forest.link(x, y + self.shift)

    def _whole(self, i: int, j: int) -> None:
        """All points of two nodes are linked."""
        a, b = self.a, self.b
        of_a, of_b = slice(a.begins[i], a.ends[i]), slice(b.begins[j], b.ends[j])
        first_a, first_b = a.begins[i], b.begins[j] + self.shift
        self.of_a[of_a] += b.sums[b.ends[j]] - b.sums[b.begins[j]]
        if self.own and i == j:
            self.of_a[of_a] -= a.weights[of_a]
        else:
            (self.of_a if self.own else self.of_b)[of_b] += a.sums[a.ends[i]] - a.sums[a.begins[i]]
        x, y = np.arange(a.begins[i], a.ends[i]), np.arange(b.begins[j], b.ends[j]) + self.shift
        self.forest.link(x, np.full(len(x), first_b))
        self.forest.link(np.full(len(y), first_a), y)

    def _traverse(self) -> None:
        a, b, slack = self.a, self.b, 4 * ROUNDING
        apart = float(distances(a.points[a.centres[0]] @ b.points[b.centres[0]]))
        todo = [(0, 0)] if self.own or apart <= a.radii[0] + b.radii[0] + self.limit + slack else []
        while todo:
            i, j = todo.pop()
            self.visits += 1
            same = self.own and i == j
            if same and 2 * a.radii[i] < self.limit - slack:
                self._whole(i, j)
                continue
            if not a.counts[i] and not b.counts[j]:
                x, y = np.arange(a.begins[i], a.ends[i]), np.arange(b.begins[j], b.ends[j])
                cosines = a.points[x] @ b.points[y].T
                p, q = np.triu_indices(len(x), 1) if same else (g.ravel() for g in np.indices(cosines.shape))
                self._pairs(x[p], y[q], cosines[p, q])
                continue
            left, right = a.below(i), b.below(j)
            cosines = a.points[a.centres[left]] @ b.points[b.centres[right]].T
            apart = distances(cosines)
            reach = a.radii[left][:, None] + b.radii[right][None, :]
            near = apart <= reach + self.limit + slack
            if same:
                near = np.triu(near)  # a pair of children once
            p, q = np.nonzero(near)
            single = (a.ends[left[p]] - a.begins[left[p]] == 1) & (b.ends[right[q]] - b.begins[right[q]] == 1)
            if same:
                single &= p != q
                own_point = (p == q) & (a.ends[left[p]] - a.begins[left[p]] == 1)
                p, q, single = p[~own_point], q[~own_point], single[~own_point]
            self._pairs(a.begins[left[p[single]]], b.begins[right[q[single]]], cosines[p[single], q[single]])
            for x, y in zip(p[~single].tolist(), q[~single].tolist(), strict=True):
                if apart[x, y] + reach[x, y] < self.limit - slack and not (same and x == y):
                    self._whole(int(left[x]), int(right[y]))
                else:
                    todo.append((int(left[x]), int(right[y])))


def found(links: Links) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """a, b, n: the number of links of each point (b is -1), then the edges of the forest (n is 0)."""
    ids = links.a.ids if links.own else np.concatenate([links.a.ids, links.b.ids])
    n = links.of_a if links.own else np.concatenate([links.of_a, links.of_b])
    root = links.forest.reduce()
    met, edge = np.flatnonzero(n), np.flatnonzero(root != np.arange(len(root)))
    return np.concatenate([ids[met], ids[root[edge]]]), np.concatenate([np.full(len(met), -1), ids[edge]]), np.concatenate([n[met], np.zeros(len(edge), np.int64)])


def nodes_of(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> tuple[DataFrame, DataFrame]:
    """Rows (vec_id, key; key is null where a vector takes no part), and nodes (node, key, label, width, v, first, n): a row for each label and vector."""
    v = vectors[vector_col]
    if vectors.schema[vector_col].dataType.simpleString() != "array<float>":
        v = v.cast("array<double>")
    label = F.to_json(F.struct(vectors[label_col].alias("label")))
    sound = v.isNotNull() & vectors[label_col].isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    slim = vectors.select(vectors[id_col].alias("vec_id"), F.when(F.coalesce(sound, F.lit(False)), F.struct(label.alias("label"), v.alias("v"))).alias("x"))
    key = F.when(F.col("x").isNotNull(), F.struct(F.xxhash64("x").alias("k1"), F.xxhash64(F.lit(1), F.col("x")).alias("k2")))
    rows = slim.withColumn("key", key)
    kinds = rows.where("key IS NOT NULL").groupBy("key").agg(F.first("x").alias("x"), F.min("vec_id").alias("first"), F.count("*").alias("n"))
    nodes = kinds.select(F.monotonically_increasing_id().alias("node"), "key", "x.label", F.size("x.v").alias("width"), "x.v", "first", "n")
    return rows.select("vec_id", "key"), written(nodes, "nodes")


def cell_centres(nodes: DataFrame, width: int, sample: int = SAMPLE, block_rows: int = BLOCK_ROWS) -> dict[tuple[str, int], np.ndarray]:
    """Centres by label and width, of the deepest level of a cover tree over the sample that has no more than blocks would be full."""
    most = max(1, min(sample, SAMPLE_BYTES // (8 * max(width, 1))))
    taken = nodes.orderBy(F.xxhash64("node"), "node").limit(most).select("label", "width", "v").collect()  # bounded
    by: dict[tuple[str, int], list] = {}
    for r in taken:
        by.setdefault((r.label, r.width), []).append(r.v)
    if not by:
        return {}
    asked = nodes.sparkSession.createDataFrame(list(by), "label string, width int")
    sizes = nodes.select("label", "width").join(F.broadcast(asked), ["label", "width"]).groupBy("label", "width").count().collect()  # a row for each label of the sample
    out = {}
    for r in sizes:
        points = units(np.array(by[r.label, r.width]))
        gram, few, radius = points @ points.T, min(CELLS, r["count"] // block_rows), 2.0
        chosen = np.array([0])
        while few > 1 and radius > 0.1:
            radius /= 2
            level, _ = cover(gram, radius)
            if len(level) > few:
                break
            chosen = level
        if len(chosen) > 1:
            out[r.label, r.width] = points[chosen]
    return out


def in_cells(nodes: DataFrame, centres: dict[tuple[str, int], np.ndarray]) -> DataFrame:
    """node, weight, label, width, v, cell, reach: each vector's nearest centre and its distance."""
    slim = nodes.select("node", F.col("n").alias("weight"), "label", "width", "v")
    if not centres:
        return slim.withColumns({"cell": F.lit(0), "reach": F.lit(0.0)})

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels, widths = batch.column(2).to_pylist(), batch.column(3).to_numpy()
            cell, reach = np.zeros(batch.num_rows, np.int32), np.zeros(batch.num_rows)
            rows: dict[tuple[str, int], list[int]] = {}
            for i, key in enumerate(zip(labels, widths.tolist(), strict=True)):
                if key in centres:
                    rows.setdefault(key, []).append(i)
            for key, own in rows.items():
                points = units(batch.column(4).take(pa.array(own)).flatten().to_numpy().reshape(len(own), key[1]))
                cosines = points @ centres[key].T
                cell[own], reach[own] = cosines.argmax(1), distances(cosines.max(1))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell), pa.array(reach)], [*batch.schema.names, "cell", "reach"])

    return written(map_batches(slim, placed, slim.selectExpr("*", "0 AS cell", "0D AS reach").schema), "placed")


def blocks(nodes: DataFrame, centres: dict[tuple[str, int], np.ndarray], block_rows: int, least: int) -> tuple[DataFrame, DataFrame]:
    """Blocks (label, width, cell, parts, part and their tree), and cells (key of label, width and cell, n, reach)."""
    placed = in_cells(nodes, centres).withColumn("key", F.struct("label", "width", "cell"))
    cells = written(placed.groupBy("key").agg(F.count("*").alias("n"), F.max("reach").alias("reach")), "cells")
    dealt = of_hot_keys(placed.drop("reach"), cells.drop("reach"), "key", least)
    dealt = dealt.withColumn("parts", _parts(F.col("n"), F.col("width"), block_rows)).withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    held = dealt.groupBy(*BLOCK).agg(F.collect_list("node").alias("ids"), F.collect_list("weight").alias("weights"), F.collect_list("v").alias("vs"))
    kind = _kind(nodes)

    def grown(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ids, weights = (batch.column(c)[i].values.to_numpy().astype(np.int64) for c in (5, 6))
                raw = batch.column(7)[i].values.flatten().to_numpy().astype(kind).reshape(len(ids), batch.column(1)[i].as_py())
                tree = Tree.grown(ids, weights, raw).stored()
                yield pa.RecordBatch.from_arrays([*[batch.column(c).slice(i, 1) for c in range(5)], *[pa.array([x], pa.binary()) for x in tree.values()]], [*BLOCK, *tree])

    return written(map_batches(held, grown, f"{BLOCK_SCHEMA}, {TREE}"), "blocks"), cells


def _kind(nodes: DataFrame) -> type:
    return np.float32 if nodes.schema["v"].dataType.simpleString() == "array<float>" else np.float64


def _parts(n: Column, width: Column, block_rows: int) -> Column:
    """Blocks of a cell of n vectors."""
    rows = F.least(F.lit(block_rows), F.greatest(F.lit(1), F.floor(F.lit(BLOCK_BYTES) / (F.lit(8) * width))))
    return F.ceil(n / rows).cast("int")


def near_cells(cells: DataFrame, centres: dict[tuple[str, int], np.ndarray], limit: float, block_rows: int) -> list[tuple]:
    """(label, width, cell, other, parts of the other): cells of one label that may hold a pair within the limit, each pair once."""
    asked = cells.sparkSession.createDataFrame(list(centres), "label string, width int")
    own = cells.select("key.*", "n", "reach").withColumn("parts", _parts(F.col("n"), F.col("width"), block_rows))
    reach = {(r.label, r.width, r.cell): (r.reach, r.parts) for r in own.join(F.broadcast(asked), ["label", "width"]).collect()}  # a row for each centre
    out = []
    for (label, width), points in centres.items():
        apart = distances(points @ points.T)
        for i in range(len(points)):
            for j in range(i):
                a, b = reach.get((label, width, i)), reach.get((label, width, j))
                if a and b and apart[i, j] <= a[0] + b[0] + limit + ROUNDING * 4:
                    out.append((label, width, i, j, b[1]))
    return out


def block_links(held: DataFrame, near: list[tuple], kind: type, cosine: float = COSINE, stripe: int | None = None) -> DataFrame:
    """a, b, n of all pairs of blocks that may be linked, each pair met in one task: numbers of links, and edges that span components."""
    spark = held.sparkSession
    total = held.count()
    stripe = stripe or max(1, min(STRIPE, total // (4 * spark.sparkContext.defaultParallelism)))
    cell = ["label", "width", "cell"]
    in_stripe = F.floor(F.col("part") / stripe).cast("int")
    of = lambda last: F.explode(F.sequence(F.lit(0), F.floor(last / stripe).cast("int")))
    trees = [c for c in held.columns if c not in BLOCK]
    stays = held.select(*cell, in_stripe.alias("stripe"), F.lit(False).alias("asks"), F.col("cell").alias("home"), "part", *trees)
    asked = held.select(*cell, of(F.col("part")).alias("stripe"), F.lit(True).alias("asks"), F.col("cell").alias("home"), "part", *trees)
    if near:
        other = F.broadcast(spark.createDataFrame(near, "label string, width int, cell int, other int, other_parts int"))
        abroad = held.join(other, cell).select("label", "width", F.col("other").alias("cell"), of(F.col("other_parts") - 1).alias("stripe"), F.lit(True).alias("asks"), F.col("cell").alias("home"), "part", *trees)
        asked = asked.unionByName(abroad)
    names = ["a", "b", "n"]

    def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, here = None, []
        for batch in batches:
            for k in range(batch.num_rows):
                r = batch.slice(k, 1).to_pylist()[0]
                unit = (r["label"], r["width"], r["cell"], r["stripe"])
                if unit != at:
                    at, here = unit, []
                tree = Tree.read(r, kind, r["width"])
                if not r["asks"]:
                    here.append((r["part"], tree))
                    continue
                for part, own in here:
                    if r["home"] == r["cell"] and part >= r["part"]:
                        if part == r["part"]:
                            yield pa.RecordBatch.from_arrays([pa.array(x) for x in found(Links(own, own, cosine))], names)
                        continue
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in found(Links(own, tree, cosine))], names)

    unit = ["label", "width", "cell", "stripe"]
    dealt = stays.unionByName(asked).repartition(*unit).sortWithinPartitions(*unit, "asks", "home", "part")
    return map_batches(dealt, met, "a long, b long, n long")


def near_dedup(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", cosine: float = COSINE,
    sample: int = SAMPLE, block_rows: int = BLOCK_ROWS, stripe: int | None = None,
) -> DataFrame:
    """vec_id, n_links (other vectors of its label at `cosine` or more), component_id (least id that links reach) and kept, one row per vector."""
    rows, nodes = nodes_of(vectors, id_col, vector_col, label_col)
    total, n_nodes, width = nodes.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*"), F.coalesce(F.max("width"), F.lit(0))).first()
    centres = cell_centres(nodes, width, sample, block_rows)
    least = max(HOT, n_nodes // MAX_HOT)
    held, cells = blocks(nodes, centres, block_rows, least)
    near = near_cells(cells, centres, float(distances(np.array(cosine))), block_rows) if centres else []
    pairs = written(block_links(held, near, _kind(nodes), cosine, stripe), "pairs")
    counts = pairs.where("n > 0").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("links"))
    roots = components(written(pairs.where("n = 0").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges"))
    slim = written(nodes.select("node", "key", "first", F.col("n").alias("copies")).join(counts, "node", "left").join(roots, "node", "left"), "linked")
    firsts = written(slim.where("root IS NOT NULL").groupBy("root").agg(F.min("first").alias("least"), F.count("*").alias("n")), "least")
    named = of_hot_keys(slim.where("root IS NOT NULL").select("node", "root"), firsts, "root", least).select("node", "least")
    classes = slim.join(named, "node", "left").select("key", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("least", "first").alias("component_id"), F.col("copies").alias("n"))
    classes = written(classes, "classes")
    linked = of_hot_keys(rows.where("key IS NOT NULL"), classes, "key", max(HOT, total // MAX_HOT)).select("vec_id", "n_links", "component_id")
    alone = rows.where("key IS NULL").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def oracle(cosine: float = COSINE) -> str:
    """The same in DuckDB, for vectors of one length."""
    return f"""
WITH RECURSIVE v AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings),
ok AS (SELECT * FROM v WHERE label IS NOT NULL AND e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
links AS (SELECT p.vec_id AS a, q.vec_id AS b FROM ok p JOIN ok q ON p.label = q.label AND p.vec_id <> q.vec_id WHERE list_cosine_similarity(p.e, q.e) >= {cosine}),
reach AS (SELECT vec_id, vec_id AS other FROM v UNION SELECT r.vec_id, l.b FROM reach r JOIN links l ON l.a = r.other),
least AS (SELECT vec_id, min(other) AS component_id FROM reach GROUP BY vec_id),
n AS (SELECT a AS vec_id, count(*) AS n_links FROM links GROUP BY a)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept FROM least LEFT JOIN n USING (vec_id)"""
