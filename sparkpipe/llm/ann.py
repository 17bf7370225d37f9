"""Approximate nearest neighbours: stable projections, kd-trees, incremental verification.

Vectors are projected to a few dimensions with Gaussian (2-stable) directions, so the squared
projected distance of two vectors is their squared distance times a chi-square variable.
A kd-tree over a bounded sample of projections deals all vectors into cells of even size;
each cell is indexed by its own kd-tree.  A query goes through projected neighbours in
increasing projected distance, verifies each against the original vectors, and stops when
the chi-square test says that a vector nearer than its k-th best would have shown up by now
with probability ``confidence``.  It starts in its home cell; the distance of the k-th best
there tells which other cells can hold a candidate before the test stops, and only those
are visited.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise

#: Dimensions of the projections; probability of the stopping test.
DIMENSIONS, CONFIDENCE = 8, 0.97
SEED = 20
#: Vectors that the cells' borders are fitted on, at most; vectors of a cell, about.
SAMPLE, CELL = 20_000, 8_192
LEAF = 64
#: Rows among which equal vectors are looked for before they are dealt.
THINNED = 10_000
#: Queries that visit a cell together; a cell that more visit is searched by several tasks.
BLOCK = 4_096


def chi_square_quantile(p: float, m: int) -> float:
    """x with P(chi-square of ``m`` degrees <= x) = p, by bisection on the series of the gamma function."""
    def below(x: float) -> float:
        a, z = m / 2, x / 2
        term = total = 1 / a
        n = a
        while term > total * 1e-15:
            n += 1
            term *= z / n
            total += term
        return total * math.exp(-z + a * math.log(z) - math.lgamma(a))

    low, high = 1e-9, 10.0 * m + 100
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if below(mid) < p else (low, mid)
    return high


def directions(width: int, m: int) -> np.ndarray:
    return np.random.default_rng(SEED).standard_normal((width, m))


class Tree:
    """A kd-tree over projected points: leaves in arrays, boxes of all nodes."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF):
        self.order = np.arange(len(points))
        self.low, self.high, self.child, self.span = [], [], [], []
        stack = [(0, len(points), -1)]
        while stack:
            a, b, parent = stack.pop()
            part = points[self.order[a:b]]
            me = len(self.low)
            self.low.append(part.min(0))
            self.high.append(part.max(0))
            self.child.append([])
            self.span.append((a, b))
            if parent >= 0:
                self.child[parent].append(me)
            wide = self.high[me] - self.low[me]
            if b - a > leaf and wide.max() > 0:
                axis, mid = int(wide.argmax()), (b - a) // 2
                self.order[a:b] = self.order[a:b][np.argpartition(part[:, axis], mid)]
                stack += [(a, a + mid, me), (a + mid, b, me)]
        self.low, self.high = np.array(self.low), np.array(self.high)
        self.points = points[self.order]

    def increasing(self, q: np.ndarray):
        """Yield (rows, radius): rows of the tree in increasing projected distance, block by block.

        All rows within ``radius`` of ``q`` have been given when it is yielded.
        """
        gap = np.maximum(np.maximum(self.low - q, q - self.high), 0)
        box = np.einsum("ij,ij->i", gap, gap)
        heap, waiting, far = [(box[0], 0)], np.zeros(0, np.int64), np.zeros(0)
        while heap:
            d, node = heapq.heappop(heap)
            if self.child[node]:
                for c in self.child[node]:
                    heapq.heappush(heap, (box[c], c))
                continue
            a, b = self.span[node]
            diff = self.points[a:b] - q
            waiting = np.concatenate([waiting, np.arange(a, b)])
            far = np.concatenate([far, np.einsum("ij,ij->i", diff, diff)])
            bound = heap[0][0] if heap else math.inf
            ready = far <= bound
            if ready.any() or not heap:
                by = np.argsort(far[ready], kind="stable")
                yield self.order[waiting[ready][by]], bound
                waiting, far = waiting[~ready], far[~ready]


def distances(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Euclidean distances in double precision."""
    diff = x - q
    return np.sqrt(np.einsum("ij,ij->i", diff, diff))


def search(tree: Tree, x: np.ndarray, ids: np.ndarray, q: np.ndarray, q_id: int, projected: np.ndarray,
           k: int, quantile: float, bound: float = math.inf) -> list[tuple[float, int]]:
    """The ``k`` nearest found: (distance, id), nearest first, ties to smaller ids.

    ``bound``: a distance of a k-th neighbour already known.
    """
    best: list[tuple[float, int]] = []
    for rows, radius in tree.increasing(projected):
        d, found = distances(x[rows], q), ids[rows]
        limit = min(bound, best[-1][0] if len(best) == k else math.inf)
        use = (d <= limit) & (found != q_id)
        if use.any():
            best = sorted({*best, *zip(d[use].tolist(), found[use].tolist(), strict=True)})[:k]
            limit = min(bound, best[-1][0] if len(best) == k else math.inf)
        # the chi-square test: what is within ``limit`` has a projection within this radius
        if radius > quantile * limit * limit:
            break
    return best


class Cells:
    """Borders of the top kd-tree: splits of the projected space, and the cell of a point."""

    def __init__(self, sample: np.ndarray, cells: int):
        m = sample.shape[1] if sample.ndim == 2 else 0
        self.splits: list[tuple[int, float, int, int]] = []  # axis, value, left, right; children < 0 are cells
        self.boxes: list[tuple[np.ndarray, np.ndarray]] = []

        def build(part: np.ndarray, n: int, low: np.ndarray, high: np.ndarray) -> int:
            spread = np.ptp(part, axis=0) if len(part) else np.zeros(0)
            if n <= 1 or len(part) < 2 or not spread.max() > 0:
                self.boxes.append((low, high))
                return -len(self.boxes)
            axis = int(spread.argmax())
            value = float(np.median(part[:, axis]))
            if not (part[:, axis] > value).any():
                value = float(part[part[:, axis] < value, axis].max())
            at = len(self.splits)
            self.splits.append((axis, value, 0, 0))
            left_high, right_low = high.copy(), low.copy()
            left_high[axis] = right_low[axis] = value
            side = part[:, axis] <= value
            self.splits[at] = (axis, value, build(part[side], n // 2, low, left_high),
                               build(part[~side], n - n // 2, right_low, high))
            return at

        self.root = build(sample, cells, np.full(m, -np.inf), np.full(m, np.inf))
        self.low, self.high = (np.array(b) for b in zip(*self.boxes, strict=True))

    def cell(self, points: np.ndarray) -> np.ndarray:
        out = np.zeros(len(points), np.int64)
        stack = [(self.root, np.arange(len(points)))]
        while stack:
            at, rows = stack.pop()
            if at < 0:
                out[rows] = -at - 1
                continue
            axis, value, left, right = self.splits[at]
            side = points[rows, axis] <= value
            stack += [(left, rows[side]), (right, rows[~side])]
        return out

    def near(self, q: np.ndarray, radius: float) -> np.ndarray:
        """Cells within squared projected distance ``radius``."""
        gap = np.maximum(np.maximum(self.low - q, q - self.high), 0)
        return np.flatnonzero((gap * gap).sum(1) <= radius)


def _matrix(column) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """id, vec of the vectors that take part: not null, not zero, all components finite; ids not null."""
    v = F.col(vec_col).cast("array<double>")
    odd = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vectors.select(F.col(id_col).cast("long").alias("id"), v.alias("vec")).where(
        F.col("id").isNotNull() & F.col("vec").isNotNull() & ~F.coalesce(odd, F.lit(False))
        & F.exists("vec", lambda x: x != 0))


def _thin(k: int):
    """Of equal vectors only the k + 1 smallest ids of each stretch of rows: no result can hold another."""
    def thin(part: pa.Table):
        ids, raw = part.column("id").to_numpy(), _matrix(part.column("vec").combine_chunks())
        keep: dict[bytes, list] = {}
        for i in np.argsort(ids, kind="stable"):
            same = keep.setdefault(raw[i].tobytes(), [])
            if len(same) <= k:
                same.append(i)
        return part.take(pa.array(sorted(i for s in keep.values() for i in s), pa.int64())).to_batches()

    def run(batches):
        waiting, rows = [], 0
        for batch in batches:
            waiting.append(batch)
            rows += batch.num_rows
            if rows >= THINNED:
                yield from thin(pa.Table.from_batches(waiting))
                waiting, rows = [], 0
        if rows:
            yield from thin(pa.Table.from_batches(waiting))
    return run


def _deal(cells: Cells, direction: np.ndarray):
    def run(batches):
        for batch in batches:
            cell = cells.cell(_matrix(batch.column("vec")) @ direction)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell)], [*batch.schema.names, "cell"])
    return run


def _visit(direction, k, quantile):
    """cogroup: the queries of a cell search its tree, block by block."""
    def run(key, left, right):
        out = ([], [], [])
        if len(left) and len(right):
            x = _matrix(right.column("vec").combine_chunks())
            ids = right.column("id").to_numpy()
            tree = Tree(x @ direction)
            q = _matrix(left.column("vec").combine_chunks())
            projected = q @ direction
            q_ids, bounds = left.column("query").to_numpy(), left.column("bound").to_numpy()
            for i in range(len(q)):
                for d, found in search(tree, x, ids, q[i], q_ids[i], projected[i], k, quantile, bounds[i]):
                    out[0].append(q_ids[i])
                    out[1].append(found)
                    out[2].append(d)
        return pa.table({"query": pa.array(out[0], pa.int64()), "found": pa.array(out[1], pa.int64()),
                         "score": pa.array(out[2], pa.float64())})
    return run


_FOUND = "query long, found long, score double"


def _further(cells: Cells, direction, quantile, k):
    """Cells that a query has still to visit, given what it found at home."""
    def run(batches):
        for batch in batches:
            q = _matrix(batch.column("vec")) @ direction
            bound = np.where(batch.column("n").to_numpy() >= k, batch.column("worst").to_numpy(zero_copy_only=False), np.inf)
            home = batch.column("cell").to_numpy()
            near = [cells.near(p, quantile * b * b) for p, b in zip(q, bound, strict=True)]
            rows = np.repeat(np.arange(len(q)), [len(n) for n in near])
            to = np.concatenate([*near, np.zeros(0, np.int64)]).astype(np.int64)
            keep = to != home[rows]
            rows, to = rows[keep], to[keep]
            yield pa.RecordBatch.from_arrays(
                [batch.column("query").take(pa.array(rows)), batch.column("vec").take(pa.array(rows)),
                 pa.array(bound[rows]), pa.array(to)], ["query", "vec", "bound", "cell"])
    return run


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "vec_id", vec_col: str = "embedding",
            dimensions: int = DIMENSIONS, confidence: float = CONFIDENCE, sample: int = SAMPLE, cell: int = CELL) -> DataFrame:
    """query_id, rank (from 1), the neighbour's id, score: at most ``k`` neighbours of each query.

    The score is the Euclidean distance of the original vectors in double precision; equal
    distances go to smaller ids; a query is no neighbour of itself.  Vectors that are null,
    zero, or hold null, NaN or infinite components take no part, nor do null ids; vectors of
    another width than the commonest neither.  Rows repeated with one id are one vector (the
    first in order of its components).  An empty table gives an empty result.  The cells'
    borders are fitted on at most ``sample`` vectors; every vector is indexed.
    """
    spark = vectors.sparkSession
    clean = usable(vectors, id_col, vec_col).groupBy("id").agg(F.min("vec").alias("vec"))
    asked = usable(queries, id_col, vec_col).groupBy("id").agg(F.min("vec").alias("vec"))
    widths = clean.groupBy(F.size("vec").alias("w")).count().orderBy(F.desc("count"), "w").limit(1).collect()
    empty = spark.createDataFrame([], f"query_id long, rank int, {id_col} long, score double")
    if not widths:
        return empty
    width, total = widths[0]["w"], widths[0]["count"]
    clean, asked = clean.where(F.size("vec") == width), asked.where(F.size("vec") == width)
    base = materialise(clean.mapInArrow(_thin(k), "id long, vec array<double>"), "vectors")
    direction = directions(width, dimensions)
    quantile = chi_square_quantile(confidence, dimensions)
    picked = base.orderBy(F.xxhash64("id"), "id").limit(sample).select("vec").toArrow().column("vec").combine_chunks()
    cells = Cells(_matrix(picked) @ direction, max(1, math.ceil(total / cell)))
    indexed = materialise(base.mapInArrow(_deal(cells, direction), "id long, vec array<double>, cell long"), "cells")
    start = materialise(asked.withColumnRenamed("id", "query").mapInArrow(
        _deal(cells, direction), "query long, vec array<double>, cell long"), "queries")

    blocks = math.ceil(max(1, start.count()) / BLOCK)

    def visit(rows: DataFrame) -> DataFrame:
        rows = rows.withColumn("block", F.pmod(F.xxhash64("query"), F.lit(blocks)))
        wanted = indexed.join(rows.select(F.col("cell"), F.col("block").alias("part")).distinct(), "cell")
        return rows.groupBy("cell", "block").cogroup(wanted.groupBy("cell", "part")) \
            .applyInArrow(_visit(direction, k, quantile), _FOUND)

    home = materialise(visit(start.withColumn("bound", F.lit(float("inf")))), "home")
    known = home.groupBy("query").agg(F.count("*").alias("n"), F.max("score").alias("worst"))
    further = start.join(known, "query", "left").select(
        "query", "vec", "cell", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("worst", F.lit(float("inf"))).alias("worst"))
    rest = further.mapInArrow(_further(cells, direction, quantile, k), "query long, vec array<double>, bound double, cell long")
    found = home.unionByName(visit(rest))
    # at most k rows of each query and cell: an ordered list of a query's best
    best = found.groupBy("query").agg(F.slice(F.array_sort(F.collect_set(F.struct("score", "found"))), 1, k).alias("best"))
    return best.select(F.col("query").alias("query_id"), F.posexplode("best").alias("i", "b")).select(
        "query_id", (F.col("i") + 1).alias("rank"), F.col("b.found").alias(id_col), F.col("b.score").alias("score"))
