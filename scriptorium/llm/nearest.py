"""Approximate nearest neighbours by inner product: few stable projections, a kd-tree over them, and a chi-square stop.

A vector x becomes (x, sqrt(M - |x|^2)), M being the largest squared norm, and a query (q, 0): the largest inner product is
then the smallest distance. ``DIMENSIONS`` Gaussian projections map a distance d to one whose square is d^2 times a
chi-square variable of that many degrees. Steps:

1. **kd-tree.** Splits at medians of a sample (at most ``SAMPLE`` rows, those with the smallest hash of their id) cut
   the projected space into cells; every vector goes to its cell, large cells are dealt into blocks of about ``BLOCK``.
2. **First bound.** Each query is answered in one block of its own cell, which bounds the distance of its k-th neighbour.
3. **Search.** A query goes to the blocks of all cells whose box may hold a projection within the stopping radius. There
   a kd-tree of the block's points gives leaves by rising distance of their boxes; points within the radius are
   verified on the whole vectors, and each verified neighbour shrinks it. A leaf, cell or point beyond
   ``bound * quantile(CONFIDENCE)`` is skipped: a nearer neighbour lies there with a chance of 1 - CONFIDENCE at most.
4. **Merge.** The best of all blocks, in double precision; ties go to the smaller id.

A vector has an inner product with vectors of its own length only, so each length is searched on its own.

Defined cases: vectors that are null, empty, zero, or hold null or non-finite components take no part. Rows that repeat an id are one candidate, with their best score. A query without candidates has no rows.
Other columns are not used; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scriptorium.llm.store import settle

K = 20
DIMENSIONS, CONFIDENCE = 8, 0.99
SAMPLE, BLOCK, LEAF = 16_384, 8_192, 128
#: Queries that a task answers at once.
QUERIES = 4_096


def quantile(p: float, degrees: int) -> float:
    """Value below which a chi-square variable of an even number of degrees stays with probability p."""
    low, high = 0.0, 10.0 * degrees + 100
    for _ in range(80):
        x = (low + high) / 2
        above = math.exp(-x / 2) * sum((x / 2) ** i / math.factorial(i) for i in range(degrees // 2))
        low, high = (x, high) if 1 - above < p else (low, x)
    return high


def _matrix(column: pa.Array, width: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the column that take part, as doubles, and which they are."""
    sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    width = width or int(sizes.max(initial=0))
    which = np.flatnonzero((sizes == width) & (width > 0))
    flat = pc.list_flatten(column.take(pa.array(which))).cast(pa.float64())
    rows = pc.fill_null(flat, float("nan")).to_numpy(zero_copy_only=False).reshape(len(which), width)
    good = np.isfinite(rows).all(axis=1) & (rows != 0).any(axis=1)
    return rows[good], which[good]


class Projection:
    """The Gaussian projections of one table, for vectors and queries."""

    def __init__(self, width: int, largest: float, dimensions: int = DIMENSIONS):
        self.width, self.largest = width, largest
        self.axes = np.random.default_rng(97).standard_normal((width + 1, dimensions))

    def lift(self, rows: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(0.0, self.largest - (rows * rows).sum(axis=1)))

    def vectors(self, rows: np.ndarray) -> np.ndarray:
        return rows @ self.axes[:-1] + self.lift(rows)[:, None] * self.axes[-1]

    def queries(self, rows: np.ndarray) -> np.ndarray:
        return rows @ self.axes[:-1]


class Cells:
    """kd-tree splits of the projected space, fitted on a sample; cell c is a leaf with a box."""

    def __init__(self, points: np.ndarray, depth: int):
        self.splits: list[list[tuple[int, float]]] = []
        boxes = [(np.full(points.shape[1], -np.inf), np.full(points.shape[1], np.inf))]
        parts = [points]
        for _ in range(depth):
            level, new_boxes, new_parts = [], [], []
            for part, (low, high) in zip(parts, boxes):
                axis = int(np.ptp(part, axis=0).argmax()) if len(part) else 0
                at = float(np.median(part[:, axis])) if len(part) else 0.0
                level.append((axis, at))
                up, down = low.copy(), high.copy()
                up[axis], down[axis] = at, at
                new_boxes += [(low, down), (up, high)]
                new_parts += [part[part[:, axis] <= at], part[part[:, axis] > at]]
            self.splits.append(level)
            boxes, parts = new_boxes, new_parts
        self.low, self.high = np.array([b[0] for b in boxes]), np.array([b[1] for b in boxes])

    def of(self, points: np.ndarray) -> np.ndarray:
        cell = np.zeros(len(points), np.int64)
        for level in self.splits:
            axis, at = np.array([s[0] for s in level]), np.array([s[1] for s in level])
            cell = cell * 2 + (points[np.arange(len(points)), axis[cell]] > at[cell])
        return cell

    def distances(self, points: np.ndarray) -> np.ndarray:
        """Squared distance of each point to each cell's box."""
        return _to_boxes(points, self.low, self.high)


def _to_boxes(points: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    out = np.zeros((len(points), len(low)))
    for d in range(points.shape[1]):
        p = points[:, d, None]
        gap = np.maximum(0.0, np.maximum(low[None, :, d] - p, p - high[None, :, d]))
        out += gap * gap
    return out


def _leaves(points: np.ndarray) -> list[np.ndarray]:
    """Leaves of a kd-tree over the points."""
    stack, leaves = [np.arange(len(points))], []
    while stack:
        some = stack.pop()
        if len(some) <= LEAF:
            leaves.append(some)
            continue
        axis = int(np.ptp(points[some], axis=0).argmax())
        order = some[np.argpartition(points[some, axis], len(some) // 2)]
        stack += [order[: len(some) // 2], order[len(some) // 2 :]]
    return leaves


def search(
    ids: np.ndarray, rows: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, bounds: np.ndarray,
    projection: Projection, k: int, stop: float,
) -> tuple[np.ndarray, np.ndarray]:
    """(ids, scores) of the k best ids for each query, -1 where there are fewer; ``bounds`` are squared distances.

    An id that several rows have takes one place, with the best of its scores.
    """
    repeated = len(np.unique(ids)) < len(ids)
    points, spots = projection.vectors(rows), projection.queries(queries)
    leaves = _leaves(points)
    low, high = (np.array([f(points[x], axis=0) for x in leaves]) for f in (np.min, np.max))
    gaps = _to_boxes(spots, low, high)
    squared = (queries * queries).sum(axis=1) + projection.largest
    best = np.full((len(queries), k), -np.inf)
    who = np.full((len(queries), k), -1, np.int64)
    for leaf in np.argsort(gaps.min(axis=0), kind="stable"):
        some = leaves[leaf]
        # distance^2 = |q|^2 + M - 2 q.x, of the k-th best so far or of the bound that came with the query
        reach = stop * np.minimum(bounds, squared - 2 * best[:, -1])
        asking = np.flatnonzero(gaps[:, leaf] <= reach)
        if not len(asking):
            continue
        apart = ((spots[asking][:, None, :] - points[some][None, :, :]) ** 2).sum(axis=2)
        score = np.where(apart <= reach[asking, None], queries[asking] @ rows[some].T, -np.inf)
        score[query_ids[asking][:, None] == ids[some][None, :]] = -np.inf
        value = np.concatenate([best[asking], score], axis=1)
        name = np.concatenate([who[asking], np.broadcast_to(ids[some], score.shape)], axis=1)
        if repeated:  # only the best row of each id stays
            order = np.lexsort((-value, name), axis=1)
            value, name = (np.take_along_axis(x, order, axis=1) for x in (value, name))
            value[:, 1:][name[:, 1:] == name[:, :-1]] = -np.inf
        order = np.lexsort((name, -value), axis=1)[:, :k]
        best[asking] = np.take_along_axis(value, order, axis=1)
        who[asking] = np.where(np.isinf(best[asking]), -1, np.take_along_axis(name, order, axis=1))
    return who, best


def nearest(
    vectors: DataFrame, queries: DataFrame, k: int = K, confidence: float = CONFIDENCE, block: int = BLOCK
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found rows of ``vectors`` for each row of ``queries``.

    Both have vec_id and embedding; a query's own id is no candidate for it.
    """

    def norms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pc.list_value_length(batch.column("embedding"))
            for width in pc.unique(sizes.drop_null()).to_pylist():
                rows, _ = _matrix(batch.column("embedding"), width)
                if len(rows):
                    yield pa.RecordBatch.from_pydict(
                        {"width": [width], "n": [len(rows)], "largest": [float((rows * rows).sum(axis=1).max())]}
                    )

    vectors = vectors.select("vec_id", "embedding").filter("vec_id is not null")
    queries = queries.select("vec_id", "embedding").filter("vec_id is not null")
    told = vectors.mapInArrow(norms, "width long, n long, largest double").groupBy("width")
    told = told.agg(F.sum("n").alias("n"), F.max("largest").alias("largest"))
    found = vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    for alike in told.orderBy("width").collect():
        of_width = F.size("embedding") == alike["width"]
        projection = Projection(alike["width"], alike["largest"])
        found = found.union(_nearest(vectors.filter(of_width), queries.filter(of_width), alike["n"], projection, k, confidence, block))
    return found


def _nearest(
    vectors: DataFrame, queries: DataFrame, n: int, projection: Projection, k: int, confidence: float, block: int
) -> DataFrame:
    """The k nearest found among n vectors of the projection's length."""
    stop = quantile(confidence, DIMENSIONS)

    # a sample of fixed size fits the splits
    few = vectors.orderBy(F.xxhash64("vec_id")).limit(SAMPLE).toArrow().column("embedding").combine_chunks()
    sample = projection.vectors(_matrix(few, projection.width)[0])
    cells = Cells(sample, max(0, min(math.ceil(math.log2(n / block)), int(math.log2(max(1, len(sample)) / 16)))))

    def placed(as_queries: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows, which = _matrix(batch.column("embedding"), projection.width)
                spots = projection.queries(rows) if as_queries else projection.vectors(rows)
                ids = batch.column("vec_id").to_numpy(zero_copy_only=False)[which]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(list(rows), pa.list_(pa.float64())), pa.array(cells.of(spots))],
                    ["vec_id", "embedding", "cell"],
                )

        return run

    kind = "vec_id long, embedding array<double>, cell long"
    data, asked = vectors.mapInArrow(placed(False), kind), queries.mapInArrow(placed(True), kind)
    # at most SAMPLE / 16 cells, whatever the input
    sizes = {r["cell"]: r["n"] for r in data.groupBy("cell").agg(F.count("*").alias("n")).collect()}
    blocks = [-(-sizes.get(c, 0) // block) for c in range(len(cells.low))]
    per_cell = F.create_map(*[F.lit(x) for c, b in enumerate(blocks) for x in (c, max(1, b))])[F.col("cell")]
    data = data.withColumn("block", F.pmod(F.xxhash64("vec_id"), per_cell).cast("long"))

    def answers(first: bool):
        def run(key, asking: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
            if first:
                empty = pd.DataFrame({"query_id": asking["vec_id"], "embedding": asking["embedding"], "bound": np.inf})
                for name in ("ids", "scores"):
                    empty[name] = pd.Series([[] for _ in range(len(asking))], index=empty.index, dtype=object)
            else:
                empty = pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
            if not len(held) or not len(asking):
                return empty if len(asking) else empty.iloc[:0]
            rows, wanted = np.stack(held["embedding"].to_numpy()), np.stack(asking["embedding"].to_numpy())
            bounds = np.full(len(asking), np.inf) if first else asking["bound"].to_numpy()
            query_ids = asking["vec_id"].to_numpy()
            who, score = search(held["vec_id"].to_numpy(), rows, query_ids, wanted, bounds, projection, k, stop)
            if first:
                squared = (wanted * wanted).sum(axis=1) + projection.largest
                good = [w >= 0 for w in who]
                held_ids, held_scores = [w[g] for w, g in zip(who, good)], [x[g] for x, g in zip(score, good)]
                return empty.assign(bound=squared - 2 * score[:, -1], ids=held_ids, scores=held_scores)
            at, place = np.nonzero(who >= 0)
            return pd.DataFrame({"query_id": query_ids[at], "vec_id": who[at, place], "score": score[at, place]})

        return run

    def meet(asking: DataFrame, run, kind: str, name: str) -> DataFrame:
        """Queries and vectors of the same block; a block that more than ``QUERIES`` ask answers in turns, one that none asks stays."""
        asking, by = settle(asking, name), ["cell", "block"]
        turns = settle(asking.groupBy(by).agg(F.ceil(F.count("*") / QUERIES).cast("long").alias("turns")), f"{name}-turns")
        asking = asking.join(turns, by).withColumn("turn", F.pmod(F.xxhash64("vec_id", F.lit(3)), "turns")).drop("turns")
        every = data.join(turns, by).withColumn("turn", F.explode(F.sequence(F.lit(0).cast("long"), F.col("turns") - 1)))
        every, by = every.drop("turns"), [*by, "turn"]
        return asking.groupBy(by).cogroup(every.groupBy(by)).applyInPandas(run, kind)

    home = asked.withColumn("block", F.pmod(F.xxhash64("vec_id", F.lit(5)), per_cell).cast("long"))
    bounded = settle(meet(home, answers(True), "query_id long, embedding array<double>, bound double, ids array<long>, scores array<double>", "home"), "bounds")

    def routed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.stack(batch.column("embedding").to_numpy(zero_copy_only=False)) if len(batch) else np.zeros((0, projection.width))
            bound = batch.column("bound").to_numpy(zero_copy_only=False)
            reach = np.where(np.isfinite(bound), stop * np.maximum(bound, 0), np.inf)
            at, cell = np.nonzero(cells.distances(projection.queries(rows)) <= reach[:, None])
            many = np.array(blocks, np.int64)[cell]
            at, cell = np.repeat(at, many), np.repeat(cell, many)
            number = np.arange(len(at)) - np.repeat(np.cumsum(many) - many, many)
            some = pa.array(at)
            yield pa.RecordBatch.from_arrays(
                [batch.column("query_id").take(some), batch.column("embedding").take(some), batch.column("bound").take(some),
                 pa.array(cell, pa.int64()), pa.array(number, pa.int64())],
                ["vec_id", "embedding", "bound", "cell", "block"],
            )

    going = bounded.drop("ids", "scores").mapInArrow(routed, "vec_id long, embedding array<double>, bound double, cell long, block long")
    found = meet(going, answers(False), "query_id long, vec_id long, score double", "routed")
    # what the first block gave counts as well, so that no query ends with fewer than it has seen
    told = bounded.select("query_id", F.explode(F.arrays_zip("ids", "scores")).alias("x")).select("query_id", "x.ids", "x.scores")
    found = found.union(told)
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )
