"""Nearest neighbours through low-dimensional stable projections in kd-trees."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from climagrid.llm import chisquare
from climagrid.llm.shipping import with_modules
from climagrid.operators.joins import lookup_join
from climagrid.sources.scratch import materialize

#: Dimensions of the projection, drawn from the normal distribution, which is 2-stable.
PROJECTED = 8
#: Probability with which a point as near as the last found neighbour has been verified at the end.
CONFIDENCE = 0.99
#: Rows of a block, which is one task's kd-tree; queries that meet a block in one task.
BLOCK, QUERIES = 8192, 4096
#: Bounds of the sample that places the cells, and of their number. Every row is indexed.
SAMPLE, CELLS = 16_384, 4096
LEAF = 256

_QUANTILE = chisquare.quantile(CONFIDENCE, PROJECTED)
_PLACED = "vec_id bigint, vec binary, dim int, cell int"
_KEYS = ["dim", "cell", "sub"]
_FOUND = "query_id bigint, vec_id bigint, d2 double"

#: Per dimension of the vectors: split axes and values of the inner nodes, and the cells' boxes.
Cells = dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]


def _projection(dim: int) -> np.ndarray:
    return np.random.default_rng(dim).standard_normal((dim, PROJECTED))


def _matrix(packed: pd.Series, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(packed), np.float64).reshape(-1, dim)


def _cells(points: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """A complete kd-tree of 2**depth cells with median splits along the widest side."""
    inner, count = (1 << depth) - 1, 1 << depth
    axes, values = np.zeros(inner, int), np.zeros(inner)
    low = np.full((inner + count, PROJECTED), -np.inf)
    high = np.full((inner + count, PROJECTED), np.inf)
    rows = {0: points}
    for node in range(inner):
        own = rows.pop(node)
        if len(own):
            axes[node] = axis = int(np.argmax(np.ptp(own, axis=0)))
            values[node] = np.median(own[:, axis])
        axis, value = axes[node], values[node]
        left = own[:, axis] <= value
        for child, side in ((2 * node + 1, left), (2 * node + 2, ~left)):
            rows[child] = own[side]
            low[child], high[child] = low[node], high[node]
        high[2 * node + 1, axis] = min(value, high[2 * node + 1, axis])
        low[2 * node + 2, axis] = max(value, low[2 * node + 2, axis])
    return axes, values, low[inner:], high[inner:]


def _cell_of(points: np.ndarray, cells: Cells, dim: int) -> np.ndarray:
    if dim not in cells:
        return np.zeros(len(points), int)
    axes, values, low, _ = cells[dim]
    node = np.zeros(len(points), int)
    for _ in range(int(np.log2(len(low)))):
        node = 2 * node + 1 + (points[np.arange(len(points)), axes[node]] > values[node])
    return node - len(axes)


def _box_distances(low: np.ndarray, high: np.ndarray, point: np.ndarray) -> np.ndarray:
    """Squared projected distance of a point from each box."""
    return np.square(np.maximum(np.maximum(low - point, point - high), 0)).sum(axis=1)


def _limit(bound: float, point: np.ndarray) -> float:
    """Projected squared distance beyond which the chi-square test ends the search.

    A point at squared distance ``bound`` has a projected one of ``bound`` times a chi-square value,
    so one beyond the limit is nearer than ``bound`` with a probability below 1 - CONFIDENCE.
    """
    rounding = 1e-9 * (1.0 + float(point @ point))
    return bound * _QUANTILE * (1 + 1e-9) + rounding


class KdTree:
    """Leaves of a kd-tree over the projected points, with their boxes."""

    def __init__(self, points: np.ndarray):
        self.leaves: list[np.ndarray] = []
        todo = [np.arange(len(points))] if len(points) else []
        while todo:
            rows = todo.pop()
            widths = np.ptp(points[rows], axis=0)
            axis = int(np.argmax(widths))
            if len(rows) <= LEAF or widths[axis] == 0:
                self.leaves.append(rows)
                continue
            order = rows[np.argsort(points[rows, axis], kind="stable")]
            todo += [order[: len(order) // 2], order[len(order) // 2 :]]
        self.low = np.array([points[r].min(axis=0) for r in self.leaves])
        self.high = np.array([points[r].max(axis=0) for r in self.leaves])


def _search(
    tree: KdTree, ids: np.ndarray, vectors: np.ndarray, projected: np.ndarray,
    query_id: int, query: np.ndarray, point: np.ndarray, bound: float, k: int,
) -> tuple[np.ndarray, np.ndarray]:
    """The block's ``k`` nearest rows of other ids, as (ids, squared distances).

    Leaves come in the order of their projected distance; their rows within the limit are verified
    on the original vectors, which lowers the limit, until the next leaf is beyond it.
    """
    best_id, best_d2 = np.empty(0, np.int64), np.empty(0)
    apart = _box_distances(tree.low, tree.high, point)
    limit = _limit(bound, point)
    for leaf in np.argsort(apart, kind="stable"):
        if apart[leaf] > limit:
            break
        rows = tree.leaves[leaf]
        near = rows[np.square(projected[rows] - point).sum(axis=1) <= limit]
        near = near[ids[near] != query_id]
        if not len(near):
            continue
        best_id = np.concatenate([best_id, ids[near]])
        best_d2 = np.concatenate([best_d2, np.square(vectors[near] - query).sum(axis=1)])
        order = np.lexsort((best_id, best_d2))
        best_id, best_d2 = best_id[order], best_d2[order]
        if len(np.unique(best_id)) < len(best_id):
            first = np.sort(np.unique(best_id, return_index=True)[1])
            best_id, best_d2 = best_id[first], best_d2[first]
        best_id, best_d2 = best_id[:k], best_d2[:k]
        if len(best_d2) == k and best_d2[-1] < bound:
            bound = float(best_d2[-1])
            limit = _limit(bound, point)
    return best_id, best_d2


def _usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def _sample_cells(base: DataFrame, rows: int) -> Cells:
    sample = base.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE)

    def project(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for dim, own in frame.groupby("dim"):
                points = _matrix(own["vec"], int(dim)) @ _projection(int(dim))
                yield pd.DataFrame({"dim": own["dim"], "point": list(points)})

    found = sample.select("dim", "vec").mapInPandas(project, "dim int, point array<double>").collect()
    by_dim: dict[int, list] = {}
    for row in found:
        by_dim.setdefault(row["dim"], []).append(row["point"])
    cells = {}
    for dim, points in sorted(by_dim.items()):
        wanted = min(CELLS, rows * len(points) / max(1, len(found)) / BLOCK)
        cells[dim] = _cells(np.array(points), max(0, int(np.ceil(np.log2(max(1.0, wanted))))))
    return cells


def _place(base: DataFrame, cells: Cells) -> DataFrame:
    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for dim, own in frame.groupby("dim"):
                points = _matrix(own["vec"], int(dim)) @ _projection(int(dim))
                yield own.assign(cell=_cell_of(points, cells, int(dim)))[["vec_id", "vec", "dim", "cell"]]

    return base.mapInPandas(place, _PLACED)


def _dealt(rows: DataFrame, queries: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows and queries of the blocks that are asked at all, with the ``slice`` they meet in.

    Queries are counted by block. Only a block that more than ``QUERIES`` of them ask comes in several
    slices, each with its share of the queries, so rows are copied as their own block is asked.
    """
    asks = queries.groupBy(*_KEYS).agg(F.ceil(F.count("*") / QUERIES).cast("int").alias("slices"))
    asks = materialize(asks, "asked-blocks")
    copies = lookup_join(rows, asks, _KEYS)
    copies = copies.withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
    asked = lookup_join(queries, asks, _KEYS)
    asked = asked.withColumn("slice", F.pmod(F.xxhash64("query_id"), F.col("slices")).cast("int"))
    return copies.drop("slices"), asked.drop("slices")


def _visit(rows: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """Queries (with ``cell, sub, bound``) answered by the blocks of rows that they name."""
    keys = [*_KEYS, "slice"]
    copies, asked = _dealt(rows, queries)

    def answer(block: pd.DataFrame, asking: pd.DataFrame) -> pd.DataFrame:
        parts = []
        if len(block) and len(asking):
            dim = int(block["dim"].iloc[0])
            vectors, wanted = _matrix(block["vec"], dim), _matrix(asking["query"], dim)
            projection = _projection(dim)
            projected, points = vectors @ projection, wanted @ projection
            tree, ids = KdTree(projected), block["vec_id"].to_numpy(np.int64)
            named = zip(asking["query_id"], wanted, points, asking["bound"], strict=True)
            for query_id, query, point, bound in named:
                found, d2 = _search(tree, ids, vectors, projected, query_id, query, point, bound, k)
                parts.append(pd.DataFrame({"query_id": query_id, "vec_id": found, "d2": d2}))
        if not parts:
            return pd.DataFrame({"query_id": [], "vec_id": [], "d2": []})
        return pd.concat(parts)

    return copies.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInPandas(answer, _FOUND)


def _routes(bounded: DataFrame, cells: Cells) -> DataFrame:
    """Each query with every cell whose box passes the chi-square test for its bound."""

    def route(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples(index=False):
                chosen = np.zeros(1, int)
                if row.dim in cells:
                    _, _, low, high = cells[row.dim]
                    query = np.frombuffer(row.query, np.float64)
                    point = query @ _projection(row.dim)
                    chosen = np.flatnonzero(
                        _box_distances(low, high, point) <= _limit(row.bound, point)
                    )
                yield pd.DataFrame(
                    {
                        "query_id": row.query_id, "query": row.query, "dim": row.dim,
                        "bound": row.bound, "home": row.home, "home_sub": row.home_sub,
                        "cell": chosen,
                    }
                )

    return bounded.mapInPandas(
        route,
        "query_id bigint, query binary, dim int, bound double, home int, home_sub int, cell int",
    )


def nearest(
    table: DataFrame, every: int = 100, k: int = 10, block: int = BLOCK
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the nearest other rows of each row with ``vec_id`` divisible
    by ``every``, nearest first, ties by the smaller ``vec_id``; ``score`` is the Euclidean distance.

    All rows are indexed by cells of the projected space (placed by a bounded sample) and, within
    cells, by hash into blocks of about ``block`` rows, so copies of one vector spread. A query first
    asks one block of its own cell, which bounds the distance of its last neighbour, then every other
    block whose cell passes the chi-square test for that bound. In a block, a kd-tree over the
    projected rows yields them leaf by leaf, nearest first, and they are verified on the original
    vectors until the test holds. Found distances are exact; a true neighbour is missed with a
    probability of at most 1 - ``CONFIDENCE``.

    Vectors that are null, empty, zero, or hold null or non-finite components take no part, nor do
    null ids. Vectors of different lengths are never compared. Rows that share a ``vec_id`` are one
    point with several places: it is listed once, at its least distance. Other columns are ignored;
    an empty table gives no rows. Only blocks that are asked travel, in as many copies as ``QUERIES`` of
    their own queries take.
    """
    vector = F.col("embedding").cast("array<double>")
    chosen = with_modules(table).select(F.col("vec_id").cast("bigint"), vector.alias("v"))
    chosen = chosen.where(_usable(F.col("v")) & F.col("vec_id").isNotNull())

    def pack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            vectors = [np.asarray(v, np.float64) for v in frame["v"]]
            yield pd.DataFrame(
                {
                    "vec_id": frame["vec_id"],
                    "vec": [v.tobytes() for v in vectors],
                    "dim": [len(v) for v in vectors],
                }
            )

    base = materialize(chosen.mapInPandas(pack, "vec_id bigint, vec binary, dim int"), "vectors")
    cells = _sample_cells(base, base.count())
    placed = materialize(_place(base, cells), "placed")
    sizes = placed.groupBy("dim", "cell").agg(F.count("*").alias("n"))
    subs = materialize(sizes.select("dim", "cell", F.ceil(F.col("n") / block).cast("int").alias("subs")), "subs")

    # The cells are at most CELLS for each dimension.
    rows = placed.join(F.broadcast(subs), ["dim", "cell"]).select(
        "vec_id", "vec", "dim", "cell",
        F.pmod(F.xxhash64("vec_id", "vec"), F.col("subs")).cast("int").alias("sub"),
    )
    queries = rows.where(F.col("vec_id") % every == 0).select(
        F.col("vec_id").alias("query_id"), F.col("vec").alias("query"), "dim", "cell", "sub"
    )
    queries = materialize(queries, "queries")
    unbounded = queries.withColumn("bound", F.lit(float("inf")))
    first = materialize(_visit(rows, unbounded, k), "first-answers")

    last = first.groupBy("query_id").agg(F.max("d2").alias("last"), F.count("*").alias("n"))
    bound = F.when(F.col("n") >= k, F.col("last")).otherwise(float("inf"))
    bounds = materialize(last.select("query_id", bound.alias("bound")), "bounds")
    bounded = queries.join(bounds, "query_id", "left").select(
        "query_id", "query", "dim", F.coalesce("bound", F.lit(float("inf"))).alias("bound"),
        F.col("cell").alias("home"), F.col("sub").alias("home_sub"),
    )
    routed = _routes(bounded, cells).join(F.broadcast(subs), ["dim", "cell"])
    routed = routed.withColumn("sub", F.explode(F.sequence(F.lit(0), F.col("subs") - 1)))
    routed = routed.where((F.col("cell") != F.col("home")) | (F.col("sub") != F.col("home_sub")))
    routed = materialize(routed.select("query_id", "query", *_KEYS, "bound"), "routes")
    second = _visit(rows, routed, k)

    found = first.union(second).groupBy("query_id", "vec_id").agg(F.min("d2").alias("d2"))
    order = Window.partitionBy("query_id").orderBy("d2", "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int"), "vec_id", F.sqrt("d2").alias("score"))
