"""Nearest neighbours through low-dimensional stable projections.

Vectors are projected on a few Gaussian (2-stable) directions.  The squared
projected distance of two vectors, divided by their squared distance, follows a
chi-square law, so once everything within a projected radius has been verified,
the chance that a nearer vector lies beyond is known.  A search takes projected
neighbours in order from a kd-tree, verifies them with the original vectors, and
stops when the chi-square test says that ``sure`` of all nearer ones must have
been met.

The kd-tree has two parts.  Its upper levels are fitted on a bounded sample and
cut space into cells, one group of rows each; every row is indexed.  A query is
answered in its own cell first; the distance found there bounds, by the same
test, which other cells it must visit.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import at_hand, stored

#: Directions, rows of a cell, bound of the sample for the upper tree, rows of a leaf.
DIRECTIONS = 8
CELL_ROWS = 4096
SAMPLE_ROWS = 65_536
LEAF = 64
#: Share of the nearer vectors that a search may not have missed when it stops.
SURE = 0.99


def chi_square_cdf(x: float, freedom: int) -> float:
    """For an even number of degrees of freedom."""
    term = total = 1.0
    for i in range(1, freedom // 2):
        term *= x / 2 / i
        total += term
    return 1.0 - math.exp(-x / 2) * total


def chi_square_quantile(p: float, freedom: int) -> float:
    low, high = 0.0, 1.0
    while chi_square_cdf(high, freedom) < p:
        high *= 2
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (mid, high) if chi_square_cdf(mid, freedom) < p else (low, mid)
    return high


def directions(dimension: int, count: int = DIRECTIONS, seed: int = 11) -> np.ndarray:
    return np.random.default_rng([seed, dimension]).standard_normal((dimension, count))


class KdTree:
    """Median splits along the widest axis down to leaves; boxes of all nodes."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF):
        self.points, self.nodes = points, []
        self._grow(np.arange(len(points)), leaf)

    def _grow(self, rows: np.ndarray, leaf: int) -> int:
        own = self.points[rows]
        at = len(self.nodes)
        low, high = own.min(0), own.max(0)
        self.nodes.append(None)
        axis = int((high - low).argmax())
        if len(rows) <= leaf or high[axis] == low[axis]:
            self.nodes[at] = (low, high, rows, -1, -1)
            return at
        half = len(rows) // 2
        order = np.argpartition(own[:, axis], half)
        left, right = self._grow(rows[order[:half]], leaf), self._grow(rows[order[half:]], leaf)
        self.nodes[at] = (low, high, None, left, right)
        return at

    def leaves(self, point: np.ndarray):
        """Leaves in the order of their distance to a point: squared distance and rows."""
        queue = [(0.0, 0)]
        while queue:
            d, at = heapq.heappop(queue)
            _, _, rows, left, right = self.nodes[at]
            if rows is not None:
                yield d, rows
                continue
            for child in (left, right):
                low, high = self.nodes[child][:2]
                off = np.maximum(np.maximum(low - point, point - high), 0.0)
                heapq.heappush(queue, (float(off @ off), child))


def search(
    tree: KdTree, vectors: np.ndarray, ids: list[np.ndarray], query: np.ndarray, projected: np.ndarray,
    own: int, k: int, stop: float, bound: float = math.inf,
) -> list[tuple[float, int]]:
    """The k nearest (distance, id) of a cell; ``stop``: chi-square quantile, ``bound``: a k-th distance known before."""
    best: list[tuple[float, int]] = []
    limit = bound
    for reach, rows in tree.leaves(projected):
        if reach > stop * limit * limit:
            break
        distance = np.sqrt(((vectors[rows] - query) ** 2).sum(1))
        for row, d in zip(rows[distance <= limit], distance[distance <= limit].tolist(), strict=True):
            best += [(d, int(i)) for i in ids[row] if i != own]
        if len(best) > k:
            best = sorted(best)[:k]
        if len(best) == k:
            limit = min(limit, max(best)[0])
    return sorted(best)[:k]


def split_cells(sample: np.ndarray, cells: int) -> list[tuple]:
    """Upper tree: (axis, value, left, right) for inner nodes, (cell number,) for leaves; node 0 is the root."""
    nodes: list[tuple] = []
    number = 0

    def grow(rows: np.ndarray, want: int) -> int:
        nonlocal number
        at = len(nodes)
        nodes.append(())
        spread = sample[rows].max(0) - sample[rows].min(0) if len(rows) else np.zeros(sample.shape[1])
        axis = int(spread.argmax())
        if want <= 1 or len(rows) < 2 or spread[axis] == 0:
            nodes[at] = (number,)
            number += 1
            return at
        value = float(np.median(sample[rows, axis]))
        below = sample[rows, axis] < value
        if not below.any() or below.all():
            value = float(sample[rows, axis].mean())
            below = sample[rows, axis] < value
        left = grow(rows[below], want // 2)
        nodes[at] = (axis, value, left, grow(rows[~below], want - want // 2))
        return at

    grow(np.arange(len(sample)), cells)
    return nodes


def cell_of(nodes: list[tuple], points: np.ndarray) -> np.ndarray:
    out = np.zeros(len(points), np.int32)

    def walk(at: int, rows: np.ndarray) -> None:
        node = nodes[at]
        if len(node) == 1:
            out[rows] = node[0]
            return
        axis, value, left, right = node
        below = points[rows, axis] < value
        walk(left, rows[below])
        walk(right, rows[~below])

    walk(0, np.arange(len(points)))
    return out


def cells_within(nodes: list[tuple], point: np.ndarray, radius: float) -> list[int]:
    """Cells whose box comes within a squared radius of a point."""
    found = []

    def walk(at: int, off: dict[int, float]) -> None:
        node = nodes[at]
        if sum(v * v for v in off.values()) > radius:
            return
        if len(node) == 1:
            found.append(node[0])
            return
        axis, value, left, right = node
        gap = float(point[axis]) - value
        walk(left, off if gap < 0 else off | {axis: max(off.get(axis, 0.0), gap)})
        walk(right, off if gap >= 0 else off | {axis: max(off.get(axis, 0.0), -gap)})

    walk(0, {})
    return found


_POINTS = "cell string, ids array<long>, vec array<double>"
_ANSWER = "query_id long, vec array<double>, cell string, vec_id long, score double"


def _projected(vectors: list[np.ndarray]) -> np.ndarray:
    x = np.stack(vectors)
    return x @ directions(x.shape[1])


def nearest(embeddings: DataFrame, query: str = "vec_id % 100 = 0", k: int = 10, sure: float = SURE) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k nearest rows found for each row that ``query`` selects.

    ``embeddings``: ``vec_id, embedding``; other columns are ignored.  Rows with
    a NULL id take no part, nor do vectors that are NULL, empty, zero, or hold a
    NULL or non-finite component.  Only vectors of one length are compared.
    Ties go to the smaller id; a row is no neighbour of its own id.  With fewer
    candidates than k all are returned.  Repeated rows count once.
    """
    spark = embeddings.sparkSession
    at_hand(spark)
    vec = F.transform(F.col("embedding"), lambda x: x.cast("double"))
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = (
        embeddings.select(F.col("vec_id").cast("long"), vec.alias("vec"))
        .where(F.col("vec_id").isNotNull() & F.coalesce(finite, F.lit(False)))
        .where(F.exists("vec", lambda x: x != 0))
        .withColumn("vec", F.transform("vec", lambda x: x + F.lit(0.0)))
        .dropDuplicates()
    )
    # Of equal vectors the k + 1 smallest ids are all that any answer can hold; each task keeps no more than those.
    ranked = rows.withColumn("r", F.row_number().over(Window.partitionBy("vec").orderBy("vec_id"))).where(F.col("r") <= k + 1)
    points = stored(ranked.groupBy("vec").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")), "points")
    sizes = points.groupBy(F.size("vec").alias("dimension")).agg(F.count("*").alias("n")).orderBy(F.desc("n")).limit(64).collect()
    upper: dict[int, list[tuple]] = {}
    for row in sizes:
        m, n = row["dimension"], row["n"]
        # Every row of few, else those with the least hashes: about SAMPLE_ROWS, whatever n is.
        share = min(1.0, SAMPLE_ROWS / n)
        some = points.where((F.size("vec") == m) & (F.pmod(F.xxhash64("vec"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1))
        sample = some.select("vec").limit(SAMPLE_ROWS).mapInPandas(
            lambda it: (pd.DataFrame({"p": list(_projected(list(x["vec"])))}) for x in it if len(x)), "p array<double>"
        )
        got = sample.toPandas()["p"]
        upper[m] = split_cells(np.stack(got) if len(got) else np.zeros((0, DIRECTIONS)), -(-n // CELL_ROWS))
    shared = spark.sparkContext.broadcast(upper)
    stop = chi_square_quantile(sure, DIRECTIONS)

    def place(batches):
        for x in batches:
            lengths = x["vec"].map(len)
            for m, part in x.groupby(lengths):
                cells = cell_of(shared.value.get(m, [(0,)]), _projected(list(part["vec"])))
                yield part.assign(cell=[f"{m}:{c}" for c in cells])

    cells = stored(points.mapInPandas(lambda it: (y[["cell", "ids", "vec"]] for y in place(it)), _POINTS), "cells")
    ask = rows.where(query).select(F.col("vec_id").alias("query_id"), "vec").dropDuplicates(["query_id"])
    asked = ask.mapInPandas(
        lambda it: (y[["query_id", "vec", "cell"]].assign(bound=math.inf) for y in place(it)),
        "query_id long, vec array<double>, cell string, bound double",
    )

    def answer(point: pd.DataFrame, asks: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(asks) and len(point):
            vectors = np.stack(point["vec"])
            ids = list(point["ids"])
            tree = KdTree(_projected(list(point["vec"])))
            for q, v, c, bound in zip(asks["query_id"], asks["vec"], asks["cell"], asks["bound"], strict=True):
                found = search(tree, vectors, ids, v, v @ directions(len(v)), q, k, stop, bound)
                out += [(q, v, c, i, d) for d, i in found]
                if not found and math.isinf(bound):
                    out.append((q, v, c, None, None))
        elif len(asks):
            out = [(q, v, c, None, None) for q, v, c in zip(asks["query_id"], asks["vec"], asks["cell"], strict=True)]
        found = pd.DataFrame(out, columns=["query_id", "vec", "cell", "vec_id", "score"])
        return found.astype({"vec_id": "Int64", "score": "float64"})

    def answers(asks: DataFrame) -> DataFrame:
        return cells.groupBy("cell").cogroup(asks.groupBy("cell")).applyInPandas(answer, _ANSWER)

    home = stored(answers(asked), "home")
    bounds = home.groupBy("query_id", "cell").agg(
        F.first("vec").alias("vec"), F.when(F.count("vec_id") >= k, F.max("score")).otherwise(float("inf")).alias("bound")
    )

    def others(batches):
        for x in batches:
            out = []
            for q, c, v, bound in zip(x["query_id"], x["cell"], x["vec"], x["bound"], strict=True):
                m = len(v)
                near = cells_within(shared.value.get(m, [(0,)]), v @ directions(m), stop * bound * bound)
                out += [(q, v, f"{m}:{o}", bound) for o in near if f"{m}:{o}" != c]
            yield pd.DataFrame(out, columns=["query_id", "vec", "cell", "bound"])

    more = answers(bounds.mapInPandas(others, "query_id long, vec array<double>, cell string, bound double"))
    both = home.select("query_id", "vec_id", "score").unionAll(more.select("query_id", "vec_id", "score"))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (
        both.where("vec_id IS NOT NULL")
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
