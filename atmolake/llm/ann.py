"""Approximate nearest neighbours: a few stable projections, a kd-tree over them, and a chi-square stopping test.

Vectors are projected onto `DIMENSIONS` Gaussian directions. The square of a projected distance over the square of the
true one is then a chi-square variable with as many degrees of freedom. A search takes projected neighbours in
order of their distance from a kd-tree and verifies each on the original vectors. It stops when the next projected
distance is so large that a vector nearer than the k-th best found would have come before with probability
`CONFIDENCE`.

Rows are dealt to blocks of bounded size by a hash of their id, and queries likewise; each pair of a block of vectors
and a block of queries is one task that builds its tree and searches it. A query's best of all blocks are merged. So no
task and no broadcast grows with the data, and every vector is indexed.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DIMENSIONS = 8
CONFIDENCE = 0.95
LEAF = 256
BLOCK_ROWS, QUERY_ROWS = 16_384, 1_024


def directions(dim: int, m: int = DIMENSIONS) -> np.ndarray:
    return np.random.default_rng(dim).standard_normal((dim, m))


def chi_square_quantile(p: float, m: int = DIMENSIONS) -> float:
    """For an even m the distribution is 1 - exp(-x/2) * sum of (x/2)**j / j! for j below m/2; solved by halving."""
    low, high = 0.0, 1000.0
    for _ in range(100):
        x = (low + high) / 2
        term = total = np.exp(-x / 2)
        for j in range(1, m // 2):
            term *= x / 2 / j
            total += term
        low, high = (x, high) if 1 - total < p else (low, x)
    return high


class KdTree:
    """Splits at the median of the widest side until a cell has at most LEAF points. Cells keep their bounds."""

    def __init__(self, points: np.ndarray):
        self.points = points
        self.order = np.arange(len(points))
        self.low, self.high, self.span, self.children = [], [], [], []
        self._build(0, len(points))

    def _build(self, start: int, end: int) -> int:
        inside = self.points[self.order[start:end]]
        low, high = inside.min(axis=0), inside.max(axis=0)
        cell = len(self.span)
        self.low.append(low)
        self.high.append(high)
        self.span.append((start, end))
        self.children.append(None)
        if end - start > LEAF:
            side = int(np.argmax(high - low))
            middle = (end - start) // 2
            self.order[start:end] = self.order[start:end][np.argpartition(inside[:, side], middle)]
            self.children[cell] = (self._build(start, start + middle), self._build(start + middle, end))
        return cell

    def _distance(self, query: np.ndarray, cell: int) -> float:
        outside = np.maximum(self.low[cell] - query, 0) + np.maximum(query - self.high[cell], 0)
        return float(outside @ outside)

    def leaves(self, query: np.ndarray):
        """(lower bound of squared distances still to come, rows of the next leaf), nearest leaf first."""
        heap = [(self._distance(query, 0), 0)]
        while heap:
            bound, cell = heapq.heappop(heap)
            if self.children[cell] is None:
                start, end = self.span[cell]
                yield bound, self.order[start:end]
            else:
                for child in self.children[cell]:
                    heapq.heappush(heap, (self._distance(query, child), child))


class Index:
    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors = ids, vectors
        self.basis = directions(vectors.shape[1])
        self.projected = vectors @ self.basis
        self.tree = KdTree(self.projected)

    def search(self, own: int, query: np.ndarray, k: int, quantile: float) -> list[tuple[float, int]]:
        """The k nearest found, as (distance, id), without the query's own row."""
        best: list[tuple[float, int]] = []
        near = query @ self.basis
        found_d = np.empty(0)
        found_i = np.empty(0, np.int64)
        for bound, rows in self.tree.leaves(near):
            # All vectors with a projected distance below the bound have come.
            reach = quantile * best[-1][0] ** 2 if len(best) == k else np.inf
            if bound > reach:
                break
            gap = self.projected[rows] - near
            rows = rows[(gap * gap).sum(axis=1) <= reach]
            rows = rows[self.ids[rows] != own]
            if not len(rows):
                continue
            difference = self.vectors[rows] - query
            found_d = np.append(found_d, np.sqrt((difference * difference).sum(axis=1)))
            found_i = np.append(found_i, self.ids[rows])
            if len(found_d) > k:
                keep = np.lexsort((found_i, found_d))[:k]
                found_d, found_i = found_d[keep], found_i[keep]
            order = np.lexsort((found_i, found_d))
            best = [(float(found_d[j]), int(found_i[j])) for j in order]
        return best


def usable(vector: Column) -> Column:
    """Neither null nor empty nor zero, and all components finite."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & fine & F.exists(vector, lambda x: x != 0), F.lit(False))


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 10, confidence: float = CONFIDENCE) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query its k nearest vectors found, by Euclidean distance.

    Both have vec_id (integer) and embedding (array of numbers). Rows with a null id or an unusable vector take no part.
    Vectors are compared with queries of their own number of components. Of rows that repeat an id the one with the
    smallest vector counts. Equal distances go to the smaller id. A query with fewer candidates gets them all; without
    any it has no row, and an empty table gives an empty result.
    """
    quantile = chi_square_quantile(confidence)

    def plain(df: DataFrame) -> DataFrame:
        df = df.select(F.col("vec_id").cast("long").alias("id"), F.col("embedding").cast("array<double>").alias("v"))
        return df.filter(F.col("id").isNotNull() & usable(F.col("v")))

    vectors, queries = plain(vectors), plain(queries)
    blocks = max(1, -(-vectors.count() // BLOCK_ROWS))
    query_blocks = max(1, -(-queries.count() // QUERY_ROWS))
    own = F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")
    other = F.pmod(F.xxhash64("id"), F.lit(query_blocks)).cast("int")
    left = vectors.withColumn("block", own).withColumn("query_block", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))))
    right = queries.withColumn("query_block", other).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def first_of_each(frame: pd.DataFrame) -> tuple[np.ndarray, list[tuple[float, ...]]]:
        rows = sorted({(int(i), tuple(v)) for i, v in zip(frame["id"], frame["v"])})
        rows = [row for n, row in enumerate(rows) if not n or rows[n - 1][0] != row[0]]
        return np.array([i for i, _ in rows], np.int64), [v for _, v in rows]

    def search(here: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        ids, data = first_of_each(here)
        query_ids, query_data = first_of_each(asked)
        sizes = np.array([len(v) for v in data])
        out = []
        for size in {len(v) for v in query_data} & set(sizes.tolist()):
            same = np.flatnonzero(sizes == size)
            index = Index(ids[same], np.array([data[n] for n in same]))
            for query_id, query in zip(query_ids, query_data):
                if len(query) == size:
                    found = index.search(int(query_id), np.array(query), k, quantile)
                    out += [(int(query_id), vec_id, score) for score, vec_id in found]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    keys = ["block", "query_block"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(search, "query_id long, vec_id long, score double")
    # A query has at most k rows of each block.
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
