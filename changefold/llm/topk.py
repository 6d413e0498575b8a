"""Exact top-k search by inner product, with KD-trees.

A KD-tree splits at the median of the widest dimension and keeps a tight bounding box for every node. For a
query and a box, the largest inner product that any point of the box could have is a bound; a node
whose bound is below the k-th best score known so far is not visited, and nodes are visited best bound
first. The tree's top is cut by the medians of a sample and spread over the cluster, its boxes being those
of all rows; the lower levels are built for each shard by the task that searches it (see
``vector_search``). The k-th score is propagated: each query starts everywhere from the k-th best
that one shard of its own cell gave it. A leaf scores all queries that still want it by one product.

Defined results: vectors that are null, or hold null or non-finite components, take no part; vectors
of different lengths are never compared, and those without components score 0 with each other; rows
that share the query's vec_id are no candidates for it, other repeated rows count one by one; equal query
rows are answered once; a null vec_id is no query and comes last in ties; scores are exact, and those
beyond 64 bits count as the nearest number of 64 bits.
"""

from __future__ import annotations

import heapq

import numpy as np
from pyspark.sql import DataFrame, functions as F

from changefold.llm import vector_search as vs
from changefold.llm.vectors import floored, given_id, sound

#: By how much of the largest possible product rounding may move a bound.
_SLACK = 1e-9


def quantised(rows: DataFrame, vector: str = "embedding", scale: int = 64) -> DataFrame:
    """vec_id, vector (floor of each component times ``scale``, as doubles) of the rows that take part."""
    return rows.where(sound(vector)).select(F.col("vec_id").cast("long").alias("vec_id"), floored(vector, scale).alias("vector"))


def most_likely(queries: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Largest inner product that each query can have in each box, a little more than exact."""
    reach = np.maximum(queries, 0) @ high.T + np.minimum(queries, 0) @ low.T
    most = np.maximum(np.abs(low), np.abs(high)).sum(axis=1)
    return reach + _SLACK * np.abs(queries).max(axis=1, initial=0.0)[:, None] * most[None, :]


def halves(points: np.ndarray, order: np.ndarray, a: int, b: int) -> int | None:
    """Reorders ``order[a:b]`` about the median of its widest dimension, and gives that dimension."""
    part = points[order[a:b]]
    spread = part.max(axis=0) - part.min(axis=0)
    widest = int(spread.argmax()) if len(spread) else 0
    if not len(spread) or not spread[widest] > 0:
        return None
    order[a:b] = order[a:b][np.argpartition(part[:, widest], (b - a) // 2)]
    return widest


class Tree:
    """Nodes in order of their making; a leaf has rows ``low`` to ``high`` of the reordered ones."""

    def __init__(self, rows: np.ndarray, most: float, leaf_rows: int) -> None:
        points = rows["vector"] / most
        order = np.arange(len(rows))
        self.most, self.low, self.high, self.left = most, [0], [len(rows)], [-1]
        boxes = [(points.min(axis=0), points.max(axis=0))]
        node = 0
        while node < len(self.low):
            a, b = self.low[node], self.high[node]
            if b - a > leaf_rows and halves(points, order, a, b) is not None:
                middle = a + (b - a) // 2
                self.left[node] = len(self.low)
                for x, y in ((a, middle), (middle, b)):
                    self.low.append(x)
                    self.high.append(y)
                    self.left.append(-1)
                    part = points[order[x:y]]
                    boxes.append((part.min(axis=0), part.max(axis=0)))
            node += 1
        self.rows = rows[order]
        self.box_low, self.box_high = (np.stack(side) for side in zip(*boxes, strict=True))
        self.leaves = 0

    def visit(self, best: vs.Best) -> None:
        """Nodes in order of the best bound that any query still open has for them."""
        bounds = most_likely(best.queries["vector"] / self.most, self.box_low, self.box_high)
        waiting = [(-np.inf, 0)]
        while waiting:
            _, node = heapq.heappop(waiting)
            active = np.flatnonzero(bounds[:, node] >= best.low / self.most / self.most)
            if not len(active):
                continue
            child = self.left[node]
            if child < 0:
                self.leaves += 1
                best.take(active, self.rows[self.low[node] : self.high[node]])
                continue
            for one in (child, child + 1):
                heapq.heappush(waiting, (-float(bounds[active, one].max()), one))


class Top:
    """The top of the tree: cuts from a sample, and the boxes of all rows. Components are divided by the largest."""

    def __init__(self, sample: np.ndarray, cells: int, most: float, norm: float) -> None:
        self.scale = most
        points = sample / most
        order = np.arange(len(points))
        # Node: dimension, cut, children; a leaf: its cell.
        self.nodes: list[tuple[int, float, int, int] | int] = [0]
        open_nodes = [(0, 0, len(points))]
        n = 1
        while open_nodes and n < cells:
            node, a, b = open_nodes.pop(0)
            widest = halves(points, order, a, b) if b - a > 1 else None
            if widest is None:
                continue
            middle = a + (b - a) // 2
            cut = float(points[order[middle], widest])
            left = len(self.nodes)
            self.nodes += [self.nodes[node], n]
            self.nodes[node] = (widest, cut, left, left + 1)
            open_nodes += [(left, a, middle), (left + 1, middle, b)]
            n += 1
        length = sample.shape[1]
        self.low, self.high = np.full((n, length), np.inf), np.full((n, length), -np.inf)

    def assign(self, vectors: np.ndarray) -> np.ndarray:
        points = vectors / self.scale
        cell = np.zeros(len(points), np.int32)
        waiting = [(0, np.arange(len(points)))]
        while waiting:
            node, own = waiting.pop()
            held = self.nodes[node]
            if isinstance(held, tuple):
                widest, cut, left, right = held
                below = points[own, widest] < cut
                waiting += [(left, own[below]), (right, own[~below])]
            else:
                cell[own] = held
        return cell

    def features(self, vectors: np.ndarray) -> np.ndarray:
        return vectors / self.scale

    def know(self, cell: int, feature: int, least: float, most: float) -> None:
        self.low[cell, feature], self.high[cell, feature] = least, most

    def reach(self, queries: np.ndarray) -> np.ndarray:
        known = np.isfinite(self.low).all(axis=1)
        low, high = (np.where(known[:, None], side, 0.0) for side in (self.low, self.high))
        bounds = most_likely(queries["vector"] / self.scale, low, high)
        return known[None, :] & (bounds >= (queries["low"] / self.scale / self.scale)[:, None])

    def tree(self, rows: np.ndarray) -> Tree:
        return Tree(rows, self.scale, vs.LEAF_ROWS)


def top_k(
    rows: DataFrame,
    queries: DataFrame,
    *,
    k: int = 20,
    shard_rows: int = vs.SHARD_ROWS,
    block_queries: int = vs.BLOCK_QUERIES,
    sample_rows: int = vs.SAMPLE_ROWS,
    most_cells: int = vs.MOST_CELLS,
) -> DataFrame:
    """query_id, rank, vec_id, score: of each row of ``queries`` the k best of ``rows`` but those of its id.

    Both have vec_id and vector (whole numbers as doubles).
    """
    no_label = F.lit(0).cast("long").alias("label")
    shards = vs.Shards(rows.select("vec_id", "vector", no_label), Top, "topk-shards", shard_rows, sample_rows, most_cells)
    asked = queries.where("vec_id IS NOT NULL").select("vec_id", "vector", no_label)
    blocks = vs.blocks_of(asked, shards, "topk-queries", block_queries)
    found = vs.search(blocks, shards, k, vs.different_id, "topk-raised")
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), given_id("vec_id"), "score")
